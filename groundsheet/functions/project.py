"""Coordinate reference systems with closed-form formulas, as column arithmetic.

Supported EPSG codes: 4326 (degrees), 3857 (web mercator), 6933 (equal-area cylinder)
and the UTM zones 32601-32660 / 32701-32760.  A conversion is a list of *stages*; each
stage maps a coordinate pair to a coordinate pair, and stages pass through 4326.

UTM uses the Krueger series to fourth order in the third flattening; 6933 and its
inverse use the authalic-latitude series (Snyder, USGS Professional Paper 1395).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G

Pair = tuple[Column, Column]
Stage = Callable[[Column, Column], Pair]

# WGS 84 ellipsoid (fixed values) and what follows from it.
A = 6378137.0
FLAT = 1 / 298.257223563
E2 = FLAT * (2 - FLAT)
ECC = math.sqrt(E2)
N3 = FLAT / (2 - FLAT)
UTM_SCALE = 0.9996
UTM_RADIUS = UTM_SCALE * A / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
ALPHA = [
    N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16 + 41 * N3**4 / 180,
    13 * N3**2 / 48 - 3 * N3**3 / 5 + 557 * N3**4 / 1440,
    61 * N3**3 / 240 - 103 * N3**4 / 140,
    49561 * N3**4 / 161280,
]
BETA = [
    N3 / 2 - 2 * N3**2 / 3 + 37 * N3**3 / 96 - N3**4 / 360,
    N3**2 / 48 + N3**3 / 15 - 437 * N3**4 / 1440,
    17 * N3**3 / 480 - 37 * N3**4 / 840,
    4397 * N3**4 / 161280,
]
DELTA = [
    2 * N3 - 2 * N3**2 / 3 - 2 * N3**3 + 116 * N3**4 / 45,
    7 * N3**2 / 3 - 8 * N3**3 / 5 - 227 * N3**4 / 45,
    56 * N3**3 / 15 - 136 * N3**4 / 35,
    4279 * N3**4 / 630,
]
# Equal-area cylinder with standard parallels at 30 degrees.
_SIN30 = 0.5
EA_SCALE = math.cos(math.radians(30)) / math.sqrt(1 - E2 * _SIN30**2)
EA_POLE = (1 - E2) * (1 / (1 - E2) - math.log((1 - ECC) / (1 + ECC)) / (2 * ECC))
EA_INVERSE = [
    E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040,
    23 * E2**2 / 360 + 251 * E2**3 / 3780,
    761 * E2**3 / 45360,
]


def _sines(angle: Column, terms: list[float]) -> Column:
    total = F.lit(0.0)
    for j, c in enumerate(terms, 1):
        total = total + F.lit(c) * F.sin(F.lit(2.0 * j) * angle)
    return total


def _mercator(lon: Column, lat: Column) -> Pair:
    north = F.lit(A) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))
    return F.lit(A) * F.radians(lon), north


def _unmercator(x: Column, y: Column) -> Pair:
    lat = F.lit(2.0) * F.atan(F.exp(y / A)) - F.lit(math.pi / 2)
    return F.degrees(x / A), F.degrees(lat)


def _equal_area(lon: Column, lat: Column) -> Pair:
    s = F.sin(F.radians(lat))
    es = F.lit(ECC) * s
    q = F.lit(1 - E2) * (s / (F.lit(1.0) - es * es) - F.log((1 - es) / (1 + es)) / (2 * ECC))
    return F.lit(A * EA_SCALE) * F.radians(lon), F.lit(A / (2 * EA_SCALE)) * q


def _unequal_area(x: Column, y: Column) -> Pair:
    ratio = y * F.lit(2 * EA_SCALE / A / EA_POLE)
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))
    return F.degrees(x / (A * EA_SCALE)), F.degrees(beta + _sines(beta, EA_INVERSE))


def _utm_sphere(central: float) -> Stage:
    """Longitude and latitude to the conformal-sphere coordinates of the zone."""

    def stage(lon: Column, lat: Column) -> Pair:
        s = F.sin(F.radians(lat))
        t = F.sinh(F.atanh(s) - F.lit(ECC) * F.atanh(F.lit(ECC) * s))
        lam = F.radians(lon - central)
        c = F.cos(lam)
        return F.atan2(t, c), F.asinh(F.sin(lam) / F.sqrt(t * t + c * c))

    return stage


def _utm_plane(south: bool) -> Stage:
    def stage(xi: Column, eta: Column) -> Pair:
        east, north = eta, xi
        for j, c in enumerate(ALPHA, 1):
            u, v = F.lit(2.0 * j) * xi, F.lit(2.0 * j) * eta
            east = east + F.lit(c) * F.cos(u) * F.sinh(v)
            north = north + F.lit(c) * F.sin(u) * F.cosh(v)
        return (
            F.lit(UTM_RADIUS) * east + 500000.0,
            F.lit(UTM_RADIUS) * north + (10000000.0 if south else 0.0),
        )

    return stage


def _utm_unplane(south: bool) -> Stage:
    def stage(x: Column, y: Column) -> Pair:
        eta = (x - 500000.0) / UTM_RADIUS
        xi = (y - (10000000.0 if south else 0.0)) / UTM_RADIUS
        eta0, xi0 = eta, xi
        for j, c in enumerate(BETA, 1):
            u, v = F.lit(2.0 * j) * xi, F.lit(2.0 * j) * eta
            xi0 = xi0 - F.lit(c) * F.sin(u) * F.cosh(v)
            eta0 = eta0 - F.lit(c) * F.cos(u) * F.sinh(v)
        return xi0, eta0

    return stage


def _utm_unsphere(central: float) -> Stage:
    def stage(xi: Column, eta: Column) -> Pair:
        chi = F.asin(F.sin(xi) / F.cosh(eta))
        lon = F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + central
        return lon, F.degrees(chi + _sines(chi, DELTA))

    return stage


def utm_code(lon: float, lat: float) -> int:
    """UTM code whose zone holds a position."""
    zone = min(60, max(1, int(math.floor((lon + 180) / 6)) + 1))
    return (32600 if lat >= 0 else 32700) + zone


def _is_utm(code: int) -> bool:
    return 32601 <= code <= 32660 or 32701 <= code <= 32760


def stages(source: int, target: int) -> list[Stage]:
    for code in (source, target):
        if code not in (4326, 3857, 6933) and not _is_utm(code):
            raise ValueError(f"unsupported coordinate system {code}")
    if source == target:
        return []
    back: list[Stage] = []
    if source == 3857:
        back = [_unmercator]
    elif source == 6933:
        back = [_unequal_area]
    elif _is_utm(source):
        back = [_utm_unplane(source > 32700), _utm_unsphere(6.0 * (source % 100) - 183)]
    ahead: list[Stage] = []
    if target == 3857:
        ahead = [_mercator]
    elif target == 6933:
        ahead = [_equal_area]
    elif _is_utm(target):
        ahead = [_utm_sphere(6.0 * (target % 100) - 183), _utm_plane(target > 32700)]
    return back + ahead


def _applied(stage: Stage) -> Callable[[Column], Column]:
    def apply(v: Column) -> Column:
        p, q = stage(v["p"], v["q"])
        return F.struct(v["t"].alias("t"), p.alias("p"), q.alias("q"))

    return apply


def transform_xy(x: Column, y: Column, source: int, target: int) -> Pair:
    """Project numeric coordinate columns (point layers): plain generated code."""
    for stage in stages(source, target):
        x, y = stage(x, y)
    return x, y


def transform_geometry(c, source: int, target: int) -> Column:
    """Project every vertex of any geometry, keeping its structure.

    The text form is cut into positions and the punctuation between them; positions are
    projected and put back between the same punctuation, so nesting of any depth needs
    no special case.
    """
    wkt = F.replace(G.as_wkt(c), F.lit(", "), F.lit(","))
    # pieces between parentheses and commas: positions, and the names of collection members
    halves = F.struct(F.split(wkt, r"[^(),]+").alias("marks"), F.split(wkt, r"[(),]+").alias("pieces"))
    return G.from_wkt(G.let(halves, lambda h: _rebuilt(h, stages(source, target))))


def _rebuilt(halves: Column, steps: list[Stage]) -> Column:
    def parse(piece: Column) -> Column:
        # a position starts with a digit, sign or point, which all sort before letters
        pair = F.when((piece != "") & (piece < "A"), F.split(piece, " "))
        return F.struct(
            piece.alias("t"),
            F.get(pair, F.lit(0)).cast("double").alias("p"),
            F.get(pair, F.lit(1)).cast("double").alias("q"),
        )

    moved = F.transform(halves["pieces"], parse)
    for stage in steps:
        moved = F.transform(moved, _applied(stage))
    texts = F.transform(
        moved,
        lambda v: F.when(
            v["p"].isNotNull(), F.concat(v["p"].cast("string"), F.lit(" "), v["q"].cast("string"))
        ).otherwise(v["t"]),
    )
    # the text starts with the kind's name, so its first mark is the empty string before it
    both = F.zip_with(halves["marks"], texts, lambda m, t: F.concat(m, F.coalesce(t, F.lit(""))))
    return F.array_join(both, "")
