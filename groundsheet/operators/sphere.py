"""Distance joins of points in degrees, in metres on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.operators import dealing, lineage

#: Mean radius of the earth in metres.
RADIUS = 6371008.8
#: Rows of one cell that a task takes; fuller cells are dealt over salts.
CELL_ROWS = 200_000


def _spots(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Rows with a place on the sphere, as ``row`` and the unit vector x, y, z."""
    east, north = F.radians(F.col(lon).cast("double")), F.radians(F.col(lat).cast("double"))
    vector = [F.cos(north) * F.cos(east), F.cos(north) * F.sin(east), F.sin(north)]
    usable = (F.abs(F.col(lat).cast("double")) <= 90) & (F.abs(F.col(lon).cast("double")) < float("inf"))
    return df.where(usable).select(F.struct("*").alias("row"), *(v.alias(n) for v, n in zip(vector, "xyz")))


def _cell(axis: str, width: float, shift: float = 0.0) -> Column:
    return F.floor((F.col(axis) + shift) / width).cast("int")


def distance_join_metres(
    a: DataFrame,
    b: DataFrame,
    metres: float,
    *,
    a_xy: tuple[str, str] = ("lon", "lat"),
    b_xy: tuple[str, str] = ("lon", "lat"),
    prefix: str = "b_",
    distance: str = "metres",
    radius: float = RADIUS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Pairs of points at most ``metres`` apart along the great circle.

    Points become unit vectors and meet in cubes of space, so the date line and the poles are places like
    any other and no cell narrows with latitude.  A point of a lies in one cube, a point of b in the at
    most eight that its reach touches, so a pair meets once.  Cubes with over ``cell_rows`` points of a are
    dealt over salts.  Longitudes may be any number of turns; rows with null or non-finite coordinates
    or latitudes beyond 90 match nothing,
    and so does a negative distance.
    """
    half = metres / (2 * radius)
    reach = 2.0 if half >= math.pi / 2 else 2 * math.sin(half)
    reach = max(reach, 1e-9) * (1 + 1e-9)
    width, axes = 2 * reach, "xyz"
    cube = [f"_{n}" for n in axes]
    left = _spots(a, *a_xy).select("*", *(_cell(n, width).alias(f"_{n}") for n in axes))
    right = _spots(b, *b_xy)
    for n in axes:
        right = right.withColumn(f"_{n}", F.explode(F.sequence(_cell(n, width, -reach), _cell(n, width, reach))))
    crowded = left.groupBy(*cube).agg(F.count("*").alias("rows")).where(F.col("rows") > cell_rows)
    crowded = lineage.materialize(crowded.select(*cube, F.ceil(F.col("rows") / cell_rows).cast("int").alias("salts")), "crowded")
    if crowded.isEmpty():
        left, right = left.withColumn("_salt", F.lit(0)), right.withColumn("_salt", F.lit(0))
    else:
        salts = F.coalesce("salts", F.lit(1))
        left = left.join(crowded, cube, "left").withColumn("_salt", F.pmod(F.xxhash64("row"), salts).cast("int")).drop("salts")
        right = right.join(crowded, cube, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    one = left.withColumnsRenamed({n: f"a_{n}" for n in axes} | {"row": "_a"})
    two = right.withColumnsRenamed({n: f"b_{n}" for n in axes} | {"row": "_b"})
    square = sum(((F.col(f"a_{n}") - F.col(f"b_{n}")) * (F.col(f"a_{n}") - F.col(f"b_{n}")) for n in axes), F.lit(0.0))
    apart = F.asin(F.least(F.lit(1.0), F.sqrt(square) / 2)) * (2 * radius)
    # few products tell most pairs to be too far apart
    met = dealing.join(one, two, [*cube, "_salt"]).where(square <= reach * reach * (1 + 1e-9))
    near = met.withColumn("_apart", apart).where(F.col("_apart") <= float(metres))
    return near.select("_a.*", *(F.col("_b")[c].alias(f"{prefix}{c}") for c in b.columns), F.col("_apart").alias(distance))
