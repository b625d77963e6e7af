"""Geometry column functions: constructors, output formats, accessors, measures, tests.

Every function takes and returns ``Column``; geometries are WKB ``binary``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.functions import jts

# One signed decimal number, with optional exponent, as it appears in WKT and JSON.
NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"

# Single-argument geometry tests, by the name used in operators: (method, swap sides).
PREDICATES = {
    "intersects": "intersects",
    "contains": "contains",
    "within": "within",
    "covers": "covers",
    "covered_by": "coveredBy",
    "touches": "touches",
    "crosses": "crosses",
    "overlaps": "overlaps",
    "equals": "equalsTopo",
}


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


# --- text formats -----------------------------------------------------------------


def from_wkt(c) -> Column:
    return jts.write(jts.read_text(_col(c)))


def as_wkt(c) -> Column:
    return jts.string(jts.invoke(jts.read(_col(c)), "toText", "java.lang.String"))


def looks_like_wkt(c) -> Column:
    """Cheap shape test used by ``on_error='null'`` before the strict reader."""
    body = r"(EMPTY|\([-+0-9eE., ()]*\))"
    kinds = "POINT|LINESTRING|POLYGON|MULTIPOINT|MULTILINESTRING|MULTIPOLYGON"
    pair = rf"{NUMBER}\s+{NUMBER}"
    return F.upper(F.trim(_col(c))).rlike(rf"^({kinds})\s*{body}$") & (
        F.upper(_col(c)).rlike("EMPTY") | _col(c).rlike(pair)
    )


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# The geometry members of GeoJSON; lists stay texts, as their nesting depends on the kind.
GEOJSON_SCHEMA = "type string, coordinates string, geometries array<string>"


def _member_wkt(doc: Column) -> Column:
    kind = F.upper(doc["type"])
    bare = F.regexp_replace(doc["coordinates"], r"\s", "")
    # a position is a bracket without brackets inside; heights are dropped
    flat = F.regexp_replace(bare, r"\[([^\[\],]+),([^\[\],]+)(?:,[^\[\]]*)?\]", "$1 $2")
    return let(
        flat,
        lambda f: F.when(f == "[]", F.concat(kind, F.lit(" EMPTY")))
        .when(kind == "POINT", F.concat(F.lit("POINT("), f, F.lit(")")))
        .otherwise(F.concat(kind, F.translate(f, "[]", "()"))),
    )


def _document_wkt(doc: Column) -> Column:
    members = F.transform(doc["geometries"], lambda m: let(F.from_json(m, GEOJSON_SCHEMA), _member_wkt))
    return F.when(
        doc["type"] == "GeometryCollection",
        F.concat(F.lit("GEOMETRYCOLLECTION("), F.array_join(members, ", "), F.lit(")")),
    ).otherwise(_member_wkt(doc))


def geojson_to_wkt(c) -> Column:
    """GeoJSON geometry text to WKT: the nesting is the same, only brackets change."""
    return let(F.from_json(_col(c), GEOJSON_SCHEMA), _document_wkt)


def from_geojson(c) -> Column:
    return from_wkt(geojson_to_wkt(c))


# GeoJSON spelling of the geometry kinds (fixed values).
GEOJSON_KINDS = {
    "POINT": "Point",
    "LINESTRING": "LineString",
    "POLYGON": "Polygon",
    "MULTIPOINT": "MultiPoint",
    "MULTILINESTRING": "MultiLineString",
    "MULTIPOLYGON": "MultiPolygon",
}


def _member_geojson(wkt: Column) -> Column:
    """The text form differs from GeoJSON in brackets and in the space inside positions."""
    kind = F.regexp_extract(wkt, r"^\s*([A-Z]+)", 1)
    body = F.replace(F.regexp_extract(wkt, r"(\(.*\))", 1), F.lit(", "), F.lit(","))
    # a multipoint writes each position in its own parentheses; GeoJSON does not
    body = F.when(
        kind == "MULTIPOINT", F.concat(F.lit("("), F.translate(body, "()", ""), F.lit(")"))
    ).otherwise(body)
    nested = F.translate(F.regexp_replace(body, "([^(),]+)", "[$1]"), "() ", "[],")
    spelled = F.lit(None).cast("string")
    for upper, name in GEOJSON_KINDS.items():
        spelled = F.when(kind == upper, F.lit(name)).otherwise(spelled)
    coords = let(
        nested,
        lambda n: F.when(n == "", F.lit("[]"))
        .when(kind == "POINT", F.substring(n, F.lit(2), F.length(n) - 2))
        .otherwise(n),
    )
    return F.concat(F.lit('{"type":"'), spelled, F.lit('","coordinates":'), coords, F.lit("}"))


def _geojson(wkt: Column) -> Column:
    body = F.regexp_extract(wkt, r"^GEOMETRYCOLLECTION\s*\((.*)\)$", 1)
    members = F.transform(F.split(body, r",\s*(?=[A-Z])"), _member_geojson)
    return F.when(
        wkt.startswith("GEOMETRYCOLLECTION"),
        F.concat(
            F.lit('{"type":"GeometryCollection","geometries":['), F.array_join(members, ","), F.lit("]}")
        ),
    ).otherwise(_member_geojson(wkt))


def as_geojson(c) -> Column:
    return let(as_wkt(c), _geojson)


# --- constructors -----------------------------------------------------------------


def _text(c) -> Column:
    return _col(c).cast("double").cast("string")


def point(x, y) -> Column:
    return from_wkt(F.concat(F.lit("POINT("), _text(x), F.lit(" "), _text(y), F.lit(")")))


def envelope_wkt(x0, y0, x1, y1) -> Column:
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    pairs = [F.concat(_text(x), F.lit(" "), _text(y)) for x, y in corners]
    # concat (unlike concat_ws) gives null when any corner is null
    parts = [pairs[0]] + [F.concat(F.lit(", "), p) for p in pairs[1:]]
    return F.concat(F.lit("POLYGON(("), *parts, F.lit("))"))


def envelope(x0, y0, x1, y1) -> Column:
    return from_wkt(envelope_wkt(x0, y0, x1, y1))


def line_from_vertices(vertices: Column) -> Column:
    """LINESTRING from ``array<struct<x, y>>``; fewer than two vertices give null."""
    pairs = F.transform(
        vertices, lambda v: F.concat(v["x"].cast("string"), F.lit(" "), v["y"].cast("string"))
    )
    text = F.concat(F.lit("LINESTRING("), F.array_join(pairs, ", "), F.lit(")"))
    return from_wkt(F.when(F.size(vertices) >= 2, text))


def line_through(*points) -> Column:
    """Line through two or more points in their order; null points are left out."""
    spots = F.filter(F.array(*(_col(p) for p in points)), lambda g: g.isNotNull())
    return line_from_vertices(F.transform(spots, lambda g: F.struct(x(g).alias("x"), y(g).alias("y"))))


def collection(members: Column) -> Column:
    """GEOMETRYCOLLECTION from ``array<binary>`` by joining the encoded members."""
    count = F.lpad(F.hex(F.size(members)), 8, "0")
    body = F.array_join(F.transform(members, F.hex), "")
    return F.unhex(F.concat(F.lit("0000000007"), count, body))


# --- accessors and measures --------------------------------------------------------


def x(c) -> Column:
    return jts.number_of(_col(c), "getX", jts.POINT)


def y(c) -> Column:
    return jts.number_of(_col(c), "getY", jts.POINT)


def kind(c) -> Column:
    return F.upper(jts.string(jts.invoke(jts.read(_col(c)), "getGeometryType", "java.lang.String")))


def vertex_count(c) -> Column:
    return jts.column(jts.invoke(jts.read(_col(c)), "getNumPoints", "Integer"))


def is_valid(c) -> Column:
    return jts.column(jts.invoke(jts.read(_col(c)), "isValid", "Boolean"))


def is_empty(c) -> Column:
    return jts.column(jts.invoke(jts.read(_col(c)), "isEmpty", "Boolean"))


def dimension(c) -> Column:
    return jts.column(jts.invoke(jts.read(_col(c)), "getDimension", "Integer"))


def _line_end(c, method: str) -> Column:
    col = F.when(kind(c) == "LINESTRING", _col(c))
    return jts.write(jts.invoke(jts.read(col, jts.LINE), method, jts.POINT))


def start_point(c) -> Column:
    return _line_end(c, "getStartPoint")


def end_point(c) -> Column:
    return _line_end(c, "getEndPoint")


def bounds(c) -> dict[str, Column]:
    """Numeric box of each geometry; null for null and empty geometries."""
    box = jts.invoke(jts.read(_col(c)), "getEnvelopeInternal", jts.ENVELOPE)
    methods = {"xmin": "getMinX", "ymin": "getMinY", "xmax": "getMaxX", "ymax": "getMaxY"}
    present = ~is_empty(c)
    return {
        name: F.when(present, jts.column(jts.invoke(box, m, "Double")))
        for name, m in methods.items()
    }


def with_bounds(df: DataFrame, c: str, names=("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """Add the numeric box columns, computed once per row.

    The four numbers come out of one generated struct: filters on them, which Spark would
    otherwise push below the projection, stay above it and cannot repeat the decoding.
    """
    parts = bounds(c)
    struct = F.struct(*[parts[k].alias(n) for k, n in zip(("xmin", "ymin", "xmax", "ymax"), names)])
    return df.select("*", F.inline(F.array(struct)))


def is_box(c, x0, y0, x1, y1) -> Column:
    """Whether the shape is a rectangle along the axes with just these bounds."""
    own = bounds(c)
    same = F.lit(True)
    for name, given in zip(("xmin", "ymin", "xmax", "ymax"), (x0, y0, x1, y1)):
        same = same & (own[name] == _col(given))
    return F.coalesce(jts.column(jts.invoke(jts.read(_col(c)), "isRectangle", "Boolean")) & same, F.lit(False))


def box(c) -> Column:
    return jts.write(jts.invoke(jts.read(_col(c)), "getEnvelope", jts.GEOM))


def area(c) -> Column:
    return jts.number_of(_col(c), "getArea")


def length(c) -> Column:
    """Length of lines; zero for points and polygons."""
    return F.when(dimension(c) == 1, jts.number_of(_col(c), "getLength")).otherwise(
        F.when(_col(c).isNotNull(), F.lit(0.0))
    )


def perimeter(c) -> Column:
    """Boundary length of polygons; zero for points and lines."""
    return F.when(dimension(c) == 2, jts.number_of(_col(c), "getLength")).otherwise(
        F.when(_col(c).isNotNull(), F.lit(0.0))
    )


def distance(a, b) -> Column:
    return jts.column(jts.invoke(jts.read(_col(a)), "distance", "Double", jts.read(_col(b))))


def within_distance(a, b, d) -> Column:
    return jts.test(_col(a), "isWithinDistance", _col(b), jts.number(d))


def predicate(name: str, a, b) -> Column:
    if name not in PREDICATES:
        raise ValueError(f"unknown predicate {name!r}; one of {sorted(PREDICATES)}")
    return jts.test(_col(a), PREDICATES[name], _col(b))


def haversine(lon1, lat1, lon2, lat2, radius: float = 6371008.8) -> Column:
    """Great-circle distance in metres, in plain column arithmetic."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = F.sin((p2 - p1) / 2)
    half_lon = F.sin(F.radians(_col(lon2) - _col(lon1)) / 2)
    h = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


# --- new geometry -------------------------------------------------------------------


def buffer(c, radius) -> Column:
    return jts.write(jts.invoke(jts.read(_col(c)), "buffer", jts.GEOM, jts.number(radius)))


def centroid(c) -> Column:
    return jts.write(jts.invoke(jts.read(_col(c)), "getCentroid", jts.POINT))


def convex_hull(c) -> Column:
    return jts.write(jts.invoke(jts.read(_col(c)), "convexHull", jts.GEOM))


def simplify(c, tolerance) -> Column:
    owner = "org.locationtech.jts.simplify.DouglasPeuckerSimplifier"
    return jts.write(
        jts.static(owner, "simplify", jts.GEOM, jts.read(_col(c)), jts.number(tolerance))
    )


def make_valid(c) -> Column:
    owner = "org.locationtech.jts.geom.util.GeometryFixer"
    return jts.write(jts.static(owner, "fix", jts.GEOM, jts.read(_col(c))))


def flip(c) -> Column:
    swap = [jts.number(v) for v in (0, 1, 0, 1, 0, 0)]
    op = jts.new("org.locationtech.jts.geom.util.AffineTransformation", *swap)
    return jts.write(jts.invoke(op, "transform", jts.GEOM, jts.read(_col(c))))


def snap(c, size: float) -> Column:
    model = jts.new("org.locationtech.jts.geom.PrecisionModel", jts.number(1.0 / size))
    owner = "org.locationtech.jts.precision.GeometryPrecisionReducer"
    return jts.write(jts.static(owner, "reduce", jts.GEOM, jts.read(_col(c)), model))


def intersection(a, b) -> Column:
    return jts.overlay(_col(a), _col(b), jts.INTERSECTION)


def union(a, b) -> Column:
    return jts.overlay(_col(a), _col(b), jts.UNION)


def difference(a, b) -> Column:
    return jts.overlay(_col(a), _col(b), jts.DIFFERENCE)


def union_members(members: Column) -> Column:
    """Union of an ``array<binary>`` of geometries."""
    return jts.union_of(collection(members))
