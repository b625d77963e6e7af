"""``ST_*`` names in SQL texts, as the same Catalyst expressions the operators use.

Spark parses a text; the tree is walked and each call of a geometry name becomes the column
function of that name, before Spark analyses the plan.  So geometry in SQL runs in generated
code like everywhere else, for every kind of geometry, with no Python worker.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.functions import jts, project


def _code(text: Column) -> int:
    """Number of a coordinate system given as a literal ``EPSG:n`` or ``n``."""
    said = jts.expr(text)
    if said.getClass().getSimpleName() != "Literal":
        raise ValueError("a coordinate system must be a literal")
    return int(str(said.value()).upper().removeprefix("EPSG:"))


def _bound(side: str) -> Callable[[Column], Column]:
    return lambda g: G.bounds(g)[side]


def _predicate(name: str) -> Callable[[Column, Column], Column]:
    return lambda a, b: G.predicate(name, a, b)


NAMES: dict[str, Callable[..., Column]] = {
    "ST_Point": lambda x, y: G.point(x.cast("double"), y.cast("double")),
    "ST_MakeEnvelope": lambda *corners: G.envelope(*(c.cast("double") for c in corners)),
    "ST_GeomFromText": G.from_wkt,
    "ST_GeomFromGeoJSON": G.from_geojson,
    "ST_GeomFromWKB": lambda wkb: wkb.cast("binary"),
    "ST_AsWKB": lambda g: g.cast("binary"),
    "ST_GeometryType": G.kind,
    "ST_AsText": G.as_wkt,
    "ST_AsGeoJSON": G.as_geojson,
    "ST_X": lambda g: G.x(F.when(G.kind(g) == "POINT", g)),
    "ST_Y": lambda g: G.y(F.when(G.kind(g) == "POINT", g)),
    "ST_XMin": _bound("xmin"),
    "ST_YMin": _bound("ymin"),
    "ST_XMax": _bound("xmax"),
    "ST_YMax": _bound("ymax"),
    "ST_NPoints": G.vertex_count,
    "ST_StartPoint": G.start_point,
    "ST_EndPoint": G.end_point,
    "ST_IsValid": G.is_valid,
    "ST_IsEmpty": G.is_empty,
    "ST_Area": G.area,
    "ST_Length": G.length,
    "ST_Perimeter": G.perimeter,
    "ST_Distance": G.distance,
    "ST_DWithin": G.within_distance,
    **{f"ST_{n}": _predicate(n.lower()) for n in ("Intersects", "Contains", "Within", "Covers", "Touches", "Crosses", "Overlaps", "Equals")},
    "ST_CoveredBy": _predicate("covered_by"),
    "ST_Disjoint": lambda a, b: ~G.predicate("intersects", a, b),
    "ST_Envelope": G.box,
    "ST_Centroid": G.centroid,
    "ST_ConvexHull": G.convex_hull,
    "ST_Buffer": G.buffer,
    "ST_Simplify": G.simplify,
    "ST_MakeValid": G.make_valid,
    "ST_FlipCoordinates": G.flip,
    "ST_Intersection": G.intersection,
    "ST_Union": G.union,
    "ST_Difference": G.difference,
    "ST_Union_Agg": lambda g: G.union_members(F.collect_list(g)),
    "ST_MakeLine": G.line_through,
    "ST_Collect": lambda g: G.collection(F.collect_list(g)),
    "ST_Extent": lambda g: G.envelope(*(f(G.bounds(g)[k]) for f, k in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax")))),
    "ST_Transform": lambda g, source, target: project.transform_geometry(g, _code(source), _code(target)),
}
BY_NAME = {name.lower(): use for name, use in NAMES.items()}
_TREE = "org.apache.spark.sql.catalyst.trees.TreeNode"
_PLAN = "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"


def _is_a(value: JavaObject, name: str) -> bool:
    return jts._class(name).isInstance(value)


def call(node: JavaObject) -> tuple[str, list[JavaObject]]:
    """Lower-case name and arguments of a call in a parsed text; an empty name for anything else."""
    if node.getClass().getSimpleName() != "UnresolvedFunction":
        return "", []
    given = node.arguments()
    return node.nameParts().last().lower(), [given.apply(k) for k in range(given.size())]


def with_arguments(node: JavaObject, given: list[JavaObject]) -> JavaObject:
    """A call with other arguments."""
    parts = [node.productElement(k) for k in range(node.productArity())]
    parts[1] = jts._seq(given).toList()
    return node.makeCopy(jts._jvm_array(parts))


def parsed_expression(spark: SparkSession, text: str) -> JavaObject:
    return _parser(spark).parseExpression(text)


def buffer_radius(node: JavaObject) -> str | None:
    """The radius of a call of ``ST_Buffer`` by a literal above zero."""
    name, given = call(node)
    if name != "st_buffer" or len(given) != 2 or given[1].getClass().getSimpleName() != "Literal":
        return None
    try:
        radius = str(given[1].value())
        return radius if 0 < float(radius) < float("inf") else None
    except ValueError:
        return None


def unbuffered(spark: SparkSession, node: JavaObject) -> JavaObject:
    """``ST_Intersects`` with a buffer as the distance test that it stands for; any other node as it is.

    The polygon that ``ST_Buffer`` gives lies inside the true buffer, so shapes that only
    reach the rounded part between two of its corners would be missed.
    """
    name, given = call(node)
    if name != "st_intersects" or len(given) != 2:
        return node
    radii = [buffer_radius(g) for g in given]
    if radii == [None, None]:
        return node
    shapes = [call(g)[1][0] if r else g for g, r in zip(given, radii, strict=True)]
    within = parsed_expression(spark, f"ST_DWithin(a, b, {' + '.join(f'{float(r)!r}D' for r in radii if r)})")
    return with_arguments(within, [*shapes, call(within)[1][2]])


def resolved(spark: SparkSession, node: JavaObject) -> JavaObject:
    """The tree with every geometry name resolved; plans that Spark has already analysed pass as they are."""
    if _is_a(node, _PLAN) and node.analyzed():
        return node
    node = unbuffered(spark, node)
    parts = [node.productElement(k) for k in range(node.productArity())]
    new = [mapped(spark, p, resolved) for p in parts]
    if any(a is not b for a, b in zip(new, parts, strict=True)):
        node = node.makeCopy(jts._jvm_array(new))
    name, given = call(node)
    use = BY_NAME.get(name)
    if use is not None:
        try:
            return spark._jsparkSession.expression(use(*map(jts.column, given))._jc)
        except TypeError as e:
            raise ValueError(f"{node.nameParts().last()}: wrong number of arguments") from e
    return node


def mapped(spark: SparkSession, part, change: Callable[[SparkSession, JavaObject], JavaObject]):
    """A part of a node: trees are changed; sequences, options and tuples are searched for trees."""
    if not isinstance(part, JavaObject):
        return part
    if _is_a(part, _TREE):
        return change(spark, part)
    if _is_a(part, "scala.collection.immutable.Seq"):
        items = [part.apply(k) for k in range(part.size())]
        new = [mapped(spark, i, change) for i in items]
        return jts._seq(new).toList() if any(a is not b for a, b in zip(new, items, strict=True)) else part
    if _is_a(part, "scala.Some"):
        new = mapped(spark, inner := part.get(), change)
        return part if new is inner else spark._jvm.scala.Some(new)
    if _is_a(part, "scala.Tuple2") or _is_a(part, "scala.Tuple3"):
        items = [part.productElement(k) for k in range(part.productArity())]
        new = [mapped(spark, i, change) for i in items]
        make = spark._jvm.scala.Tuple2 if len(items) == 2 else spark._jvm.scala.Tuple3
        return make(*new) if any(a is not b for a, b in zip(new, items, strict=True)) else part
    return part


def _parser(spark: SparkSession):
    return spark._jsparkSession.sessionState().sqlParser()


def parsed(spark: SparkSession, sql: str) -> JavaObject:
    """Spark's plan of a text, before analysis."""
    return _parser(spark).parsePlan(sql)


def frame(spark: SparkSession, plan: JavaObject) -> DataFrame:
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """The result of one query whose text may use geometry names; joins stay as Spark plans them."""
    return frame(spark, resolved(spark, parsed(spark, sql)))


def expression(spark: SparkSession, text: str) -> Column:
    """A filter or value whose text may use geometry names."""
    return jts.column(resolved(spark, parsed_expression(spark, text)))
