"""Geometry methods as Spark columns.

Spark ships the JTS topology library on its class path.  This module is the only
place that touches it: it wraps JTS methods into Catalyst call expressions, so a
geometry test or a buffer runs inside the executor's generated code, next to the
other column expressions, with no Python worker.  Geometries travel between
operators as WKB ``binary`` columns; the JTS objects live only inside one expression.

Needs a classic (not Connect) session, because expressions are built over py4j.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

GEOM = "org.locationtech.jts.geom.Geometry"
ENVELOPE = "org.locationtech.jts.geom.Envelope"
POINT = "org.locationtech.jts.geom.Point"
LINE = "org.locationtech.jts.geom.LineString"

# Overlay operation codes of the JTS overlay entry point (fixed values).
INTERSECTION, UNION, DIFFERENCE = 1, 2, 3


def _jvm():
    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError("geometry columns need an active SparkSession")
    return context._jvm


def _once(make: Callable) -> Callable:
    """Remember what ``make`` gives for its arguments, per Java gateway: finding classes takes many calls."""
    known: dict[tuple, object] = {}

    @functools.wraps(make)
    def get(*args: str):
        key = (id(_jvm()), *args)
        if key not in known:
            known[key] = make(*args)
        return known[key]

    return get


@_once
def _class(name: str):
    jvm = _jvm()
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return jvm.java.lang.Class.forName(name, True, loader)


@_once
def _java(path: str):
    """A Java or Scala class by its dotted path."""
    found = _jvm()
    for name in path.split("."):
        found = getattr(found, name)
    return found


def _seq(items):
    out = _java("java.util.ArrayList")()
    for item in items:
        out.add(item)
    return _java("scala.jdk.javaapi.CollectionConverters").asScala(out).toSeq()


def _jvm_array(parts: list):
    """Java array of objects."""
    context = SparkContext._active_spark_context
    array = context._gateway.new_array(_jvm().java.lang.Object, len(parts))
    for k, part in enumerate(parts):
        array[k] = part
    return array


@_once
def _object(name: str):
    return _java("org.apache.spark.sql.types.ObjectType")(_class(name))


@_once
def _sql_type(name: str):
    return getattr(_java(f"org.apache.spark.sql.types.{name}Type$"), "MODULE$")


def _type(name: str):
    return _object(name) if "." in name else _sql_type(name)


@_once
def _none():
    return getattr(_java("scala.None$"), "MODULE$")


def _call(kind: str):
    return _java(f"org.apache.spark.sql.catalyst.expressions.objects.{kind}")


def expr(col: Column):
    """Catalyst expression behind a column."""
    return _java("org.apache.spark.sql.classic.ExpressionUtils").expression(col._jc)


def column(expression) -> Column:
    """Column around a Catalyst expression."""
    jc = _java("org.apache.spark.sql.classic.ExpressionUtils").column(expression)
    return type(F.lit(None))(jc)


def alias(expression, name: str, qualifier) -> Column:
    """The expression under a name and the qualifiers (a sequence) by which a query may call it."""
    owner = _java("org.apache.spark.sql.catalyst.expressions")
    number = getattr(_java("org.apache.spark.sql.catalyst.expressions.NamedExpression$"), "MODULE$").newExprId()
    return column(owner.Alias(expression, name, number, qualifier, _none(), _seq([])))


def invoke(target, method: str, returns: str, *args):
    """Call ``target.method(*args)``; any null gives null."""
    return _call("Invoke")(target, method, _type(returns), _seq(args), _seq([]), True, True, True)


def static(owner: str, method: str, returns: str, *args):
    return _call("StaticInvoke")(
        _class(owner), _type(returns), method, _seq(args), _seq([]), True, True, True, _none()
    )


def new(name: str, *args):
    return _call("NewInstance")(_class(name), _seq(args), _seq([]), False, _object(name), _none())


def number(value):
    """A literal or column argument as a double expression."""
    col = value if isinstance(value, Column) else F.lit(float(value))
    return expr(col.cast("double"))


def read(col: Column, kind: str = GEOM):
    """WKB column to geometry object."""
    return invoke(new("org.locationtech.jts.io.WKBReader"), "read", kind, expr(col))


def read_text(col: Column):
    """WKT column to geometry object."""
    text = invoke(expr(col), "toString", "java.lang.String")
    return invoke(new("org.locationtech.jts.io.WKTReader"), "read", GEOM, text)


def write(geometry) -> Column:
    """Geometry object to WKB column."""
    return column(invoke(new("org.locationtech.jts.io.WKBWriter"), "write", "Binary", geometry))


def string(value) -> Column:
    """Java string expression to string column."""
    return column(static("org.apache.spark.unsafe.types.UTF8String", "fromString", "String", value))


def number_of(col: Column, method: str, kind: str = GEOM) -> Column:
    return column(invoke(read(col, kind), method, "Double"))


def test(a: Column, method: str, b: Column, *args) -> Column:
    return column(invoke(read(a), method, "Boolean", read(b), *args))


def overlay(a: Column, b: Column, code: int) -> Column:
    owner = "org.locationtech.jts.operation.overlayng.OverlayNGRobust"
    return write(static(owner, "overlay", GEOM, read(a), read(b), expr(F.lit(code))))


def union_of(collection: Column) -> Column:
    owner = "org.locationtech.jts.operation.overlayng.OverlayNGRobust"
    return write(static(owner, "union", GEOM, read(collection)))
