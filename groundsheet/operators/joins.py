"""Joins by place and by distance.

**Cells by size.** Spark plans a join on a spatial test as a nested loop.  Here every
feature is put on a grid whose cell is about as large as the feature (cell sides are
powers of four), so it lies in at most a few cells of its own level whatever its size.
A pair meets on the level of its larger feature: each side also appears on the coarser
levels the other side has.  That turns the spatial test into an equi-join on
``(level, cx, cy)`` with the box test and the exact test as residual conditions, and it
needs no tuning for layers that mix parcels with continents.  A pair is kept only in the
cell that holds the lower-left corner of the two boxes' intersection, so no ``distinct``.

**Hot cells.** Cell populations are counted first (aggregated map-side).  A cell with more
rows than ``hot_rows`` is dealt over several reducers: one side's rows are spread over
salts, the other side's rows are repeated for each salt.  Where the layers could make many pairs, the
pairs of every cell are counted as well and cells are dealt by them (``dealing``).

**Rectangles.** Two shapes that are their own boxes are tested by comparing numbers; only pairs with another
shape are decoded.
"""

from __future__ import annotations

import math
from functools import partial
from operator import gt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.operators import dealing, lineage

BASE = 4.0
FINEST = -20
HOT_ROWS = 2_000_000
SALT_LIMIT = 4096
HOT_CELLS = 20_000

BOX = ("xmin", "ymin", "xmax", "ymax")


def with_bounds(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add the numeric box columns of a geometry column."""
    return G.with_bounds(df, geom)


def of(side: str, name: str) -> Column:
    """Column ``name`` of side ``a`` or ``b`` in a frame of pairs."""
    return F.col(f"{side}__{name}")


def level(width: Column, height: Column) -> Column:
    side = F.greatest(width, height, F.lit(BASE**FINEST))
    found = F.ceil(F.log(BASE, side)).cast("int")
    return F.greatest(F.lit(FINEST), found)


def _side(df: DataFrame, mark: str, box: tuple, grow: float) -> DataFrame:
    """The side's columns under names of their own, next to its box and level.

    Plain columns, not a struct of the row: what a caller does not use is pruned down to
    the scan.
    """
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in box)
    out = df.select(
        *[F.col(c).alias(f"{mark}__{c}") for c in df.columns],
        (x0 - grow).alias(f"{mark}_x0"),
        (y0 - grow).alias(f"{mark}_y0"),
        (x1 + grow).alias(f"{mark}_x1"),
        (y1 + grow).alias(f"{mark}_y1"),
    ).where(F.col(f"{mark}_x0").isNotNull() & F.col(f"{mark}_y0").isNotNull())
    size = (
        F.col(f"{mark}_x1") - F.col(f"{mark}_x0"),
        F.col(f"{mark}_y1") - F.col(f"{mark}_y0"),
    )
    return out.withColumn(f"{mark}_own", level(*size))


def _levels(side: DataFrame, name: str, mark: str) -> DataFrame:
    return side.groupBy(F.lit(name).alias("side"), F.col(f"{mark}_own").alias("own")).count()


def measured(left: DataFrame | None, right: DataFrame, a: str = "a", b: str = "b") -> dict[str, dict[int, int]]:
    """Rows per level of each side, in one job; as many values reach the driver as sizes differ by factors of four."""
    found = _levels(right, "b", b)
    if left is not None:
        found = found.union(_levels(left, "a", a))
    out: dict[str, dict[int, int]] = {"a": {}, "b": {}}
    for r in found.collect():
        out[r["side"]][r["own"]] = r["count"]
    return out


def _in_cells(side: DataFrame, mark: str, other_levels: set[int]) -> DataFrame:
    """One row per (level, cell) the feature appears in."""
    own = F.col(f"{mark}_own")
    known = sorted(other_levels)
    # on its own level a feature meets the finer (or equal) features of the other side
    levels = F.when(own >= F.lit(known[0]), F.array(own)).otherwise(F.array().cast("array<int>"))
    coarser = F.filter(F.array(*[F.lit(v) for v in known]), lambda v: v > own)
    levels = F.concat(levels, coarser)
    out = side.withColumn(f"{mark}_level", F.explode(levels))
    cell = F.pow(F.lit(BASE), F.col(f"{mark}_level").cast("double"))

    def span(lo: str, hi: str) -> Column:
        first = F.floor(F.col(f"{mark}_{lo}") / cell)
        return F.sequence(first, F.greatest(first, F.floor(F.col(f"{mark}_{hi}") / cell)))

    out = out.withColumn(f"{mark}_cx", F.explode(span("x0", "x1")))
    return out.withColumn(f"{mark}_cy", F.explode(span("y0", "y1")))


def _cell_names(mark: str) -> list[str]:
    return [f"{mark}_{k}" for k in ("level", "cx", "cy")]


def _hot(rows: int, cells: DataFrame, mark: str, hot_rows: int) -> dict[tuple, int]:
    """Salts per overfull cell; at most HOT_CELLS of the fullest come to the driver.

    Rows of cells beyond that list still join, on one reducer per cell or split by
    adaptive execution: the list only spreads work, it never decides membership.
    A layer with no more rows than the limit cannot have an overfull cell.
    """
    if rows <= hot_rows:
        return {}
    counts = cells.groupBy(*_cell_names(mark)).count().where(F.col("count") > hot_rows)
    rows = counts.orderBy(F.desc("count")).limit(HOT_CELLS).collect()
    return {tuple(r[:3]): min(SALT_LIMIT, math.ceil(r["count"] / hot_rows)) for r in rows}


def _salt_count(df: DataFrame, mark: str, hot: dict[tuple, int], name: str) -> DataFrame:
    """Number of salts of the row's cell, from the bounded list."""
    if not hot:
        return df.withColumn(name, F.lit(1))
    level, cx, cy = _cell_names(mark)
    table = df.sparkSession.createDataFrame([(*k, v) for k, v in hot.items()], f"{level} int, {cx} long, {cy} long, {name} int")
    # at most HOT_CELLS rows of four numbers
    joined = df.join(F.broadcast(table), [level, cx, cy], "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(1)))


def _deal(df: DataFrame, mark: str, mine: str, theirs: str, hot: tuple[dict, dict]) -> DataFrame:
    """Deal the rows of hot cells over salts of their own and repeat them for those of the other side."""
    names = df.columns
    spread = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if names.count(c) == 1 and "map<" not in t and t != "variant"])
    df = _salt_count(_salt_count(df, mark, hot[0], f"{mark}_n0"), mark, hot[1], f"{mark}_n1")
    df = df.withColumn(f"{mark}_s{mine}", F.pmod(spread, F.col(f"{mark}_n{mine}")).cast("int"))
    repeat = F.sequence(F.lit(0), F.col(f"{mark}_n{theirs}") - 1)
    return df.withColumn(f"{mark}_s{theirs}", F.explode(repeat)).drop(f"{mark}_n0", f"{mark}_n1")


def cell_join(left: DataFrame, right: DataFrame, a: str, b: str, levels: dict[str, dict[int, int]], hot_rows: int, first: Column | None = None) -> DataFrame:
    """Pairs of rows whose boxes meet, each once, with all columns of both sides.

    With ``first``, a test of a pair, rows of the left side instead, once for each cell in which
    the test holds with some row of the right side: the search of a cell ends at the first.

    ``a`` and ``b`` are the marks of the sides' box columns (``{mark}_x0`` to ``{mark}_y1``) and level
    (``{mark}_own``); columns are found by these names alone, so others may clash.
    """
    # an empty side: the join below finds nothing on any level
    left_levels, right_levels = (set(levels[m]) or {FINEST} for m in "ab")
    left, right = _in_cells(left, a, right_levels), _in_cells(right, b, left_levels)
    hot = tuple(_hot(sum(levels[m].values()), cells, mark, hot_rows) for m, cells, mark in (("a", left, a), ("b", right, b)))
    left_keys, right_keys = _cell_names(a), _cell_names(b)
    if any(hot):
        left, right = _deal(left, a, "0", "1", hot), _deal(right, b, "1", "0", hot)
        left_keys, right_keys = ([*keys, f"{m}_s0", f"{m}_s1"] for keys, m in ((left_keys, a), (right_keys, b)))
    if sum(levels["a"].values()) * sum(levels["b"].values()) > dealing.PAIRS:
        left, right, left_keys, right_keys = dealing.dealt(left, right, left_keys, right_keys, (a, b))

    def both(name: str) -> tuple[Column, Column]:
        return F.col(f"{a}_{name}"), F.col(f"{b}_{name}")

    cell = F.pow(F.lit(BASE), F.col(f"{a}_level").cast("double"))
    on = F.col(f"{a}_level") == F.greatest(*both("own"))
    on = on & dealing.same(left_keys, right_keys)
    for axis in "xy":
        on = on & (F.col(f"{a}_{axis}0") <= F.col(f"{b}_{axis}1")) & (F.col(f"{a}_{axis}1") >= F.col(f"{b}_{axis}0"))
        if first is None:
            on = on & (F.col(f"{a}_c{axis}") == F.floor(F.greatest(*both(f"{axis}0")) / cell))
    return left.join(right, on) if first is None else left.join(right, on & first, "left_semi")


def box_pairs(
    a: DataFrame,
    b: DataFrame,
    a_box: tuple = BOX,
    b_box: tuple = BOX,
    grow: float = 0.0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All pairs whose boxes meet (b's box grown by ``grow``), each once.

    The sides' columns are reached by ``of("a", name)`` and ``of("b", name)``; next to them
    stand the numeric boxes ``a_x0`` … ``b_y1``.
    """
    left = _side(a, "a", a_box, 0.0)
    right = _side(b, "b", b_box, grow)
    points = a_box[0] == a_box[2] and a_box[1] == a_box[3]
    levels = measured(None if points else left, right)
    if points:
        # a point layer has one level, the finest; a stored one is counted from its footers
        levels["a"] = {FINEST: a.count()}
    return cell_join(left, right, "a", "b", levels, hot_rows).select(
        *[f"a__{c}" for c in a.columns],
        *[f"b__{c}" for c in b.columns],
        *[f"{m}_{c}" for m in "ab" for c in ("x0", "y0", "x1", "y1")],
    )


def _flatten(pairs: DataFrame, a: DataFrame, b: DataFrame, prefix: str) -> DataFrame:
    taken = set(a.columns)
    out = [of("a", c).alias(c) for c in a.columns]
    for c in b.columns:
        name = f"{prefix}{c}"
        if name in taken:
            raise ValueError(f"column {name!r} exists on both sides; choose another prefix")
        out.append(of("b", c).alias(name))
    return pairs.select(*out)


def spatial_join(
    a: DataFrame,
    b: DataFrame,
    predicate: str = "intersects",
    *,
    a_geom: str = "geom",
    b_geom: str = "geom",
    a_box: tuple | None = None,
    b_box: tuple | None = None,
    prefix: str = "b_",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs for which ``predicate(a.geom, b.geom)`` holds.

    Result: a's columns, and b's columns with ``prefix``.  Pass the names of existing
    numeric box columns to skip decoding geometries for the candidate search.
    """
    if predicate not in G.PREDICATES:
        raise ValueError(f"unknown predicate {predicate!r}; one of {sorted(G.PREDICATES)}")
    left, right, a_box, b_box, drop = _boxed(a, b, a_geom, b_geom, a_box, b_box)
    flat = [left, right]
    left, right = (_without_rectangles(df, g, box) for df, g, box in ((left, a_geom, a_box), (right, b_geom, b_box)))
    if predicate == "equals":
        pairs = _same_boxes(left, right, a_box, b_box)
    else:
        pairs = box_pairs(left, right, a_box, b_box, hot_rows=hot_rows)
    needed, known = _by_boxes(predicate)
    shapes = (F.when(of(m, RECTANGLE), G.envelope(*(f"{m}_{k}" for k in ("x0", "y0", "x1", "y1")))).otherwise(of(m, SHAPE)) for m in "ab")
    exact = F.when(of("a", RECTANGLE) & of("b", RECTANGLE), known).otherwise(G.predicate(predicate, *shapes))
    pairs = pairs.where(needed & exact)
    for m, g in (("a", a_geom), ("b", b_geom)):
        pairs = pairs.withColumn(f"{m}__{g}", F.coalesce(of(m, SHAPE), of(m, OWN_SHAPE)))
    out = _flatten(pairs, *flat, prefix)
    return out.drop(*drop[0], *[f"{prefix}{c}" for c in drop[1]])


#: Whether a shape is its box; the shape if it is not, which tests need; and the shape if it is, which only results may need.
RECTANGLE, SHAPE, OWN_SHAPE = "_is_box", "_shape", "_own_shape"


def _without_rectangles(df: DataFrame, geom: str, box: tuple) -> DataFrame:
    """``df`` with its shapes in two columns, so that those of rectangles are not shuffled for a test by numbers."""
    df = df.withColumn(RECTANGLE, G.is_box(geom, *box))
    known = F.coalesce(F.col(RECTANGLE), F.lit(False))
    return df.withColumns({SHAPE: F.when(~known, F.col(geom)), OWN_SHAPE: F.when(known, F.col(geom))}).drop(geom)


def _same_boxes(left: DataFrame, right: DataFrame, a_box: tuple, b_box: tuple) -> DataFrame:
    """Pairs of rows with one and the same box: nothing else can be equal."""
    one, two = _side(left, "a", a_box, 0.0), _side(right, "b", b_box, 0.0)
    return one.join(two, dealing.same(*[[f"{m}_{k}" for k in ("x0", "y0", "x1", "y1")] for m in "ab"]))


def _by_boxes(predicate: str) -> tuple[Column, Column]:
    """What the boxes of a pair whose boxes meet must do for the test to hold, and what it is for two rectangles."""
    a, b = ({k: F.col(f"{m}_{k}") for k in ("x0", "y0", "x1", "y1")} for m in "ab")

    def around(one: dict, other: dict) -> Column:
        return (one["x0"] <= other["x0"]) & (one["x1"] >= other["x1"]) & (one["y0"] <= other["y0"]) & (one["y1"] >= other["y1"])

    inner = (a["x0"] < b["x1"]) & (a["x1"] > b["x0"]) & (a["y0"] < b["y1"]) & (a["y1"] > b["y0"])
    holds, held, any_ = around(a, b), around(b, a), F.lit(True)
    return {
        "intersects": (any_, any_),
        "contains": (holds, any_),
        "covers": (holds, any_),
        "within": (held, any_),
        "covered_by": (held, any_),
        "equals": (holds & held, any_),
        "touches": (any_, ~inner),
        "crosses": (any_, F.lit(False)),
        "overlaps": (any_, inner & ~holds & ~held),
    }[predicate]


def _boxed(a, b, a_geom, b_geom, a_box, b_box):
    """Box columns for the sides that come without, and what to drop again."""
    names = tuple(f"_{k}" for k in BOX)
    drop_a, drop_b = [], []
    if a_box is None:
        a, a_box, drop_a = G.with_bounds(a, a_geom, names), names, list(names)
    if b_box is None:
        b, b_box, drop_b = G.with_bounds(b, b_geom, names), names, list(names)
    return a, b, a_box, b_box, (drop_a, drop_b)


def point_in_polygon(
    points: DataFrame,
    polygons: DataFrame,
    *,
    x: str = "lon",
    y: str = "lat",
    geom: str | None = "geom",
    box: tuple | None = None,
    prefix: str = "b_",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Points that meet a polygon, borders included.

    ``geom=None`` says the polygons *are* their boxes: the box test is then exact and
    no geometry is decoded at all.
    """
    _, right, _, b_box, drop = _boxed(points, polygons, None, geom, (x, y, x, y), box)
    pairs = box_pairs(points, right, (x, y, x, y), b_box, hot_rows=hot_rows)
    if geom is not None:
        spot = G.point(of("a", x), of("a", y))
        pairs = pairs.where(G.predicate("intersects", of("b", geom), spot))
    out = _flatten(pairs, points, right, prefix)
    return out.drop(*[f"{prefix}{c}" for c in drop[1]])


def distance_join(
    a: DataFrame,
    b: DataFrame,
    within: float,
    *,
    a_geom: str = "geom",
    b_geom: str = "geom",
    a_xy: tuple[str, str] | None = None,
    b_xy: tuple[str, str] | None = None,
    prefix: str = "b_",
    distance: str | None = "distance",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs at most ``within`` apart, in the units of the coordinates.

    Point layers pass numeric coordinate columns (``a_xy``, ``b_xy``) and never decode
    a geometry.
    """
    a_box = (*a_xy, *a_xy) if a_xy else None
    b_box = (*b_xy, *b_xy) if b_xy else None
    left, right, a_box, b_box, drop = _boxed(a, b, a_geom, b_geom, a_box, b_box)
    pairs = box_pairs(left, right, a_box, b_box, grow=float(within), hot_rows=hot_rows)
    if a_xy and b_xy:
        dx = of("a", a_xy[0]) - of("b", b_xy[0])
        dy = of("a", a_xy[1]) - of("b", b_xy[1])
        apart = F.sqrt(dx * dx + dy * dy)
    else:
        shape_a = G.point(*[of("a", c) for c in a_xy]) if a_xy else of("a", a_geom)
        shape_b = G.point(*[of("b", c) for c in b_xy]) if b_xy else of("b", b_geom)
        apart = G.distance(shape_a, shape_b)
    pairs = pairs.withColumn("_apart", apart).where(F.col("_apart") <= float(within))
    out = [of("a", c).alias(c) for c in left.columns if c not in drop[0]]
    out += [of("b", c).alias(f"{prefix}{c}") for c in right.columns if c not in drop[1]]
    if distance:
        out.append(F.col("_apart").alias(distance))
    return pairs.select(*out)


def spatial_semi(a: DataFrame, b: DataFrame, key: str, predicate: str = "intersects", **kw) -> DataFrame:
    """Rows of a that meet some row of b; ``key`` identifies rows of a."""
    return a.join(_met_keys(a, b, key, predicate, kw), key, "left_semi")


def spatial_anti(a: DataFrame, b: DataFrame, key: str, predicate: str = "intersects", **kw) -> DataFrame:
    """Rows of a that meet no row of b."""
    return a.join(_met_keys(a, b, key, predicate, kw), key, "left_anti")


def _met_keys(a: DataFrame, b: DataFrame, key: str, predicate: str, kw: dict) -> DataFrame:
    def needed(df: DataFrame, names) -> DataFrame:
        flat = [n for n in dict.fromkeys(names) if n and n in df.columns]
        return df.select(*flat)

    a_geom, b_geom = kw.get("a_geom", "geom"), kw.get("b_geom", "geom")
    left = needed(a, [key, a_geom, *(kw.get("a_box") or ())])
    right = needed(b, [b_geom, *(kw.get("b_box") or ())])
    left, right, a_box, b_box, _ = _boxed(left, right, a_geom, b_geom, kw.get("a_box"), kw.get("b_box"))
    left, right = _side(left, "a", a_box, 0.0), _side(right, "b", b_box, 0.0)
    test = G.predicate(predicate, of("a", a_geom), of("b", b_geom))
    met = cell_join(left, right, "a", "b", measured(left, right), kw.get("hot_rows", HOT_ROWS), test)
    # distinct shrinks hot keys map-side before the semi join's shuffle
    return met.select(of("a", key).alias(key)).distinct()


def aggregate_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    key: str,
    aggs: list[Column],
    keep_empty: bool = True,
    **kw,
) -> DataFrame:
    """Aggregates of the points in each polygon; ``key`` identifies polygons.

    The points are joined on box columns only, aggregated per polygon key (map-side
    first) and only then joined back to the polygon attributes.
    """
    prefix = kw.pop("prefix", "polygon_")
    shape = [c for c in (key, kw.get("geom", "geom"), *(kw.get("box") or ())) if c]
    pairs = point_in_polygon(points, polygons.select(*dict.fromkeys(shape)), prefix=prefix, **kw)
    totals = pairs.groupBy(F.col(f"{prefix}{key}").alias(key)).agg(*aggs)
    return polygons.join(totals, key, "left" if keep_empty else "inner")


def distance_pairs(
    a: DataFrame,
    b: DataFrame,
    pairs: DataFrame,
    *,
    a_key: str,
    b_key: str,
    a_xy: tuple[str, str] | None = None,
    b_xy: tuple[str, str] | None = None,
    a_geom: str = "geom",
    b_geom: str = "geom",
) -> DataFrame:
    """Distance between the named features of each row of ``pairs``.

    ``pairs`` holds the columns ``a_key`` and ``b_key``; both lookups are equi-joins.
    Adds ``distance`` (coordinate units) and, between point layers, ``metres`` (great
    circle, for degrees).  A side without coordinate columns is a layer of shapes.
    """
    left = a.select(F.col(a_key), *_placed(a_xy, a_geom, "a"))
    right = b.select(F.col(b_key), *_placed(b_xy, b_geom, "b"))
    both = pairs.join(left, a_key).join(right, b_key)
    added = {"distance": _apart(a_xy, b_xy)}
    if a_xy and b_xy:
        added["metres"] = G.haversine("ax", "ay", "bx", "by")
    return both.withColumns(added).drop("ax", "ay", "bx", "by", "ag", "bg")


def _placed(xy: tuple[str, str] | None, geom: str, mark: str) -> list[Column]:
    """What a side's distances are worked out from: two numbers of a point, or the shape."""
    if xy:
        return [F.col(c).cast("double").alias(f"{mark}{axis}") for c, axis in zip(xy, "xy", strict=True)]
    return [F.col(geom).alias(f"{mark}g")]


def _apart(a_xy: tuple[str, str] | None, b_xy: tuple[str, str] | None) -> Column:
    if a_xy and b_xy:
        dx, dy = F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")
        return F.sqrt(dx * dx + dy * dy)
    one, other = (G.point(F.col(f"{m}x"), F.col(f"{m}y")) if xy else F.col(f"{m}g") for m, xy in (("a", a_xy), ("b", b_xy)))
    return G.distance(one, other)


# --- nearest neighbours ---------------------------------------------------------------

BOUNDS = ("x0", "y0", "x1", "y1")
#: A box within which some point of the shape is sure to lie: the middle, or the whole box of a shape that may miss it.
FAR = ("u0", "v0", "u1", "v1")
FAN = 4  # children of a cell, split at quantiles of its longer axis
LEAF_ROWS = 16
BROADCAST_DEPTH = 6  # at most FAN ** 6 = 4,096 summary rows by construction
SAMPLE = 1 << 15  # places, give or take the draw's noise, on which the upper levels are cut
SLACK = 1 + 1e-9  # of bounds, against rounding in the exact distance of shapes
TASK_ROWS = 2_000_000  # pairs that a task sorts, some hundred bytes each


def nearest(
    a: DataFrame,
    b: DataFrame,
    k: int = 1,
    *,
    a_key: str = "id",
    b_key: str = "id",
    a_xy: tuple[str, str] | None = ("lon", "lat"),
    b_xy: tuple[str, str] | None = ("lon", "lat"),
    a_geom: str = "geom",
    b_geom: str = "geom",
    prefix: str = "b_",
) -> DataFrame:
    """The ``k`` nearest rows of b for each row of a, exact, ties by ``b_key``.

    A side without coordinate columns (``a_xy=None``) is a layer of points, lines or
    polygons.  Keys identify rows; rows without a place are left out.

    Result: ``a_key``, ``{prefix}{b_key}``, ``distance``, ``rank``.
    """
    met = _met(a, b, k, a_key, b_key, a_xy, b_xy, a_geom, b_geom)
    if a_xy and b_xy:  # a point is its box
        both = met.select("ak", "bk", F.sqrt(_gaps()[0]).alias("distance"))
    else:
        left = a.select(F.col(a_key).alias("ak"), *_placed(a_xy, a_geom, "a"))
        right = b.select(F.col(b_key).alias("bk"), *_placed(b_xy, b_geom, "b"))
        cand = _within_reach(met, ["ak"], "bk", k, F.col("a_exact") & F.col("exact")).select("ak", "bk")
        both = cand.join(right, "bk").join(left, "ak").select("ak", "bk", _apart(a_xy, b_xy).alias("distance"))
    best = W.partitionBy("ak").orderBy("distance", "bk")
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("ak").alias(a_key), F.col("bk").alias(f"{prefix}{b_key}"), "distance", "rank"
    )


def _met(a: DataFrame, b: DataFrame, k: int, a_key: str, b_key: str, a_xy, b_xy, a_geom: str, b_geom: str) -> DataFrame:
    """Keys (ak, bk) and boxes of pairs among which the ``k`` nearest of every row of a are.

    b is cut at quantiles into a tree of cells, so one stray coordinate or one crowded
    city costs a level and not the whole index.  A cell keeps a row count and a tight
    box.  Rows of a are dealt to the same cells, and cell by cell they walk down the
    tree: the k-th smallest *farthest* distance to a box (weighted by counts) bounds the
    answer, and boxes whose *nearest* distance exceeds it are dropped.  The rows of a
    then repeat the step for the leaves left, and for the rows of b in them.  Copies of
    one shape are cut to the k first keys, which is all a result can need.
    """
    places = _boxes(b, b_key, b_xy, b_geom, "b")
    same = W.partitionBy(*(["x0", "y0"] if b_xy else ["shape"])).orderBy("key")
    places = places.withColumn("at", F.row_number().over(same)).where(F.col("at") <= k).drop("at", "shape")
    places = lineage.materialize(places, "places")
    rows = _boxes(a, a_key, a_xy, a_geom, "a").drop("shape", *FAR)
    n = places.count()
    depth = max(1, math.ceil(math.log(max(1.0, n / LEAF_ROWS), FAN)))
    places, rows = _dealt(places, rows, depth)
    levels = _tree(places, depth)
    groups = _tight(rows.groupBy("cell"), BOUNDS).withColumnsRenamed({"cell": "group", **{c: f"a_{c}" for c in BOUNDS}}).drop("n")
    cand = groups.withColumn("cell", F.lit(0).cast("long"))
    for d in range(1, depth + 1):
        cells = levels[d].withColumn("parent", F.floor(F.col("cell") / FAN)).withColumnRenamed("cell", "child")
        if d <= BROADCAST_DEPTH:
            cells = F.broadcast(cells)
        grown = cand.join(cells, F.col("cell") == F.col("parent"))
        cand = _within_reach(grown, ["group"], "child", k).select("group", *(f"a_{c}" for c in BOUNDS), F.col("child").alias("cell"))
    cand = lineage.materialize(cand.select("group", "cell"), "leaves")
    leaves = cand.join(levels[depth], "cell").withColumnRenamed("cell", "leaf")
    known = (*BOUNDS, "exact")
    mine = rows.withColumnRenamed("cell", "group").withColumnsRenamed({c: f"a_{c}" for c in known}).withColumnRenamed("key", "ak")
    meant = cand.join(rows.groupBy(F.col("cell").alias("group")).agg(F.count("*").alias("n")), "group")
    near = _within_reach(_by_rows(mine.join(leaves, "group"), meant), ["ak"], "leaf", k)
    near = lineage.materialize(near.select("ak", *(f"a_{c}" for c in known), F.col("leaf").alias("cell")), "near")
    met = near.join(places.withColumn("n", F.lit(1)).withColumnRenamed("key", "bk"), "cell")
    return _by_rows(met, near.join(levels[depth].select("cell", "n"), "cell"))


def _by_rows(pairs: DataFrame, meant: DataFrame) -> DataFrame:
    """The pairs, dealt by ``ak`` over as many tasks as their number asks for, the sum of ``n`` in ``meant``.

    What follows sorts them, and the bytes of either side say nothing of their number.
    """
    tasks = math.ceil(meant.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] / TASK_ROWS)
    return pairs.repartition(min(dealing.MOST_TASKS, tasks), "ak") if tasks > 1 else pairs


def _boxes(df: DataFrame, key: str, xy: tuple[str, str] | None, geom: str, mark: str) -> DataFrame:
    """key, box and middle (mx, my) of every row with a place; ``shape`` names equal places, ``exact`` says that it fills its box."""
    if xy:
        x, y = (F.col(c).cast("double") for c in xy)
        out = df.select(F.col(key).alias("key"), x.alias("x0"), y.alias("y0"), x.alias("x1"), y.alias("y1"), F.lit(None).cast("binary").alias("shape"))
        out = out.withColumn("exact", F.lit(True))
    else:
        named = df.select(F.col(key).alias("key"), F.col(geom).alias("shape"))
        out = G.with_bounds(named, "shape", BOUNDS)
        spot = (F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1"))
        out = out.withColumn("exact", spot | G.is_box("shape", *BOUNDS))
    out = out.where(F.col("key").isNotNull() & F.col("x0").isNotNull() & F.col("y0").isNotNull())
    out = out.withColumns({"mx": F.col("x0") / 2 + F.col("x1") / 2, "my": F.col("y0") / 2 + F.col("y1") / 2})
    return out.withColumns({u: F.when(F.col("exact"), F.col(m)).otherwise(F.col(x)) for u, m, x in zip(FAR, ("mx", "my", "mx", "my"), BOUNDS, strict=True)})


def _dealt(places: DataFrame, rows: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cell, a number of ``depth`` digits to the base FAN.

    A level cuts every cell at quantiles of its places along the axis on which they lie
    farther apart.  The quantiles may be rough: they decide how rows are dealt, never
    which are found.  The upper levels are cut on a bounded sample, those below it by
    aggregates over all places, a level at a time.
    """
    zero = F.lit(0).cast("long")
    n, spark = places.count(), places.sparkSession
    drawn = places.select("mx", "my").sample(min(1.0, SAMPLE / max(1, n)), seed=1).limit(2 * SAMPLE).collect()
    places, rows = places.withColumn("cell", zero), rows.withColumn("cell", zero)
    known = _sampled_marks([(r.mx, r.my) for r in drawn], min(depth, BROADCAST_DEPTH))
    shares = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    wide = F.max("mx") - F.min("mx") >= F.max("my") - F.min("my")
    for d in range(depth):
        if d < BROADCAST_DEPTH:
            marks = F.broadcast(spark.createDataFrame(known[d], "cell long, wide boolean, marks array<double>"))
        else:
            marks = lineage.materialize(places.groupBy("cell").agg(
                wide.alias("wide"), F.when(wide, F.percentile_approx("mx", shares, 1000)).otherwise(F.percentile_approx("my", shares, 1000)).alias("marks")
            ), "marks")
        middle = F.when(F.col("wide"), F.col("mx")).otherwise(F.col("my"))
        # in a cell without marks all rows go to the first child
        own = F.size(F.filter(F.coalesce("marks", F.array().cast("array<double>")), partial(gt, middle)))
        number = (F.col("cell") * FAN + own).cast("long")
        places = places.join(marks, "cell", "left").withColumn("cell", number).drop("marks", "wide")
        rows = rows.join(marks, "cell", "left").withColumn("cell", number).drop("marks", "wide")
        if d >= BROADCAST_DEPTH - 1:
            places = lineage.materialize(places, "places")
    return (places if depth >= BROADCAST_DEPTH else lineage.materialize(places, "places")), lineage.materialize(rows, "rows")


def _sampled_marks(spots: list[tuple[float, float]], depth: int) -> list[list[tuple]]:
    """For each level, (cell, wide, marks) of the cells of a bounded sample."""
    found, held = [], {0: spots}
    for _ in range(depth):
        level, below = [], {}
        for cell, mine in held.items():
            xs, ys = zip(*mine, strict=True) if mine else ((0.0,), (0.0,))
            axis = 0 if max(xs) - min(xs) >= max(ys) - min(ys) else 1
            values = sorted(p[axis] for p in mine)
            marks = [values[len(values) * i // FAN] for i in range(1, FAN)] if values else []
            level.append((cell, axis == 0, marks))
            for p in mine:
                below.setdefault(cell * FAN + sum(m < p[axis] for m in marks), []).append(p)
        found.append(level)
        held = below
    return found


def _tight(grouped, names: tuple = (*BOUNDS, *FAR), n: Column | None = None) -> DataFrame:
    ends = [(F.max if c.endswith("1") else F.min)(c).alias(c) for c in names]
    return grouped.agg((F.count("*") if n is None else n).alias("n"), *ends)


def _tree(places: DataFrame, depth: int) -> dict[int, DataFrame]:
    """Cell summaries per depth; each depth is aggregated from the one below it."""
    levels = {depth: lineage.materialize(_tight(places.groupBy("cell")), "cells")}
    for d in range(depth - 1, 0, -1):
        up = levels[d + 1].withColumn("cell", F.floor(F.col("cell") / FAN))
        levels[d] = _tight(up.groupBy("cell"), n=F.sum("n"))
    return levels


def _gaps() -> tuple[Column, Column]:
    """Squared distance from box a_x0 … to the nearest possible place in box x0 … and the farthest in box u0 …"""
    near, far = F.lit(0.0), F.lit(0.0)
    for lo, hi, first, last in (("x0", "x1", "u0", "u1"), ("y0", "y1", "v0", "v1")):
        gap = F.greatest(F.col(lo) - F.col(f"a_{hi}"), F.col(f"a_{lo}") - F.col(hi), F.lit(0.0))
        reach = F.greatest(F.abs(F.col(f"a_{hi}") - F.col(first)), F.abs(F.col(last) - F.col(f"a_{lo}")))
        near, far = near + gap * gap, far + reach * reach
    return near, far


def _within_reach(pairs: DataFrame, mine: list[str], order: str, k: int, exact: Column | None = None) -> DataFrame:
    """Pairs of a box (a_x0 …) and a box of n rows (x0 …) that can still hold one of the k nearest.

    ``exact`` marks pairs of single rows whose distance is that of their boxes; of those that meet, the
    k first in ``order`` are all a result can need.
    """
    near, far = _gaps()
    spare = F.lit(False)
    if exact is not None:
        far = F.when(exact, near).otherwise(far)
        spare = exact & (F.col("held") > k)
        for axis in "xy":
            spare = spare & (F.col(f"{axis}0") <= F.col(f"a_{axis}1")) & (F.col(f"{axis}1") >= F.col(f"a_{axis}0"))
    scored = pairs.withColumns({"near": near, "far": far})
    so_far = W.partitionBy(*mine).orderBy("far", order).rowsBetween(W.unboundedPreceding, W.currentRow)
    scored = scored.withColumn("held", F.sum("n").over(so_far))
    bound = F.min(F.when(F.col("held") >= k, F.col("far"))).over(W.partitionBy(*mine))
    kept = scored.withColumn("bound", bound).where(F.col("bound").isNull() | (F.col("near") <= F.col("bound") * SLACK))
    return kept.where(~spare).drop("near", "far", "held", "bound")
