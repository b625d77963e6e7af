"""Geoprocessing jobs: new geometry at layer scale."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.functions import project
from groundsheet.operators import joins, lineage

GROUP_CAP = 2_000
TILE_FAN = 8
TILE_STEPS = 7


# --- row-wise jobs ------------------------------------------------------------------


def reproject_layer(df: DataFrame, source: int, target: int, geom: str = "geom") -> DataFrame:
    return df.withColumn(geom, project.transform_geometry(geom, source, target))


def reproject_points(df: DataFrame, source: int, target: int, x: str, y: str, out=("x", "y")) -> DataFrame:
    px, py = project.transform_xy(F.col(x), F.col(y), source, target)
    return df.withColumns({out[0]: px, out[1]: py})


def buffer_layer(df: DataFrame, radius, geom: str = "geom") -> DataFrame:
    return df.withColumn(geom, G.buffer(geom, radius))


def simplify_layer(df: DataFrame, tolerance: float, geom: str = "geom") -> DataFrame:
    return df.withColumn(geom, G.simplify(geom, tolerance))


def centroids(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumn(geom, G.centroid(geom))


def measure_layer(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumns(
        {"area": G.area(geom), "length": G.length(geom), "perimeter": G.perimeter(geom)}
    )


def flip_layer(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumn(geom, G.flip(geom))


def repair_layer(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Repair invalid rows only; ``was_fixed`` tells which."""
    bad = ~G.is_valid(geom)
    return df.withColumn("was_fixed", F.coalesce(bad, F.lit(False))).withColumn(
        geom, F.when(F.col("was_fixed"), G.make_valid(geom)).otherwise(F.col(geom))
    )


def snap_points(df: DataFrame, size: float, x: str, y: str) -> DataFrame:
    """Snap numeric coordinates to the nearest grid node."""
    return df.withColumns({c: F.round(F.col(c) / size) * size for c in (x, y)})


def snap_layer(df: DataFrame, size: float, geom: str = "geom") -> DataFrame:
    return df.withColumn(geom, G.snap(geom, size))


# --- two layers ---------------------------------------------------------------------


def clip_layer(a: DataFrame, mask: DataFrame, *, geom: str = "geom", mask_geom: str = "geom", **kw) -> DataFrame:
    """a's rows cut to each mask feature they meet; only a's attributes are kept."""
    wanted = [mask_geom, *(kw.get("b_box") or ())]
    pairs = joins.spatial_join(
        a, mask.select(*dict.fromkeys(wanted)), a_geom=geom, b_geom=mask_geom, prefix="_mask_", **kw
    )
    cut = G.intersection(geom, f"_mask_{mask_geom}")
    return pairs.withColumn(geom, cut).select(*a.columns)


def overlay_intersect(a: DataFrame, b: DataFrame, *, geom: str = "geom", b_geom: str = "geom", prefix: str = "b_", **kw) -> DataFrame:
    """Pairwise intersections with the attributes of both sides."""
    pairs = joins.spatial_join(a, b, a_geom=geom, b_geom=b_geom, prefix=prefix, **kw)
    return pairs.withColumn(geom, G.intersection(geom, f"{prefix}{b_geom}")).drop(f"{prefix}{b_geom}")


def _pieces(a, b, a_key: str, b_key: str | None, geom: str, b_geom: str, kw: dict) -> DataFrame:
    """Stored intersections of every meeting pair: ``_ak``, ``_bk``, ``_piece``."""
    slim_a = a.select(*dict.fromkeys([a_key, geom, *(kw.get("a_box") or ())]))
    b_columns = [b_geom, *(kw.get("b_box") or ())] + ([b_key] if b_key else [])
    pairs = joins.spatial_join(
        slim_a, b.select(*dict.fromkeys(b_columns)), a_geom=geom, b_geom=b_geom, prefix="_b_", **kw
    )
    keys = [F.col(a_key).alias("_ak")] + ([F.col(f"_b_{b_key}").alias("_bk")] if b_key else [])
    cut = G.intersection(geom, f"_b_{b_geom}").alias("_piece")
    return lineage.materialize(pairs.select(*keys, cut), "pieces")


def _rest(a: DataFrame, pieces: DataFrame, key: str, piece_key: str, geom: str) -> DataFrame:
    """a minus its pieces.  The pieces of one feature are merged in bounded steps, so a
    feature crossed by very many others is no single oversized group."""
    covers = merge_groups(pieces.select(piece_key, "_piece"), [piece_key], "_piece", G.union_members)
    # shapes that also touch leave lines and points in a cover; they take nothing from an
    # area, and the overlay does not accept them next to polygons
    mixed = (G.dimension(geom) == 2) & (G.kind("_piece") == "GEOMETRYCOLLECTION")
    cover = F.when(mixed, G.buffer("_piece", 0.0)).otherwise(F.col("_piece"))
    left = a.join(covers, a[key] == covers[piece_key], "left").withColumn(
        geom,
        F.when(F.col("_piece").isNull(), F.col(geom)).otherwise(G.difference(geom, cover)),
    )
    return left.where(~G.is_empty(geom)).drop("_piece", piece_key)


def erase(a: DataFrame, b: DataFrame, key: str, *, geom: str = "geom", b_geom: str = "geom", **kw) -> DataFrame:
    """a minus everything in b; rows that vanish are dropped, unmatched rows pass."""
    return _rest(a, _pieces(a, b, key, None, geom, b_geom, kw), key, "_ak", geom)


def overlay_union(a: DataFrame, b: DataFrame, a_key: str, b_key: str, *, geom: str = "geom", prefix: str = "b_", **kw) -> DataFrame:
    """All pieces of both layers: common pieces with both attribute sets, the rest with one.

    Columns of a keep their names, columns of b get ``prefix``; the missing side is null.
    One spatial join serves all three parts, because what b takes from a feature of a is
    the union of that feature's common pieces.
    """
    pieces = _pieces(a, b, a_key, b_key, geom, geom, kw)
    b_named = b.drop(geom).withColumnsRenamed({c: f"{prefix}{c}" for c in b.columns if c != geom})
    common = (
        pieces.join(a.drop(geom), F.col("_ak") == a[a_key])
        .join(b_named, F.col("_bk") == b_named[f"{prefix}{b_key}"])
        .drop("_ak", "_bk")
        .withColumnRenamed("_piece", geom)
    )
    only_a = _rest(a, pieces, a_key, "_ak", geom)
    only_b = _rest(b, pieces, b_key, "_bk", geom)
    only_b = only_b.withColumnsRenamed({c: f"{prefix}{c}" for c in b.columns if c != geom})
    return common.unionByName(only_a, allowMissingColumns=True).unionByName(
        only_b, allowMissingColumns=True
    )


def buffer_and_select(
    a: DataFrame,
    radius_m: float,
    b: DataFrame,
    *,
    metric: int,
    geom: str = "geom",
    crs: int = 4326,
    prefix: str = "b_",
) -> DataFrame:
    """Buffer a by metres, keep the buffers that meet a feature of b, hand out GeoJSON.

    Both layers are projected to ``metric`` for the distance work and the result goes
    back to ``crs``.
    """
    grown = buffer_layer(reproject_layer(a, crs, metric, geom), radius_m, geom)
    # made once: the join reads its sides more than once
    grown = lineage.materialize(joins.with_bounds(grown, geom), "buffers")
    flat = lineage.materialize(joins.with_bounds(reproject_layer(b, crs, metric, geom), geom), "flat")
    near = joins.spatial_join(
        grown, flat, a_geom=geom, b_geom=geom, a_box=joins.BOX, b_box=joins.BOX, prefix=prefix
    ).drop(*joins.BOX, *[f"{prefix}{c}" for c in joins.BOX])
    back = project.transform_geometry(geom, metric, crs)
    return near.withColumn("geojson", G.as_geojson(back)).drop(f"{prefix}{geom}")


# --- groups to one geometry ------------------------------------------------------------


def merge_groups(
    df: DataFrame,
    keys: Sequence[str],
    geom: str,
    combine: Callable[[Column], Column],
    cap: int = GROUP_CAP,
) -> DataFrame:
    """One geometry per key from a combine step that may be applied in any grouping.

    Small groups take one shuffle.  If some group is larger than ``cap``, exact copies
    are removed first (a union does not change), members are combined per map tile, and
    tiles are combined with their 63 neighbours step by step: no task ever holds more
    than ``cap`` raw members, and inner borders vanish before partial results travel.
    """
    keys = list(keys)
    shapes = df.select(*keys, geom).where(F.col(geom).isNotNull())
    fullest = shapes.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if fullest <= cap:
        return shapes.groupBy(*keys).agg(combine(F.collect_list(geom)).alias(geom))

    middle = lambda lo, hi: F.coalesce((F.col(lo) + F.col(hi)) / 2, F.lit(0.0))
    boxed = G.with_bounds(shapes.distinct(), geom, ("_x0", "_y0", "_x1", "_y1"))
    boxed = boxed.withColumns({"mx": middle("_x0", "_x1"), "my": middle("_y0", "_y1")})
    shapes = lineage.materialize(boxed.drop("_x0", "_y0", "_x1", "_y1"), "shapes")
    x0, x1, y0, y1 = shapes.agg(F.min("mx"), F.max("mx"), F.min("my"), F.max("my")).first()
    for steps in range(1, TILE_STEPS + 1):
        tiled = shapes.withColumns(
            {"tx": _tile("mx", x0, x1, steps), "ty": _tile("my", y0, y1, steps)}
        )
        fullest = tiled.groupBy(*keys, "tx", "ty").count().agg(F.max("count")).first()[0]
        if fullest <= cap:
            break
    # only shapes crowded into one smallest tile are left to be split by hash
    salts = math.ceil(fullest / cap)
    part = tiled.withColumn("salt", F.pmod(F.xxhash64(geom), F.lit(salts)))
    while salts > 1:
        part = part.groupBy(*keys, "tx", "ty", "salt").agg(
            combine(F.collect_list(geom)).alias(geom)
        )
        salts = math.ceil(salts / cap)
        part = part.withColumn("salt", F.pmod(F.col("salt"), F.lit(salts)))
    part = part.groupBy(*keys, "tx", "ty").agg(combine(F.collect_list(geom)).alias(geom))
    for _ in range(steps):
        up = [F.floor(F.col(c) / TILE_FAN).alias(c) for c in ("tx", "ty")]
        part = part.groupBy(*keys, *up).agg(combine(F.collect_list(geom)).alias(geom))
    return part.drop("tx", "ty")


def _tile(c: str, lo: float, hi: float, steps: int) -> Column:
    per_axis = TILE_FAN**steps
    spot = F.floor((F.col(c) - F.lit(lo)) / F.lit((hi - lo) or 1.0) * per_axis)
    return F.least(F.lit(per_axis - 1), F.greatest(F.lit(0), spot)).cast("long")


def dissolve(df: DataFrame, by: Sequence[str], geom: str = "geom", cap: int = GROUP_CAP) -> DataFrame:
    """Merge features that share attributes into one geometry per value."""
    return merge_groups(df, by, geom, G.union_members, cap)


def hulls(df: DataFrame, by: Sequence[str] | None = None, geom: str = "geom", cap: int = GROUP_CAP) -> DataFrame:
    """Convex hull per row, or per group (hulls of hulls, in bounded steps)."""
    if not by:
        return df.withColumn(geom, G.convex_hull(geom))
    return merge_groups(df, by, geom, lambda members: G.convex_hull(G.collection(members)), cap)


def collect_layer(df: DataFrame, by: Sequence[str], geom: str = "geom", part_by: Column | None = None) -> DataFrame:
    """Gather each group into one geometry collection, with the number of its ``members``.

    A collection is one value in one row.  For groups that no row can hold, ``part_by`` names parts
    (a tile, a bucket of ids, …) and each part of a group is a row of its own, numbered by ``part``.
    """
    members = df.select(*by, geom, *([part_by.alias("part")] if part_by is not None else [])).where(F.col(geom).isNotNull())
    keys = [*by, "part"] if part_by is not None else list(by)
    return members.groupBy(*keys).agg(
        F.count("*").alias("members"), G.collection(F.collect_list(geom)).alias(geom)
    )


def make_lines(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    x: str = "lon",
    y: str = "lat",
    part_by: Column | None = None,
) -> DataFrame:
    """Ordered points to lines, one per key.

    A line is one value in one row.  For keys that no row can hold, ``part_by`` cuts lines at the
    same places whatever their size: a value that rises with the order, such as a day.  Each part
    is a row (column ``part``) and begins where the part before it ends.
    """
    keys, order_by = list(keys), list(order_by)
    spots = df.select(
        *keys, *order_by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
        *([part_by.alias("part")] if part_by is not None else []),
    ).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    whole = [*keys, "part"] if part_by is not None else keys
    lines = spots.groupBy(*whole).agg(F.array_sort(F.collect_list(F.struct(*order_by, "x", "y"))).alias("v"))
    if part_by is not None:
        before = F.lag(F.element_at("v", -1)).over(W.partitionBy(*keys).orderBy("part"))
        lines = lines.withColumn("before", before)
        lines = lines.withColumn("v", F.when(F.col("before").isNull(), F.col("v")).otherwise(F.array_prepend("v", F.col("before"))))
    return lines.select(*whole, F.size("v").alias("vertices"), G.line_from_vertices(F.col("v")).alias("geom"))


def layer_extent(df: DataFrame, by: Sequence[str] | None = None, geom: str = "geom", box: tuple | None = None) -> DataFrame:
    """Bounding box of a layer or of each group; plain min/max with map-side partials."""
    if box is None:
        df = joins.with_bounds(df, geom)
        box = joins.BOX
    aggs = [
        F.min(box[0]).alias("xmin"),
        F.min(box[1]).alias("ymin"),
        F.max(box[2]).alias("xmax"),
        F.max(box[3]).alias("ymax"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def grid_bin(
    df: DataFrame,
    size: float,
    aggs: list[Column],
    x: str = "lon",
    y: str = "lat",
    snap: str = "round",
) -> DataFrame:
    """Square-grid binning: ``round`` names a cell by its nearest node, ``floor`` by its corner."""
    to_node = {"round": F.round, "floor": F.floor}[snap]
    node = {f"cell_{n}": to_node(F.col(c) / size) * size for n, c in (("x", x), ("y", y))}
    return df.withColumns(node).groupBy("cell_x", "cell_y").agg(*aggs)
