"""Structured query over one layer: filters, spatial filter, statistics, paging."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.functions import esri, project
from groundsheet.functions import geometry as G
from groundsheet.layer import Layer
from groundsheet.operators import guard

PAGE_DEFAULT = 100

# Service names of spatial relations (fixed values).
RELATIONS = {
    "esriSpatialRelIntersects": "intersects",
    "esriSpatialRelContains": "contains",
    "esriSpatialRelWithin": "within",
    "esriSpatialRelCrosses": "crosses",
    "esriSpatialRelOverlaps": "overlaps",
    "esriSpatialRelTouches": "touches",
}

# Statistic names, with synonyms (fixed values).
STATISTICS = {
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "stddev": F.stddev,
    "std": F.stddev,
    "var": F.variance,
    "variance": F.variance,
}

# Length of a unit in metres, by plain and service name (fixed values).
METRES = {
    "m": 1.0,
    "meters": 1.0,
    "metres": 1.0,
    "esriSRUnit_Meter": 1.0,
    "km": 1000.0,
    "kilometers": 1000.0,
    "kilometres": 1000.0,
    "esriSRUnit_Kilometer": 1000.0,
    "feet": 0.3048,
    "esriSRUnit_Foot": 0.3048,
    "miles": 1609.344,
    "esriSRUnit_StatuteMile": 1609.344,
    "esriSRUnit_NauticalMile": 1852.0,
}


@dataclass
class QueryResult:
    """``records`` is the page (or the statistics); ``total`` counts all matches."""

    records: DataFrame
    total: DataFrame


@dataclass
class FilterShape:
    wkb: bytes
    box: tuple[float, float, float, float]


def filter_shape(
    spark: SparkSession,
    geometry: dict,
    crs: int = 4326,
    buffer_distance: float | None = None,
    buffer_units: str | None = None,
) -> FilterShape:
    """The filter geometry as one literal, buffered once before any row is read.

    With units and a layer in degrees the buffer is made in the UTM zone of the
    geometry's centre; otherwise the distance is in layer units.
    """
    one = spark.range(1)
    wkt = one.select(esri.to_wkt(F.lit(json.dumps(geometry)))).first()[0]
    if wkt is None:
        raise ValueError("filter geometry not recognized")
    shape = G.from_wkt(F.lit(wkt))
    if buffer_distance:
        if buffer_units and buffer_units not in METRES:
            raise ValueError(f"unknown unit {buffer_units!r}")
        if buffer_units and crs == 4326:
            middle = G.centroid(shape)
            lon, lat = one.select(G.x(middle), G.y(middle)).first()
            zone = project.utm_code(lon, lat)
            flat = project.transform_geometry(shape, crs, zone)
            grown = G.buffer(flat, buffer_distance * METRES[buffer_units])
            shape = project.transform_geometry(grown, zone, crs)
        else:
            scale = METRES[buffer_units] if buffer_units else 1.0
            shape = G.buffer(shape, buffer_distance * scale)
    box = G.bounds(shape)
    row = one.select(shape.alias("g"), *[box[k].alias(k) for k in box]).first()
    return FilterShape(bytes(row["g"]), (row["xmin"], row["ymin"], row["xmax"], row["ymax"]))


def spatial_filter(layer: Layer, shape: FilterShape, relation: str) -> Column:
    """Box comparisons first (they reach the scan), then the exact test."""
    if layer.geom is None:
        raise ValueError(f"layer {layer.name} has no geometry for a spatial filter")
    if relation not in RELATIONS:
        warnings.warn(f"unknown spatial relation {relation!r}; using intersects", stacklevel=3)
    name = RELATIONS.get(relation, "intersects")
    exact = G.predicate(name, layer.geom, F.lit(bytearray(shape.wkb)))
    if layer.box is None:
        return exact
    x0, y0, x1, y1 = (F.col(c) for c in layer.box)
    lo_x, lo_y, hi_x, hi_y = shape.box
    near = (x0 <= hi_x) & (x1 >= lo_x) & (y0 <= hi_y) & (y1 >= lo_y)
    return near & exact


def order_terms(text: str) -> list[Column]:
    """Sort columns of ``a, b DESC``; nulls come last in both directions."""
    out = []
    for term in (t.split() for t in text.split(",")):
        if not 1 <= len(term) <= 2 or (len(term) == 2 and term[1].lower() not in ("asc", "desc")):
            raise guard.Refused(f"bad sort term {' '.join(term)!r}")
        falling = len(term) == 2 and term[1].lower() == "desc"
        c = F.col(term[0])
        out.append(c.desc_nulls_last() if falling else c.asc_nulls_last())
    return out


def matches(
    layer: Layer,
    where: str = "1=1",
    geometry: dict | None = None,
    spatial_rel: str = "esriSpatialRelIntersects",
    buffer_distance: float | None = None,
    buffer_units: str | None = None,
) -> DataFrame:
    """All rows that pass the attribute and the spatial filter."""
    spark = layer.df.sparkSession
    guard.check_fragment(spark, where)
    df = layer.df.where(F.expr(where))
    if geometry is not None:
        shape = filter_shape(spark, geometry, layer.crs, buffer_distance, buffer_units)
        df = df.where(spatial_filter(layer, shape, spatial_rel))
    return df


def query_data(
    layer: Layer,
    *,
    where: str = "1=1",
    out_fields: str = "*",
    geometry: dict | None = None,
    spatial_rel: str = "esriSpatialRelIntersects",
    buffer_distance: float | None = None,
    buffer_units: str | None = None,
    statistics: Sequence[tuple[str, str]] = (),
    group_by: str | None = None,
    order_by_fields: str | None = None,
    page_size: int | None = PAGE_DEFAULT,
    record_offset: int = 0,
    return_geometry: bool = False,
) -> QueryResult:
    """One structured query; ``page_size=None`` hands out every match for Spark work."""
    guard.check_fields(out_fields, "out_fields")
    found = matches(layer, where, geometry, spatial_rel, buffer_distance, buffer_units)
    total = found.agg(F.count("*").alias("totalMatchingRecords"))
    order = []
    if order_by_fields:
        guard.check_fields(order_by_fields, "order_by_fields")
        order = order_terms(order_by_fields)
    if statistics:
        stats = summarize(found, statistics, group_by)
        return QueryResult(stats.orderBy(*order) if order else stats, total)

    names = layer.fields if out_fields.strip() == "*" else [f.strip() for f in out_fields.split(",")]
    keep = [*names, layer.geom] if return_geometry and layer.geom not in (None, *names) else names
    page = (found.orderBy(*order) if order else found).select(*keep)
    if record_offset:
        page = page.offset(record_offset)
    if page_size is not None:
        page = page.limit(page_size)
    if return_geometry and layer.geom:
        # only the rows of the page are turned into text
        page = page.withColumn(layer.geom, G.as_geojson(layer.geom)).withColumnRenamed(
            layer.geom, "geometry"
        )
    return QueryResult(page, total)


def summarize(df: DataFrame, statistics: Sequence[tuple[str, str]], group_by: str | None = None) -> DataFrame:
    """Statistics named ``{kind}_{field}``, per group if asked; no cut of groups."""
    aggs = []
    for kind, field in statistics:
        guard.check_fields(field, "statistics field")
        make = STATISTICS.get(kind.lower())
        if make is None:
            raise ValueError(f"unknown statistic {kind!r}")
        aggs.append(make(field).alias(f"{kind.lower()}_{field}"))
    if not group_by:
        return df.agg(*aggs)
    guard.check_fields(group_by, "group_by")
    return df.groupBy(*[g.strip() for g in group_by.split(",")]).agg(*aggs)
