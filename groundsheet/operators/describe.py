"""What a layer holds: fields with samples and hints, and its extent."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.layer import Layer
from groundsheet.operators import joins

SAMPLE_ROWS, SAMPLE_VALUES = 5, 3

# Substrings that give a field its value hint, tested in this order (fixed values).
TIME_TYPES = ("date", "time")
TITLE_NAMES = ("name", "title", "city", "label")
NUMBER_TYPES = ("int", "double", "single", "float", "oid", "decimal")


def field_value_type(name: str, kind: str) -> str:
    name, kind = name.lower(), kind.lower()
    if any(w in kind for w in TIME_TYPES):
        return "dateAndTime"
    if any(w in name for w in TITLE_NAMES):
        return "nameOrTitle"
    return "countOrAmount" if any(w in kind for w in NUMBER_TYPES) else "text"


def describe_layer(layer: Layer, order_by: str | None = None) -> DataFrame:
    """One row per field; geometry is never sampled.

    Samples come from the first five rows, by ``order_by`` where a caller wants the same ones each time.
    """
    spark = layer.df.sparkSession
    source = layer.df.orderBy(order_by) if order_by else layer.df
    shown = source.select(*layer.fields).limit(SAMPLE_ROWS)
    samples = [json.loads(r[0]) for r in shown.select(F.to_json(F.struct("*"))).collect()] if layer.fields else []
    rows = []
    for name, kind in layer.df.dtypes:
        values = [s[name] for s in samples if s.get(name) is not None][:SAMPLE_VALUES]
        texts = [v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values]
        alias = layer.aliases.get(name, name)
        rows.append((name, kind, alias, field_value_type(name, kind), texts, name == layer.geom))
    schema = (
        "name string, type string, alias string, fieldValueType string, "
        "sampleValues array<string>, isGeometry boolean"
    )
    return spark.createDataFrame(rows, schema)


def layer_summary(layer: Layer) -> DataFrame:
    """Row count, geometry kinds, extent and coordinate system in one aggregate."""
    if layer.geom is None:
        raise ValueError(f"layer {layer.name} has no geometry")
    df = layer.df
    box = layer.box
    if box is None:
        df, box = joins.with_bounds(df.select(layer.geom), layer.geom), joins.BOX
    return df.agg(
        F.count("*").alias("records"),
        F.array_sort(F.collect_set(G.kind(layer.geom))).alias("geometryTypes"),
        F.min(box[0]).alias("xmin"),
        F.min(box[1]).alias("ymin"),
        F.max(box[2]).alias("xmax"),
        F.max(box[3]).alias("ymax"),
        F.lit(layer.crs).alias("spatialReference"),
    )
