"""Layers from files and back: Parquet, saved feature-service pages, GeoJSON."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsheet.functions import esri
from groundsheet.functions import geometry as G
from groundsheet.layer import Layer, as_layer

PARQUET_ENDINGS = (".parquet", ".geoparquet")
REMOTE = ("http://", "https://", "s3://", "s3a://", "gs://", "abfss://", "hdfs://")


def is_parquet_reference(ref: str) -> bool:
    return ref.strip().lower().endswith(PARQUET_ENDINGS)


@dataclass(frozen=True)
class Places:
    """Where layers may be read from; both off by default."""

    local_root: str | None = None
    url_prefix: str | None = None

    def resolve(self, ref: str) -> str:
        ref = ref.strip()
        if ref.lower().startswith(REMOTE):
            return self._remote(ref)
        if self.local_root is None:
            raise PermissionError("local layers are disabled; name a root folder")
        root = os.path.realpath(self.local_root)
        path = os.path.realpath(os.path.join(root, ref))
        if os.path.commonpath([root, path]) != root:
            raise PermissionError(f"{ref!r} lies outside the allowed root")
        if not os.path.exists(path):
            raise FileNotFoundError(f"{ref!r} not found under the allowed root")
        return path

    def _remote(self, ref: str) -> str:
        if self.url_prefix is None:
            raise PermissionError("remote layers are disabled; name a URL prefix")
        prefix = self.url_prefix.rstrip("/") + "/"
        if not ref.startswith(prefix) or ".." in ref.split("/"):
            raise PermissionError(f"{ref!r} lies outside the allowed prefix")
        return ref


def read_geoparquet(spark: SparkSession, ref: str, places: Places, crs: int = 4326, box=None) -> Layer:
    """A Parquet layer; geometry stays WKB, pruning and pushdown are Spark's."""
    if not is_parquet_reference(ref):
        raise ValueError(f"{ref!r} is not a Parquet layer")
    return as_layer(spark.read.parquet(places.resolve(ref)), name=ref, crs=crs, box=box)


def write_layer(layer: Layer, path: str, cells: int = 256) -> None:
    """Rewrite a layer so that spatial filters skip files.

    Adds numeric box columns and range-partitions by map cell, so each file covers a
    small area and Parquet statistics on the box columns are selective.
    """
    df = layer.df
    if layer.box is None:
        df = df.withColumns(G.bounds(layer.geom))
        x0, y0 = "xmin", "ymin"
    else:
        x0, y0 = layer.box[:2]
    column = F.floor(F.col(x0) / F.lit(360.0 / cells)) if layer.crs == 4326 else F.col(x0)
    df.repartitionByRange(column, F.col(y0)).sortWithinPartitions(column, F.col(y0)).write.parquet(path)


def _features(spark: SparkSession, path: str, body: str, members: T.StructType | None, paged: bool, lines: bool) -> DataFrame:
    """One row per feature: its attribute struct and its geometry as JSON text.

    ``paged``: a document holds a ``features`` list; else every document is a feature.
    ``lines``: one document per line, which Spark can split; else one per file.
    """
    reader = spark.read.option("multiLine", str(not lines).lower())
    if members is None:
        found = reader.json(path).schema
        if paged:
            found = found["features"].dataType.elementType
        members = found[body].dataType
    feature = T.StructType([T.StructField(body, members), T.StructField("geometry", T.StringType())])
    if not paged:
        return reader.schema(feature).json(path)
    page = T.StructType([T.StructField("features", T.ArrayType(feature))])
    return reader.schema(page).json(path).select(F.inline("features"))


def read_featureset(
    spark: SparkSession,
    path: str,
    attributes: T.StructType | None = None,
    lines: bool = False,
    crs: int = 4326,
) -> Layer:
    """Saved feature-service pages to rows; give ``attributes`` to skip schema inference."""
    rows = _features(spark, path, "attributes", attributes, paged=True, lines=lines)
    df = rows.select("attributes.*", G.from_wkt(esri.to_wkt("geometry")).alias("geom"))
    return Layer(path, df, "geom", crs)


def read_geojson(
    spark: SparkSession,
    path: str,
    properties: T.StructType | None = None,
    lines: bool = False,
) -> Layer:
    """GeoJSON to rows: collections (one per file), or with ``lines`` one Feature per line."""
    rows = _features(spark, path, "properties", properties, paged=not lines, lines=lines)
    return Layer(path, rows.select("properties.*", G.from_geojson("geometry").alias("geom")), "geom")


def geojson_features(df: DataFrame, geom: str | None = "geom") -> DataFrame:
    """One text value per row: a Feature, or without geometry the row as JSON."""
    if geom is None:
        return df.select(F.to_json(F.struct("*")).alias("value"))
    rest = [c for c in df.columns if c != geom]
    properties = F.to_json(F.struct(*rest)) if rest else F.lit("{}")
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'),
            properties,
            F.lit(',"geometry":'),
            F.coalesce(G.as_geojson(geom), F.lit("null")),
            F.lit("}"),
        ).alias("value")
    )


def write_geojson(df: DataFrame, path: str, geom: str | None = "geom") -> None:
    geojson_features(df, geom).write.text(path)
