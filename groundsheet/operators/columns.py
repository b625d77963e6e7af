"""Whole-column geometry jobs: decode, build, encode and read off geometry columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsheet.functions import esri, jts
from groundsheet.functions import geometry as G


def decode_geometry(df: DataFrame, col: str, fmt: str, out: str = "geom", on_error: str = "fail") -> DataFrame:
    """Text or WKB column to geometry.

    ``on_error='null'`` nulls texts that do not have the shape of WKT before the strict
    reader sees them; otherwise unreadable input fails the job.
    """
    if fmt == "wkb":
        return df.withColumn(out, jts.write(jts.read(F.col(col))))
    if fmt not in ("wkt", "geojson"):
        raise ValueError(f"unknown geometry format {fmt!r}")
    wkt = F.col(col) if fmt == "wkt" else G.geojson_to_wkt(col)
    if on_error == "null":
        wkt = F.when(G.looks_like_wkt(wkt), wkt)
    return df.withColumn(out, G.from_wkt(wkt))


def decode_esri(df: DataFrame, col: str, out: str = "geom", multi_shell: bool = False) -> DataFrame:
    """Feature-service geometry JSON to geometry; unrecognized shapes give null.

    Every ring after the first is read as a hole.  With ``multi_shell`` rings that lie
    outside the first become polygons of their own.
    """
    shape = G.from_wkt(esri.to_wkt(col))
    return df.withColumn(out, G.make_valid(shape) if multi_shell else shape)


def make_points(df: DataFrame, x: str, y: str, out: str = "geom") -> DataFrame:
    return df.withColumn(out, G.point(x, y))


def make_envelopes(df: DataFrame, x0: str, y0: str, x1: str, y1: str, out: str = "geom") -> DataFrame:
    return df.withColumn(out, G.envelope(x0, y0, x1, y1))


def encode_geometry(df: DataFrame, col: str, fmt: str, out: str) -> DataFrame:
    makers = {"wkt": G.as_wkt, "geojson": G.as_geojson, "wkb": F.col}
    if fmt not in makers:
        raise ValueError(f"unknown geometry format {fmt!r}")
    return df.withColumn(out, makers[fmt](col))


def geometry_accessors(df: DataFrame, col: str = "geom") -> DataFrame:
    """Kind, vertex count, validity; coordinates of points; ends of lines."""
    kind = G.kind(col)
    spot = F.when(kind == "POINT", F.col(col))
    return df.withColumns(
        {
            "geom_type": kind,
            "n_points": G.vertex_count(col),
            "is_valid": G.is_valid(col),
            "x": G.x(spot),
            "y": G.y(spot),
            "start_x": G.x(G.start_point(col)),
            "start_y": G.y(G.start_point(col)),
            "end_x": G.x(G.end_point(col)),
            "end_y": G.y(G.end_point(col)),
        }
    )


def bounds_columns(df: DataFrame, col: str = "geom") -> DataFrame:
    """Box geometry and numeric box columns."""
    return df.withColumns({**G.bounds(col), "envelope": G.box(col)})
