"""One large JSON document read by many tasks.

A feature collection may be one file of any size, with or without line breaks.  Spark's text source
reads it in ranges of bytes, cut at closing braces.  Whether a range starts inside a string, and
how deep, depends on all ranges before it; but what a range does to either start is found
without knowing it.  So a first pass sums up each range for both starts (does it flip the
string state; how far does it go up or down), a running sum over these few rows gives every
range its start, and a second pass cuts the members of arrays at the document's top out of each
range.  A member that crosses ranges is put together from its pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsheet.functions import esri
from groundsheet.functions import geometry as G
from groundsheet.layer import Layer

_MARKS = re.compile(rb'\\.|["{}\[\]]', re.S)
#: Depth at which a member of an array of the top object opens: the object, the array, the member.
MEMBER = 3
_RANGE = "file string, start long"
_SUMS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("flips", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64())])
_PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("text", pa.string())])
WHOLE, HEAD, MIDDLE, TAIL = "whole", "head", "middle", "tail"


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """Pieces that ended in a closing brace, in order within each range (file, start)."""
    pieces = spark.read.option("lineSep", "}").text(path)
    return pieces.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True):
            if held is None or held[:2] != [file, start]:
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(held, _SUMS.types, strict=True)], schema=_SUMS)
                held = [file, start, 0, 0, 0]
            flips, depths = held[2], held[3:]
            for mark in _MARKS.findall(value + b"}"):
                if mark == b'"':
                    flips += 1
                elif len(mark) == 1:
                    # of the two starts, one is outside a string here: the first after an even number of quotes
                    depths[flips % 2] += 1 if mark in b"{[" else -1
            held[2:] = [flips, *depths]
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(held, _SUMS.types, strict=True)], schema=_SUMS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members and pieces of members of ranges with a known start."""
    at, quoted, depth, opened, kept = None, False, 0, None, []
    out: list[tuple] = []

    def finish() -> None:
        if opened is not None and at:
            out.append((*at, TAIL if opened else MIDDLE, b"".join(kept).decode("utf-8", "replace")))

    def flushed() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECES.types, strict=True)], schema=_PIECES)
        out.clear()
        return found

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "start", "value", "quoted", "depth")]
        for file, start, value, starts_quoted, starts_depth in zip(*columns, strict=True):
            if at != (file, start):
                finish()
                at, quoted, depth = (file, start), bool(starts_quoted), starts_depth
                # opened: true for a member that opens in this range, false for one from before, none outside
                opened, kept = (False if depth >= MEMBER else None), []
            data, since = value + b"}", 0
            for found in _MARKS.finditer(data):
                mark = found.group()
                if mark == b'"':
                    quoted = not quoted
                elif quoted or len(mark) > 1:
                    continue
                elif mark in b"{[":
                    depth += 1
                    if depth == MEMBER and opened is None:
                        opened, kept, since = True, [], found.start()
                else:
                    depth -= 1
                    if depth == MEMBER - 1 and opened is not None:
                        kept.append(data[since : found.end()])
                        out.append((*at, WHOLE if opened else HEAD, b"".join(kept).decode("utf-8", "replace")))
                        opened, kept = None, []
            if opened is not None:
                kept.append(data[since:])
            if len(out) >= 1000:
                yield flushed()
    finish()
    if out:
        yield flushed()


def array_members(spark: SparkSession, path: str) -> DataFrame:
    """file and text of every object or array that is a member of an array of a document's top object.

    The path names files of one document each.  Broken documents give the members that are
    whole.  The start of each range is one short row for every 128 MB of files; it goes to all
    tasks, so that the text is not shuffled.
    """
    ranges = _ranges(spark, path)
    sums = ranges.mapInArrow(_sums, f"{_RANGE}, flips long, outside long, inside long")
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    known = sums.withColumn("quoted", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    moved = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    known = known.withColumn("depth", F.coalesce(F.sum(moved).over(before), F.lit(0))).select("file", "start", "quoted", "depth")
    told = ranges.join(F.broadcast(known), ["file", "start"]).select("file", "start", "value", "quoted", "depth")
    pieces = told.mapInArrow(_cut, f"{_RANGE}, kind string, text string")
    in_order = W.partitionBy("file").orderBy("start", F.col("kind") == TAIL)
    torn = pieces.where(F.col("kind") != WHOLE).withColumn("member", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    joined = torn.groupBy("file", "member").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "").alias("text"),
        F.max(F.col("kind") == HEAD).alias("ends"), F.max(F.col("kind") == TAIL).alias("begins"),
    )
    return pieces.where(F.col("kind") == WHOLE).select("file", "text").union(joined.where("ends and begins").select("file", "text"))


def _records(spark: SparkSession, path: str, body: str, members: T.StructType | None) -> DataFrame:
    texts = array_members(spark, path).select("text")
    if members is None:
        # Spark infers a schema from texts only if they come as an RDD; a given schema skips this reading
        members = spark.read.json(texts.rdd.map(lambda r: r.text)).schema[body].dataType
    kind = T.StructType().add("type", "string").add(body, members).add("geometry", "string")
    return texts.select(F.from_json("text", kind).alias("m")).select("m.*")


def read_geojson_documents(spark: SparkSession, path: str, properties: T.StructType | None = None) -> Layer:
    """GeoJSON collections of any size, one a file; members of other arrays are left out."""
    rows = _records(spark, path, "properties", properties).where("type = 'Feature'")
    return Layer(path, rows.select("properties.*", G.from_geojson("geometry").alias("geom")), "geom")


def read_featureset_documents(spark: SparkSession, path: str, attributes: T.StructType | None = None, crs: int = 4326) -> Layer:
    """Feature-service documents of any size, one a file; members of other arrays (fields, say) have no attributes and are left out."""
    rows = _records(spark, path, "attributes", attributes).where("attributes is not null")
    return Layer(path, rows.select("attributes.*", G.from_wkt(esri.to_wkt("geometry")).alias("geom")), "geom", crs)
