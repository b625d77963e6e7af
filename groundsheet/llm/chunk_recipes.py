"""Exact duplicates by content-defined chunks: texts are equal when their lists of verified chunks are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsheet.llm.texts import slices
from groundsheet.operators.lineage import materialize

#: A chunk may end where the rolling hash of the last WINDOW bytes has this many leading zeros: 1 KB on average.
CUT_BITS, WINDOW = 10, 32
#: Bytes of the shortest and the longest chunk; a text's last chunk may be shorter.
SHORTEST, LONGEST = 256, 8192
#: Bytes whose rolling hashes are worked out at a time.
BLOCK = 1 << 20
#: Bits of a chunk's hash; equal hashes of unequal chunks are told apart, whatever their number.
HASH_BITS = 63
#: Rows of a group of copies meet the group on so many salts.
SALTS = 16
_GEAR = np.random.default_rng(42).integers(0, 1 << 32, 256, dtype=np.uint32)

_CHUNKED = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int64()), ("text_sha256", pa.string()),
    ("recipe", pa.list_(pa.struct([("hash", pa.int64()), ("copy", pa.int32())]))),
    ("fresh", pa.list_(pa.struct([("hash", pa.int64()), ("copy", pa.int32()), ("content", pa.binary())]))),
])


def normalised(text: bytes) -> bytes:
    """Each run of ``[\\x20\\x09-\\x0D]`` as one space."""
    words = text.split()  # of bytes: ASCII white space only
    if not words:
        return b" " if text else b""
    return (b" " if text[:1].isspace() else b"") + b" ".join(words) + (b" " if text[-1:].isspace() else b"")


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; away from its start they depend on the bytes around them only."""
    if len(data) <= SHORTEST:
        return [len(data)] if data else []
    found = []
    values = np.frombuffer(data, np.uint8)
    for start in range(0, len(data), BLOCK):
        low = max(0, start - WINDOW + 1)
        rolled = _GEAR[values[low : start + BLOCK]]
        step = 1
        while step < WINDOW:  # each pass doubles the bytes that a hash has seen
            seen = rolled.copy()
            seen[step:] += rolled[:-step] << np.uint32(step)
            rolled, step = seen, 2 * step
        at = np.flatnonzero(rolled[start - low :] >> np.uint32(32 - CUT_BITS) == 0)
        found.append(at + start + 1)
    marks = np.concatenate(found)
    ends, last = [], 0
    while last + SHORTEST < len(data):
        k = int(np.searchsorted(marks, last + SHORTEST))
        last = min(int(marks[k]) if k < len(marks) else len(data), last + LONGEST, len(data))
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


def chunk_documents(documents: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """doc_id, text_sha256, recipe and fresh of every row, with ``part``, the slice of a task it was worked on in.

    ``recipe`` lists the chunks of the normalised text in order, each as its hash and its number
    among the chunks of that hash in the slice; ``fresh`` holds the content of those that the slice
    had not met before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        mask = (1 << bits) - 1
        for number, batch in enumerate(slices(batches)):
            known: dict[int, list[bytes]] = {}
            rows = []
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc_id, text in zip(ids, texts, strict=True):
                data, start, recipe, fresh = normalised(text or b""), 0, [], []
                for end in cuts(data):
                    content, start = data[start:end], end
                    key = xxhash.xxh3_64_intdigest(content) & mask
                    same = known.setdefault(key, [])
                    if content not in same:
                        same.append(content)
                        fresh.append({"hash": key, "copy": len(same) - 1, "content": content})
                    recipe.append({"hash": key, "copy": same.index(content)})
                rows.append((doc_id, task + number, hashlib.sha256(data).hexdigest(), recipe, fresh))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CHUNKED.types, strict=True)], schema=_CHUNKED)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return docs.mapInArrow(
        run,
        "doc_id long, part long, text_sha256 string, recipe array<struct<hash:long,copy:int>>, "
        "fresh array<struct<hash:long,copy:int,content:binary>>",
    )


def verified_recipes(chunked: DataFrame) -> DataFrame:
    """row, doc_id, text_sha256 and ids, the ordered identifiers of a text's chunks, of every chunked row.

    Contents are brought together once, copies removed before the shuffle.  A hash of one content is
    that content's identifier; contents that share a hash get negative numbers of their own.
    """
    contents = chunked.select(F.inline("fresh")).select("hash", "content").distinct()
    twins = materialize(contents.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared-hashes")
    plain = chunked.select("row", "doc_id", "text_sha256", F.transform("recipe", lambda c: c["hash"]).alias("ids"))
    if twins.isEmpty():
        return plain
    named = contents.join(twins, "hash", "left_semi").withColumn("ident", -1 - F.monotonically_increasing_id())
    named = materialize(named, "chunk-names")
    local = chunked.select("part", F.inline("fresh")).join(named, ["hash", "content"]).select("part", "hash", "copy", "ident")
    steps = chunked.select("row", "part", F.posexplode("recipe").alias("pos", "chunk")).select("row", "part", "pos", "chunk.*")
    told = steps.join(local, ["part", "hash", "copy"], "left").select("row", "pos", F.coalesce("ident", "hash").alias("ident"))
    lists = told.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "ident"))).alias("steps"))
    lists = lists.select(F.col("row").alias("r"), F.transform("steps", lambda s: s["ident"]).alias("told"))
    joined = plain.join(lists, F.col("row") == F.col("r"), "left")
    return joined.select("row", "doc_id", "text_sha256", F.coalesce("told", "ids").alias("ids"))


def exact_groups(documents: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``documents``, dropped ones too.

    Texts are equal when identical after replacing each run of ``[\\x20\\x09-\\x0D]`` by one space
    (a leading or trailing run too); null counts as empty, and all empty texts are one group.  Of
    equal texts the row with the smallest doc_id stays; of rows that share this doc_id as well, one.
    Rows with a null doc_id come after all others; a group of such rows alone has a null keep_id and
    keeps one row.  Only ``doc_id`` and ``text`` are read, so other columns cannot clash; an empty
    table gives no rows.

    A text's bytes move once, as chunks, and only one copy of a chunk leaves a slice of 2 MB;
    after that, lists of eight bytes a chunk stand for texts.
    """
    chunked = chunk_documents(documents, bits).withColumn("row", F.monotonically_increasing_id())
    recipes = verified_recipes(materialize(chunked, "chunked"))
    recipes = recipes.withColumn("key", F.xxhash64("ids"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    groups = recipes.groupBy("key", "ids").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = recipes.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    joined = salted.join(groups, ["key", "ids", "salt"], "left")
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )
