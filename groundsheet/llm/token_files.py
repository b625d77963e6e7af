"""Token ids of a corpus in wavelet-matrix shard files."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundsheet.llm.texts import filled, slices, split_words
from groundsheet.llm.wavelet import WaveletMatrix, build

#: A shard is closed once it holds so many tokens; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 18
#: Distinct words whose ids a worker keeps between batches.
KEPT_WORDS = 800_000
#: Text bytes encoded at a time.
BATCH_BYTES = 12 << 20
#: Text bytes a range partition should hold.
PART_BYTES = 64 << 20

_SHARDS = "part int, base long, doc_ids array<long>, ends array<long>, n_tokens long, payload binary"
#: Stands between words of letters that are encoded together; it keeps an id of its own.
_SIGN = " ! "
#: A run of letters and one of these signs always meet at a boundary of the tokenizer's own split.
_LETTERS_SIGNS = r"^(?P<a>\p{L}+)(?P<b>[.,!?;:#*$%&|]+)$"
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of whole texts for a tokenizer that folds A-Z, splits at white space and drops it.

    For such a tokenizer a text's ids are those of its words in order, so each distinct word of a
    batch is encoded once.  ``__init__`` checks that the tokenizer is of this kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self._plain(["A b\n c,"])[0] != sum(self._plain(["a", "b", "c", ","]), []):
            raise ValueError("white space is part of this tokenizer's pieces")
        [[self.sign]] = self._plain([_SIGN])
        self.planes = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.known: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: pa.StringArray) -> list[bytes]:
        """Ids of each distinct word, as little-endian unsigned 32-bit numbers."""
        texts, known = words.to_pylist(), self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        new = [w for w in texts if w not in known]
        if new:
            letters = pc.match_substring_regex(pa.array(new, pa.string()), r"^\p{L}+$").to_pylist()
            plain = [w for w, ok in zip(new, letters, strict=True) if ok]
            for start in range(0, len(plain), 5000):  # encoded together, told apart by a sign's own id
                some = plain[start : start + 5000]
                ids = np.array(self._plain([_SIGN.join(some)])[0], "<u4")
                cuts = np.flatnonzero(ids == self.sign) * 4
                data = ids.tobytes()
                parts = zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)], strict=True)
                known.update(zip(some, [data[a:b] for a, b in parts], strict=True))
            rest = [w for w, ok in zip(new, letters, strict=True) if not ok]
            known.update(zip(rest, [np.array(ids, "<u4").tobytes() for ids in self._plain(rest)], strict=True))
        return [known[w] for w in texts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the number of ids of each text."""
        rows, codes, words = split_words(pc.ascii_lower(texts))
        parts = pc.extract_regex(words, _LETTERS_SIGNS)
        whole = pc.if_else(pc.is_valid(parts), pc.struct_field(parts, "a"), words).dictionary_encode()
        signs = pc.fill_null(pc.struct_field(parts, "b"), pa.scalar("")).dictionary_encode()
        heads, tails = self.words(whole.dictionary), self.words(signs.dictionary)
        head = whole.indices.to_numpy(zero_copy_only=False).tolist()
        tail = signs.indices.to_numpy(zero_copy_only=False).tolist()
        listed = [heads[a] + tails[b] for a, b in zip(head, tail, strict=True)]
        sizes = np.fromiter(map(len, listed), np.int64, len(listed))[codes] // 4
        ids = np.frombuffer(b"".join([listed[c] for c in codes.tolist()]), "<u4")
        return ids, np.bincount(rows, weights=sizes, minlength=len(texts)).astype(np.int64)


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_shards(
    documents: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Write the ids of every whole text to wavelet-matrix shards under ``path``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read.  Documents follow in
    ascending doc_id order (null first; equal ids by text), each closed by ``end_id``; a null text
    counts as empty, and an empty text is its end id alone.  A row of the Parquet files is one
    shard: range partition, ids before it in the partition, documents, their end positions and the
    payload.  An empty table gives an empty folder of the same schema.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = spark.sparkContext.defaultParallelism
    ordered = docs.repartitionByRange(max(least, -(-total // PART_BYTES)), "doc_id").sortWithinPartitions("doc_id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base, part = _encoder(tokenizer), 0, 0
        held_ids, held_docs, held_sizes, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal base, held
            ids, ends = np.concatenate(held_ids), np.cumsum(np.concatenate(held_sizes))
            row = {
                "part": [part], "base": [base], "doc_ids": [[x for docs in held_docs for x in docs]],
                "ends": [ends.tolist()], "n_tokens": [len(ids)], "payload": [build(ids, encoder.planes)],
            }
            base, held = base + len(ids), 0
            held_ids.clear(), held_docs.clear(), held_sizes.clear()
            return pa.RecordBatch.from_pydict(row, schema=_ARROW)

        for batch in slices(batches, limit=BATCH_BYTES):
            part = batch.column("part")[0].as_py()
            ids, sizes = encoder.encode(filled(batch))
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
            ends, doc_ids, start = np.cumsum(sizes), batch.column("doc_id").to_pylist(), 0
            while start < len(sizes):
                before = ends[start - 1] if start else 0
                stop = min(len(sizes), int(np.searchsorted(ends, before + shard_tokens - held)) + 1)
                held_ids.append(ids[before : ends[stop - 1]])
                held_sizes.append(sizes[start:stop])
                held_docs.append(doc_ids[start:stop])
                held += int(ends[stop - 1] - before)
                start = stop
                if held >= shard_tokens:
                    yield close()
        if held:
            yield close()

    ordered.withColumn("part", F.spark_partition_id()).mapInArrow(shards, _SHARDS).write.parquet(path)


_ARROW = pa.schema([
    ("part", pa.int32()), ("base", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("n_tokens", pa.int64()), ("payload", pa.binary()),
])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of ids before each.

    Sums of partitions are added up in one window over as many rows as there are partitions.
    """
    shards = spark.read.schema(_SHARDS).parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return shards.join(F.broadcast(parts.select("part", before.alias("before"))), "part").withColumn(
        "start", F.col("base") + F.col("before")
    )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids of every document, decoded from the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = WaveletMatrix(batch.column("payload")[row].as_py()).decode().astype("<u4")
                ends = np.array(batch.column("ends")[row].as_py(), np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()),
                    "start": starts + batch.column("start")[row].as_py(), "n_tokens": ends - starts, "ids_crc32": crc,
                })

    return read_shards(spark, path).select("doc_ids", "ends", "payload", "start").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id and place in the document of every occurrence of a token, by select on the shards."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix(batch.column("payload")[row].as_py())
                ends = np.array(batch.column("ends")[row].as_py(), np.int64)
                at = np.array([matrix.select(token, k) for k in range(matrix.count(token))], np.int64)
                doc = np.searchsorted(ends, at, side="right")
                ids = batch.column("doc_ids")[row].as_py()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([ids[d] for d in doc], pa.int64()),
                    "place": at - np.concatenate([[0], ends])[doc],
                })

    return read_shards(spark, path).select("doc_ids", "ends", "payload").mapInArrow(find, "doc_id long, place long")
