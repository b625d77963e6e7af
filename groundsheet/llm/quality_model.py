"""Text quality by a factorisation machine over hashed words and structure."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.llm.quality_rules import counts
from groundsheet.llm.texts import filled, slices, split_words

#: Training is bounded to so many labelled documents, drawn by a hash of their ids.
TRAIN_DOCS = 6000
WORD_BUCKETS, RANK = 4096, 8
EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY, DRAW_SEED = 12, 500, 256, 0.02, 1e-4, 11
THRESHOLD = 0.3

#: Structure and length of a text, each about 0 to 1.
STATS = (
    "words", "word_length", "symbols", "upper", "duplicate_lines", "repeated_words", "line_length", "digits", "marks", "distinct",
)
WIDTH = WORD_BUCKETS + len(STATS)
#: Rows of dense features that a task holds at a time.
SLICE_ROWS = 1000


def features(texts: pa.Array) -> np.ndarray:
    """One row of WIDTH numbers per non-null text: log word counts at unit length, then STATS."""
    n = len(texts)
    rows, codes, words = split_words(texts)
    buckets = np.array([_bucket(w) for w in pc.utf8_lower(words).to_pylist()], np.int64)
    tf = np.zeros((n, WORD_BUCKETS), np.float32)
    if len(rows):
        tf += np.bincount(rows * WORD_BUCKETS + buckets[codes], minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
    kinds = (tf > 0).sum(1)
    np.log1p(tf, out=tf)
    tf /= np.maximum(np.linalg.norm(tf, axis=1, keepdims=True), 1e-6)
    base = {k: v.astype(float) for k, v in counts(texts).items()}
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(float)
    some = np.maximum(base["n_words"], 1)
    stats = [
        np.log1p(base["n_words"]) / 10, base["word_chars"] / some / 10, base["n_symbols"] / some / 3,
        base["n_upper"] / np.maximum(base["word_chars"], 1), base["n_dup_lines"] / np.maximum(base["n_lines"], 1),
        base["n_repeat_words"] / some, np.log1p(base["n_words"] / np.maximum(base["n_lines"], 1)) / 5,
        count(r"\p{N}") / some, count(r"[!?.,;:]") / some, kinds / np.minimum(some, WORD_BUCKETS),
    ]
    return np.hstack([tf, np.clip(np.stack(stats, axis=1), 0, 3).astype(np.float32)])


def _bucket(word: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(word.encode()) % WORD_BUCKETS


def margin(x: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Linear part plus all pairwise interactions, by the sum-of-squares identity in linear time."""
    v = model["v"]
    pairs = ((x @ v) ** 2 - (x**2) @ (v**2)).sum(1) / 2
    return model["b"][0] + x @ model["w"] + pairs


def fit(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Minimise the logistic loss by Adam; the same rows give the same model."""
    draw = np.random.default_rng(DRAW_SEED)
    share = min(max(y.mean() if len(y) else 0.5, 0.01), 0.99)
    model = {
        "b": np.array([np.log(share / (1 - share))]), "w": np.zeros(x.shape[1]),
        "v": draw.normal(0, 0.05, (x.shape[1], RANK)),
    }
    first, second, step = {k: np.zeros_like(p) for k, p in model.items()}, {k: np.zeros_like(p) for k, p in model.items()}, 0
    for _ in range(max(EPOCHS, LEAST_STEPS // -(-len(y) // BATCH)) if len(y) else 0):
        order = draw.permutation(len(y))
        for start in range(0, len(y), BATCH):
            part = order[start : start + BATCH]
            xs = x[part].astype(np.float64)
            error = (1 / (1 + np.exp(-margin(xs, model))) - y[part]) / len(part)
            v = model["v"]
            grads = {
                "b": np.array([error.sum()]), "w": xs.T @ error,
                "v": xs.T @ (error[:, None] * (xs @ v)) - ((xs**2).T @ error)[:, None] * v,
            }
            step += 1
            for k, g in grads.items():
                g = g + DECAY * model[k] * (k != "b")
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model[k] = model[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {k: p.astype(np.float32) for k, p in model.items()}


def learn(documents: DataFrame, labels: DataFrame, usable: Column) -> dict[str, np.ndarray]:
    """Model from the labelled documents whose id is ``usable``, TRAIN_DOCS of them at most.

    Labels are counted first and drawn by a hash of the id; the drawn ids have that bound, so they
    are broadcast.  An id with several labels takes the lowest, one with several texts the first
    by order.
    """
    known = labels.where(usable & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = known.count()
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1_000_003 * min(1.0, TRAIN_DOCS / max(total, 1)))
    texts = documents.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=SLICE_ROWS):
            x = features(filled(batch))
            at = [np.flatnonzero(row) for row in x]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "quality": batch.column("quality"),
                "at": pa.array([a.astype(np.int32).tolist() for a in at], pa.list_(pa.int32())),
                "x": pa.array([row[a].tolist() for row, a in zip(x, at, strict=True)], pa.list_(pa.float32())),
            })

    rows = texts.mapInArrow(run, "doc_id long, quality int, at array<int>, x array<float>").toArrow().sort_by("doc_id")
    x = np.zeros((len(rows), WIDTH), np.float32)
    for k, (at, value) in enumerate(zip(rows["at"], rows["x"], strict=True)):
        x[k, at.values.to_numpy()] = value.values.to_numpy()
    return fit(x, rows["quality"].to_numpy().astype(np.float64))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; so is a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``documents`` (doc_id, text).

    ``labels`` (doc_id, quality of 0 or 1) are learned from only where not held out; a score reads
    the text alone.  Null and empty texts have no words and are scored by their structure; without
    a label every score is near one half; a null doc_id keeps its row; repeated rows score alike;
    an empty table gives no rows.  Other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    model = learn(docs, marks, ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=SLICE_ROWS):
            score = 1 / (1 + np.exp(-margin(features(filled(batch)), model).astype(np.float64)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": score})

    scored = docs.mapInArrow(run, "doc_id long, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
