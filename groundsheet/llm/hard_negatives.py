"""Hard negatives by threshold joins over an inverted index that leaves out what suffix norms bound.

Rows are dealt to blocks; an anchor visits every block.  A block's vectors are indexed for a
threshold: the leading dimensions of a vector whose norm cannot reach it with any anchor at hand stay
out of the lists.  Lists are read from the strongest dimensions down, partial scores are added up,
and pairs are dropped once what is added up and the norms that remain stay below the threshold.
Thresholds start high and are lowered until an anchor's windows are full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundsheet.operators.lineage import materialize

#: Vectors of a block at most, give or take the hash's noise, and anchors held against it at a time.
BLOCK_ROWS, ANCHOR_ROWS = 16_384, 128
#: Thresholds tried, as shares of the highest score that the norms allow; the last one is a window's own lower end.
SHARES = (0.9, 0.7, 0.5, 0.3)
#: Dimensions whose lists are read between two looks at the bounds.
STRIDE = 16
#: Pairs alive, of all, from which the rest of their scores is worked out pair by pair.
SPARSE = 0.05
#: Rows of a squared norm from here on have scores that no long holds, and take no part.
LARGEST = float(1 << 62)
_FOUND = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_LOW, _HIGH = -(1 << 62), 1 << 62


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def prepared(embeddings: DataFrame, relabelled: int, labels: int, scale: float) -> DataFrame:
    """vec_id, label (long) and parts (whole numbers) of the rows that take part, one a vec_id."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("e")))
    rows = rows.withColumn("e", F.transform("e", lambda x: F.lit(scale) * x))
    rows = rows.where(F.aggregate("e", F.lit(0.0), lambda s, x: s + x * x) < LARGEST)
    label = F.when(F.col("vec_id") % relabelled == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = rows.select("vec_id", F.struct(label.alias("label"), F.transform("e", lambda x: F.floor(x)).alias("parts")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def _matrix(parts: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros or cut to ``width`` (beyond it the other side has zeros only)."""
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    flat = parts.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = np.zeros((len(sizes), width), np.int64)
    found[row[place < width], place[place < width]] = flat[place < width]
    return found


def _leading_norms(floats: np.ndarray) -> np.ndarray:
    """[k, j]: norm of the first j dimensions of row k, a little more against rounding."""
    squares = np.cumsum(floats * floats, axis=1)
    return np.sqrt(np.concatenate([np.zeros((len(floats), 1)), squares], axis=1)) * (1 + 1e-9)


class Index:
    """A block's vectors with the norms of their leading parts; weak dimensions lead, so that they stay out."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray):
        self.ids, self.labels, self.whole, self.width = ids, labels, whole, whole.shape[1]
        floats = whole.astype(np.float64)
        self.order = np.argsort((floats * floats).sum(0), kind="stable")
        self.rows = np.ascontiguousarray(floats[:, self.order])
        self.norms = _leading_norms(self.rows)
        self.top = float(self.norms[:, -1].max(initial=0.0))

    def above(self, whole: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, vector, score) of all pairs of anchors and vectors whose score is the anchor's threshold or nearly; none above is missed."""
        floats = whole.astype(np.float64)[:, self.order]
        norms = _leading_norms(floats)
        slack = 1e-9 * norms[:, -1:] * self.top + 1e-6
        reach = norms[:, -1]
        # Only vectors whose whole norm can reach some threshold are indexed, from the first dimension at which they can.
        bound = float(np.where(thresholds > 0, thresholds / np.maximum(reach, 1e-300), 0.0).min(initial=math.inf))
        listed = np.flatnonzero(self.norms[:, -1] >= bound)
        first = np.maximum((self.norms[listed] < bound).sum(1) - 1, 0)  # dimensions before this one are left out
        scores, alive = np.zeros((len(whole), len(listed))), np.ones((len(whole), len(listed)), bool)
        # First the lists, then what was left out of them, each from the strongest dimensions down.
        for lists in (True, False):
            for stop in range(self.width, 0, -STRIDE):
                start = max(0, stop - STRIDE)
                places = np.arange(start, stop)
                held = places >= first[:, None] if lists else places < first[:, None]
                if not held.any():
                    continue
                scores += floats[:, start:stop] @ np.where(held, self.rows[listed, start:stop], 0.0).T
                left = np.maximum(first, start) if lists else np.minimum(first, start)
                alive = scores + norms[:, left] * self.norms[listed, left] >= thresholds[:, None] - slack
                if alive.sum() <= SPARSE * alive.size:
                    break
                some = alive.any(0)
                if some.sum() < 0.7 * len(listed):
                    listed, first = listed[some], first[some]
                    scores, alive = np.ascontiguousarray(scores[:, some]), alive[:, some]
        a, b = np.nonzero(alive)
        return a, listed[b], self._exact(whole, a, listed[b])

    def _exact(self, whole: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.empty(len(a), np.int64)
        for low in range(0, len(a), 1 << 16):
            part = slice(low, low + (1 << 16))
            found[part] = (whole[a[part]] * self.whole[b[part]]).sum(1)
        return found

    def fill(self, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray, lows: list[list[int]], highs: list[list[int]], same: bool, want: int) -> Iterator[tuple]:
        """(anchor_id, slot, vec_id, score): for each window of an anchor, the first ``want`` rows with a score within it.

        Rows have the anchor's label (``same``; not the anchor's own row) or another.  Ties go by vec_id.
        """
        top = _leading_norms(whole.astype(np.float64))[:, -1] * self.top * (1 + 1e-9)
        least = np.array([min(w, default=_HIGH) for w in lows], np.int64)
        most = np.minimum(np.array([max(w, default=_LOW) for w in highs], np.float64), top)
        open_ = np.flatnonzero(least <= most)
        for share in (*SHARES, None):
            if not len(open_):
                return
            lowered = least[open_] if share is None else np.maximum(least[open_], np.floor(share * most[open_])).astype(np.int64)
            a, b, score = self.above(whole[open_], lowered.astype(np.float64))
            a_full = open_[a]
            fits = ((self.labels[b] == labels[a_full]) == same) & (self.ids[b] != ids[a_full]) & (score >= lowered[a])
            a, b, score = a[fits], b[fits], score[fits]
            order = np.lexsort((self.ids[b], -score, a))
            a, b, score = a[order], b[order], score[order]
            ends = np.searchsorted(a, np.arange(len(open_) + 1))
            still = []
            for k, anchor in enumerate(open_):
                found, scores = b[ends[k] : ends[k + 1]], score[ends[k] : ends[k + 1]]
                windows = list(zip(lows[anchor], highs[anchor], strict=True))
                taken = [(max(int(np.searchsorted(-scores, -high)), 0), int(np.searchsorted(-scores, -low, side="right"))) for low, high in windows]
                if lowered[k] > least[anchor] and any(stop - start < want for start, stop in taken):
                    still.append(anchor)
                    continue
                for slot, (start, stop) in enumerate(taken):
                    for at in range(start, min(stop, start + want)):
                        yield int(ids[anchor]), slot, int(self.ids[found[at]]), int(scores[at])
            open_ = np.array(still, np.int64)


def _join(blocks: DataFrame, visits: DataFrame, n: int, same: bool, want: int) -> DataFrame:
    """anchor_id, slot, vec_id, score: what each visit (anchor, block, windows) finds in its block.

    A task reads its blocks one after the other, first the vectors and then the anchors that visit, in batches.
    """

    def indexes(held: list) -> dict:
        """One index of all vectors, or one for each label if only the anchor's own label counts."""
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels, parts = table["vec_id"].to_numpy(), table["label"].to_numpy(), table["parts"].combine_chunks()
        whole = _matrix(parts, max(pc.max(pc.list_value_length(parts)).as_py(), 1))
        if not same:
            return {None: Index(ids, labels, whole)}
        return {label: Index(ids[at], labels[at], whole[at]) for label in np.unique(labels).tolist() for at in [labels == label]}

    def fill(index: dict, some: pa.RecordBatch) -> Iterator[tuple]:
        ids, labels = some.column("vec_id").to_numpy(), some.column("label").to_numpy()
        lows, highs = some.column("lows").to_pylist(), some.column("highs").to_pylist()
        for label, one in index.items():
            at = np.flatnonzero(labels == label) if same else np.arange(len(ids))
            if len(at):
                whole = _matrix(some.column("parts").take(pa.array(at)), one.width)
                yield from one.fill(ids[at], labels[at], whole, [lows[k] for k in at], [highs[k] for k in at], same, want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index = None, [], None
        for batch in batches:
            kinds = batch.column("block").to_numpy() * 2 + batch.column("visits").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
            for start, stop in zip(edges, edges[1:], strict=False):
                if start == stop:
                    continue
                piece = batch.slice(start, stop - start)
                if piece.column("block")[0].as_py() != block:
                    block, held, index = piece.column("block")[0].as_py(), [], None
                if not piece.column("visits")[0].as_py():
                    held.append(piece.select(["vec_id", "label", "parts"]))
                    continue
                if index is None and held:
                    index, held = indexes(held), []
                for low in range(0, piece.num_rows if index else 0, ANCHOR_ROWS):
                    some = piece.slice(low, ANCHOR_ROWS)
                    found = list(fill(index, some))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _FOUND.types, strict=True)], schema=_FOUND)

    none = F.lit(None).cast("array<long>")
    rows = blocks.select("block", F.lit(False).alias("visits"), "vec_id", "label", "parts", none.alias("lows"), none.alias("highs"))
    rows = rows.union(visits.select("block", F.lit(True), "vec_id", "label", "parts", "lows", "highs"))
    dealt = rows.repartition(n, "block").sortWithinPartitions("block", "visits")
    return dealt.mapInArrow(run, "anchor_id long, slot int, vec_id long, score long")


def _share(score: Column, percent: int) -> Column:
    """That many per cent of a long, exactly."""
    return score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")


def _best(found: DataFrame, want: int) -> DataFrame:
    """The first ``want`` rows of each anchor and slot, ranked from 1."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)


def _filled(blocks: DataFrame, anchors: DataFrame, n: int, same: bool, want: int) -> DataFrame:
    """The best ``want`` rows of all blocks for every window of the anchors (vec_id, label, parts, block, lows, highs).

    First an anchor fills its windows in its own block; the worst score found there is a lower
    end for all other blocks, where most vectors then stay below every threshold.
    """
    home = materialize(_join(blocks, anchors, n, same, want), "home-windows")
    if n == 1:
        return _best(home, want)
    full = home.groupBy("anchor_id", "slot").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") >= want)
    full = full.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "worst"))).alias("worst"))
    known = anchors.join(full.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")
    raised = F.transform("lows", lambda low, slot: F.greatest(low, F.coalesce(F.try_element_at("worst", slot.cast("int")), low)))
    away = known.withColumn("lows", raised).withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).where("to <> block")
    away = away.select(F.col("to").cast("int").alias("block"), "vec_id", "label", "parts", "lows", "highs")
    return _best(home.union(_join(blocks, away, n, same, want)), want)


def hard_negatives(
    embeddings: DataFrame, anchors_each: int = 100, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
    relabelled: int = 7, labels: int = 10, scale: float = 256.0, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are rows whose vec_id is divisible by ``anchors_each``.  Components become
    floor(``scale`` * x), labels of rows divisible by ``relabelled`` the next of ``labels``; scores are
    inner products in whole numbers, ties go by vec_id.  An anchor's positives are its first other
    rows of the same label; for each, the negatives are the first rows of other labels whose score lies
    within ``window`` per cent of the positive's (both ends included).  With a negative
    positive's score the window is empty.

    Rows with a null vec_id, label or vector or a null or non-finite component take no part, nor do rows
    whose scores no long can hold.  Of rows that share a vec_id one takes part (the least by label
    and vector).  Vectors of unequal length are compared as if filled up with zeros; an empty one scores 0.
    Anchors without a positive or a negative give no rows, nor does an empty table.  Only ``vec_id``,
    ``label`` and ``embedding`` are read.
    """
    rows = materialize(prepared(embeddings, relabelled, labels, scale), "vectors")
    n = max(1, -(-rows.count() // block_rows))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    anchors = blocks.where(F.col("vec_id") % anchors_each == 0)
    wide = anchors.withColumn("lows", F.array(F.lit(_LOW))).withColumn("highs", F.array(F.lit(_HIGH)))
    best = materialize(_filled(blocks, wide, n, True, positives), "positives")
    best = best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place"))
    low, high = window
    listed = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    least = F.transform("p", lambda p: F.ceil(_share(p["positive_score"], low)).cast("long"))
    most = F.transform("p", lambda p: F.floor(_share(p["positive_score"], high)).cast("long"))
    windows = listed.select(F.col("anchor_id").alias("vec_id"), least.alias("lows"), most.alias("highs"))
    found = _filled(blocks, anchors.join(windows, "vec_id"), n, False, negatives)
    found = found.select("anchor_id", (F.col("slot") + 1).alias("place"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    return found.join(best, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
