"""Near-duplicate documents by SimHash and a generalised pigeonhole search."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundsheet.llm.components import components
from groundsheet.llm.texts import filled, slices
from groundsheet.operators import dealing
from groundsheet.operators.lineage import fits, materialize

BITS, SEED = 64, 42
#: Words of a long fingerprint, the distance its partitions are sure to find, and the distance up to which
#: texts are compared.  Shingle sets of similarity 0.8 differ in about 15 % of the bits: 78 of 512, give or take 8.
LONG_WORDS, LONG_SURE, LONG_DISTANCE = 8, 31, 105
#: Similarity of shingle sets that links, and the chance with which every plan must probe a pair of just this one.
SIMILARITY, RECALL = 0.8, 0.99
#: Pairs of fingerprints drawn to work out that chance; its standard error at RECALL is 0.0007.
TRIALS = 20_000
#: Bits of the partitions that are weighed against each other, by words of the fingerprint.
WIDTHS = {1: (32, 22, 16), LONG_WORDS: (16, 22)}
#: Comparisons of two fingerprints in a bucket that cost as much as one row shuffled into it.
ROW_COST = 20
#: Counters of one pair-count sketch; its standard error is 6 %.
COUNTERS = 512
#: Long fingerprints that meet are first held against each other in two other words: unlike ones
#: differ in 64 of these 128 bits, give or take 6, those within LONG_DISTANCE in 20, give or take 4.
FIRST_LOOK, LOOKED = 34, 2
#: Keys (of 8 bytes) up to which they are sent to all tasks, so that only their rows are shuffled.
FEW_KEYS = 500_000
#: With sets, partitions whose buckets are shuffled at a time; their rows go from the disks before the next ones come.
ROUND = 32
#: Members from which a component's buckets are looked at before they are searched.
CROWD = 1000
#: With sets, a member is held against representatives of so many of its buckets, the largest ones.
STARS = 4
#: With sets, rows from which a bucket is left out if all of them are of one component.
SETTLED = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _shingles(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of all word shingles, repeats included."""
    import xxhash

    split = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not split:
        return np.zeros(0, np.uint64)
    if len(split) < shingle:
        parts = [b" ".join(split)]
    else:
        parts = map(b" ".join, zip(*(split[k:] for k in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in parts), np.uint64)


def fingerprint(text: bytes, shingle: int, words: int = 1) -> np.ndarray:
    """Majority of the bits of all word shingles' hashes; zeros without a word.

    Words after the first take the same hashes, mixed anew.
    """
    hashes = _shingles(text, shingle)
    if not len(hashes):
        return np.zeros(words, np.uint64)
    ones = np.zeros(BITS * words, np.int64)
    for start in range(0, len(hashes), 255 * 32):
        some = hashes[start : start + 255 * 32]
        if words > 1:
            some = np.stack([some, *(_mixed((some + np.uint64(k)) * _ODD) for k in range(1, words))], axis=1)
        bits = np.unpackbits(some.view(np.uint8).reshape(len(some), -1), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of 255 bits stay within a byte
        ones += bits[:whole].reshape(-1, 255, bits.shape[1]).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        ones += bits[whole:].sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8").astype(np.uint64)


def fingerprints(documents: DataFrame, shingle: int, words: int = 1) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp, the fingerprint's words as longs, of every whole text (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(t.encode(), shingle, words) for t in filled(batch).to_pylist()]
            flat = pa.array(np.concatenate(prints).view(np.int64))
            offsets = pa.array(np.arange(len(prints) + 1, dtype=np.int32) * words)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.ListArray.from_arrays(offsets, flat)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    docs = _keyed(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text_key", "text")
    return docs.mapInArrow(run, "doc_id long, text_key long, fp array<long>")


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))


def _only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """At least the rows whose ``key`` is among ``keys``, before they are shuffled: others go if the keys are few."""
    keys = keys.select(key).distinct()
    return rows.join(F.broadcast(keys), key, "left_semi") if fits(keys, FEW_KEYS) else rows


class ShingleSets:
    """Sets of shingles of nodes, each worked out and written once.

    A node stands for the texts of one fingerprint; the one with the smallest hash is taken.
    """

    def __init__(self, documents: DataFrame, prints: DataFrame, shingle: int):
        self._documents, self._prints, self._shingle, self._written = documents, prints, shingle, None

    def of(self, nodes: DataFrame) -> DataFrame:
        """``node, set`` of at least the ``node``s of a frame."""
        shingle = self._shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                sets = [np.unique(_shingles(t.encode(), shingle)).view(np.int64) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "set": pa.array(sets, pa.list_(pa.int64()))})

        if self._written is not None:
            nodes = nodes.join(self._written.select("node"), "node", "left_anti")
        wanted = materialize(self._prints.select("node", "text_key").join(nodes.select("node").distinct(), "node", "left_semi"), "wanted")
        if self._written is not None and wanted.isEmpty():
            return self._written
        texts = _only(_keyed(self._documents), wanted, "text_key").groupBy("text_key").agg(F.min("text").alias("text"))  # copies go before the shuffle
        found = texts.join(wanted, "text_key").select("node", "text").mapInArrow(run, "node long, set array<long>")
        found = materialize(found, "shingles")
        self._written = found if self._written is None else self._written.union(found)
        return self._written

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) of nodes whose sets are alike by SIMILARITY or more."""
        pairs = materialize(pairs.toDF("a", "b"), "near-pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        sets = _only(self.of(nodes), nodes, "node")
        both = pairs.join(sets.toDF("a", "a_set"), "a").join(sets.toDF("b", "b_set"), "b")
        both = both.select("a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("shared"), (F.size("a_set") + F.size("b_set")).alias("all"))
        return both.where(F.col("shared") >= SIMILARITY * (F.col("all") - F.col("shared")) - 1e-9).select("a", "b")

    def links(self, members: DataFrame, known: DataFrame) -> DataFrame:
        """Links (a, b) among the ``node``s of ``members`` beside the ``known`` ones (node, root): as many as join the same components as all.

        Two sets that are alike by s share one of the rarest elements of both: of the set that is no larger
        one of its first 1 - 2 s / (1 + s), of the other one of its first 1 - s.  Every member is written once,
        however many buckets it is in, and what a crowd has in common comes last in every set.  First a member
        is held against the node with the fewest rarer elements for STARS of its elements, which joins dense groups
        at a cost in proportion to their size; then pairs of different components are compared.  Exact:
        prefix and position filters leave out no link.
        """
        members = materialize(members, "members")
        sets = self.of(members)
        # Elements are shuffled once, by value; a set holds each once, and what no other set has stays there.
        single = sets.select("node", F.explode("set").alias("e")).where("node is not null and e is not null").repartition("e")
        often = single.groupBy("e").agg(F.count("node").alias("often")).where("often > 1")
        sizes = members.join(sets.select("node", F.size("set").alias("n")), "node")
        shared = single.join(often, "e").join(sizes, "node")
        own = Window.partitionBy("node")
        # elements of one set alone are the rarest: they take the first places
        at = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("often", "e")) - 1
        placed = shared.withColumn("at", at).where(F.col("at") <= (1 - SIMILARITY) * F.col("n") + 1e-9)
        first = materialize(placed.select("e", "node", "root", "n", "at"), "rarest")
        least = SIMILARITY / (1 + SIMILARITY)  # of both sizes, so many elements are shared
        left = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
        able = (F.col("x_root") != F.col("y_root")) & (left >= least * (F.col("x_n") + F.col("y_n")) - 1e-9)

        def side(mark: str) -> DataFrame:
            return first.select("e", *(F.col(c).alias(f"{mark}_{c}") for c in ("node", "root", "n", "at")))

        middle = side("y").groupBy("e").agg(F.min(F.struct("y_at", "y_node", "y_root", "y_n")).alias("y")).select("e", "y.*")
        nearest = Window.partitionBy("x_node").orderBy("y_at", "y_node")
        met = side("x").join(middle, "e").where(able).select("x_node", "y_node", "y_at")
        met = met.groupBy("x_node", "y_node").agg(F.min("y_at").alias("y_at")).withColumn("k", F.row_number().over(nearest)).where(F.col("k") <= STARS)
        star = materialize(known.union(self.alike(met.select("x_node", "y_node"))).toDF("a", "b"), "star")
        joined = materialize(components(star, "a", "b"), "second-groups")
        first = first.withColumnRenamed("root", "before").join(joined, "node", "left").withColumn("root", F.coalesce("root", "before"))
        smaller = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_node") < F.col("y_node")))
        short = side("x").where(F.col("x_at") <= (1 - 2 * least) * F.col("x_n") + 1e-9)
        met = short.join(side("y"), "e").where(smaller & able)
        return star.union(self.alike(met.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()))


def _correlations(prints: DataFrame, words: int) -> list[np.ndarray]:
    """How strongly the bits of each word go together, from counts of pairs of bits over all fingerprints."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((words, BITS, BITS), np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 14):
                found = _words(batch.slice(start, 1 << 14), words)
                for k in range(words):
                    bits = np.unpackbits(found[:, k : k + 1].copy().view(np.uint8), axis=1, bitorder="little").astype(np.float32)
                    both[k] += (bits.T @ bits).astype(np.int64)
                rows += len(found)
        counts = [[rows, *both[k].ravel().tolist()] for k in range(words)]
        yield pa.RecordBatch.from_pydict({"k": list(range(words)), "counts": counts}, schema=_COUNTS)

    summed = _summed(prints.mapInArrow(count, "k int, counts array<long>"))
    return [_correlation(summed.get(k)) for k in range(words)]


def _correlation(counts: np.ndarray | None) -> np.ndarray:
    if counts is None or counts[0] < 2:
        return np.zeros((BITS, BITS))
    share = counts[1:].reshape(BITS, BITS) / counts[0]
    one = np.diag(share)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    found = np.abs(share - np.outer(one, one)) / np.outer(spread, spread)
    np.fill_diagonal(found, 0)
    return found


def _grow(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits of a word dealt to partitions, each grown around the bits that go together most."""
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = -(-len(free) // (parts - k))
        listed = sorted(free)
        group = [max(listed, key=lambda b: (correlation[b, listed].sum(), -b))]
        while len(group) < size:
            group.append(max(free - set(group), key=lambda b: (correlation[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


_COUNTS = pa.schema([("k", pa.int32()), ("counts", pa.list_(pa.int64()))])


def _words(batch: pa.RecordBatch, words: int) -> np.ndarray:
    flat = batch.column("fp").flatten().to_numpy(zero_copy_only=False)
    return flat.view(np.uint64).reshape(-1, words)


def _summed(tables: DataFrame) -> dict[int, np.ndarray]:
    """Tables of one length summed by k: as many rows reach the driver as there are k."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.array(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.Table.from_pydict({"k": [table.column("k")[0].as_py()], "counts": [total.tolist()]}, schema=_COUNTS)

    rows = tables.groupBy("k").applyInArrow(add, "k int, counts array<long>").collect()
    return {r.k: np.array(r.counts, np.int64) for r in rows}


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _pair_counts(prints: DataFrame, masks: list[tuple[int, int]], words: int) -> list[float]:
    """Estimated pairs of fingerprints that agree under each (word, mask), from second-moment sketches of all."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(masks), COUNTERS), np.int64)
        for batch in batches:
            values = _words(batch, words)
            for k, (word, mask) in enumerate(masks):
                mixed = _mixed((values[:, word] & np.uint64(mask)) * _ODD)
                sign = (mixed & np.uint64(1)).astype(np.int64) * 2 - 1
                slot = (mixed >> np.uint64(1)) % np.uint64(COUNTERS)
                sums[k] += np.bincount(slot.astype(np.int64), weights=sign, minlength=COUNTERS).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"k": list(range(len(masks))), "counts": sums.tolist()}, schema=_COUNTS)

    rows = prints.count()
    found = _summed(prints.mapInArrow(sketch, "k int, counts array<long>"))
    return [max(0.0, (float((found[k].astype(float) ** 2).sum()) - rows) / 2) if k in found else 0.0 for k in range(len(masks))]


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds per partition that add up to ``total`` at the least summed cost, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for threshold, extra in cost.items():
                at, sum_ = used + threshold, so_far + extra
                if at not in new or sum_ < new[at][0]:
                    new[at] = sum_, [*chosen, threshold]
        best = new
    return best.get(total, (float("inf"), []))


def _differing(words: int) -> np.ndarray:
    """Bits that differ in TRIALS pairs of fingerprints of texts alike by SIMILARITY, if bits are independent."""
    share = np.arccos(2 * SIMILARITY / (1 + SIMILARITY)) / np.pi
    draw = np.random.default_rng(SEED)
    return np.concatenate([draw.random((1000, words * BITS)) < share for _ in range(TRIALS // 1000)])  # a byte each, not a double


def _checked(word: int, words: int) -> list[int]:
    """The words that are looked at first when fingerprints meet by some bits of ``word``; its own if there is no other."""
    return [(word + 1 + k) % words for k in range(min(LOOKED, max(1, words - 1)))]


def _met(differ: np.ndarray, word: int, bits: list[int], threshold: int) -> np.ndarray:
    """Which of the drawn pairs a partition brings together and the first look lets pass."""
    words = differ.shape[1] // BITS
    check = sum(differ[:, other * BITS :][:, :BITS].sum(1) for other in _checked(word, words)) <= FIRST_LOOK
    return check & (differ[:, [word * BITS + b for b in bits]].sum(1) <= threshold)


def _more_partitions(words: int, per_word: int, differ: np.ndarray) -> list[tuple[int, list[int]]]:
    """Partitions by chance, as many as reach RECALL without any other."""
    draw = np.random.default_rng(per_word)
    near, met, found = differ.sum(1) <= LONG_DISTANCE, np.zeros(len(differ), bool), []
    while (met & near).mean() < RECALL:
        for word in range(words):
            for group in np.array_split(draw.permutation(BITS), per_word):
                found.append((word, sorted(group.tolist())))
                met |= _met(differ, *found[-1], 0)
    return found


def plan(prints: DataFrame, sure: int, words: int) -> list[tuple[int, list[int], int]]:
    """Partitions as (word, bits, threshold): correlated bits, and -1 (not probed), 0 or 1.

    With thresholds that add up to ``sure - partitions + 1``, two fingerprints within ``sure`` bits
    are within the threshold of some partition.  The cost of a threshold is the estimated number
    of candidate pairs plus ROW_COST for each row that indexes or probes it; thresholds are dealt by dynamic
    programming, for each width of partitions, and the cheapest width is taken.

    To plans of long fingerprints partitions drawn by chance are added at threshold 0, until the chance to
    probe a pair of similarity SIMILARITY is RECALL: the recall is the same whatever the width and the cost.
    """
    differ = _differing(words) if words > 1 else None
    correlations = _correlations(prints, words)
    choices = []
    for width in WIDTHS[words]:
        per_word = -(-BITS // width)
        if -per_word * words <= sure - per_word * words + 1 <= per_word * words:
            groups = [(w, group) for w in range(words) for group in _grow(correlations[w], per_word)]
            choices.append((groups, _more_partitions(words, per_word, differ) if words > 1 else []))
    masks = []
    for groups, more in choices:
        for word, group in groups:
            masks += [(word, _mask(group)), *((word, _mask([b for b in group if b != out])) for out in group)]
        masks += [(word, _mask(group)) for word, group in more]
    rows, pairs = prints.count(), iter(_pair_counts(prints, masks, words))
    best: tuple[float, list] = (float("inf"), [])
    for groups, more in choices:
        costs = []
        for _, group in groups:
            same = next(pairs)
            near = same + sum(max(0.0, next(pairs) - same) for _ in group)
            costs.append({-1: 0.0, 0: same + ROW_COST * 2.0 * rows, 1: near + ROW_COST * (2 + len(group) / 2) * rows})
        cost, thresholds = allocate(costs, sure - len(groups) + 1)
        chosen = [(w, group, t) for (w, group), t in zip(groups, thresholds, strict=False)]
        extra = [(w, group, next(pairs)) for w, group in more]
        if words > 1 and thresholds:
            near = differ.sum(1) <= LONG_DISTANCE
            met = np.any([_met(differ, *p) for p in chosen], axis=0)
            for w, group, same in extra:
                if (met & near).mean() >= RECALL:
                    break
                met |= _met(differ, w, group, 0)
                chosen.append((w, group, 0))
                cost += same + ROW_COST * 2.0 * rows
        if thresholds and cost < best[0]:
            best = cost, chosen
    if not best[1]:
        raise ValueError(f"no partitions are sure to find {sure} bits")
    return best[1]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def _near_entries(part: int, keys: Column, checks: dict[str, Column]) -> Column:
    return F.transform(keys, lambda v: _entry(part, v, True, checks))


def _entry(part: int, key: Column, near: bool, checks: dict[str, Column]) -> Column:
    named = (c.alias(name) for name, c in checks.items())
    return F.struct(F.lit(part).cast("smallint").alias("part"), key.alias("key"), F.lit(near).alias("near"), *named)


def _check_names(words: int) -> list[str]:
    return [f"check{k}" for k in range(len(_checked(0, words)))]


def _entries(prints: DataFrame, partitions: list[tuple[int, list[int], int]], words: int) -> DataFrame:
    """part, key, near and checks of every print, with its own columns but the fingerprint.

    A print is indexed by its bits in a partition (near false).  At threshold 1 it also stands under
    each value with one of its set bits cleared (near true): of two values one bit apart, one has
    the bit set, so every pair meets.  The checks are words of which the key is no part, if there are such.
    """
    found = []
    for k, (word, group, threshold) in enumerate(partitions):
        if threshold < 0:
            continue
        key = F.col("fp")[word].bitwiseAND(_signed(_mask(group)))
        checks = {name: F.col("fp")[other] for name, other in zip(_check_names(words), _checked(word, words), strict=True)}
        found.append(F.array(_entry(k, key, False, checks)))
        if threshold:
            cleared = [F.when(key.bitwiseAND(_signed(1 << b)) != 0, key.bitwiseXOR(_signed(1 << b))) for b in group]
            found.append(_near_entries(k, F.array_compact(F.array(*cleared)), checks))
    return prints.select(*[c for c in prints.columns if c != "fp"], F.inline(F.flatten(F.array(*found))))


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _all_apart(a: list[str], b: list[str]) -> Column:
    return sum((_apart(F.col(x), F.col(y)) for x, y in zip(a, b, strict=True)), F.lit(0))


def _verified(pairs: DataFrame, prints: DataFrame, words: int, distance: int, sets: ShingleSets | None = None) -> DataFrame:
    """Those pairs (a, b) whose whole fingerprints are within ``distance`` and whose ``sets`` are alike; one word is already checked whole."""
    if words == 1:
        return pairs
    known = prints.select("node", "fp")
    pairs = materialize(pairs.distinct(), "candidates")
    both = pairs.join(known.toDF("a", "a_fp"), "a").join(known.toDF("b", "b_fp"), "b")
    apart = sum((_apart(F.col("a_fp")[k], F.col("b_fp")[k]) for k in range(words)), F.lit(0))
    near = both.where(apart <= distance).select("a", "b")
    return sets.alike(near) if sets else near


def _rounds(partitions: list[tuple[int, list[int], int]]) -> list[list[tuple[int, list[int], int]]]:
    """Probed partitions, ROUND at a time."""
    probed = [p for p in partitions if p[2] >= 0]
    return [probed[start : start + ROUND] for start in range(0, len(probed), ROUND)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def _held_against_heads(prints: DataFrame, partitions: list[tuple[int, list[int], int]], words: int, look: int) -> DataFrame:
    """Each member ``node`` of a bucket with its representative ``b``, if the first look lets them pass, and the bucket's rows ``n``."""
    checks = _check_names(words)
    entries = _entries(prints, partitions, words)
    heads = entries.groupBy("part", "key").agg(
        F.min_by(F.struct("node", *checks), F.when(~F.col("near"), F.col("node"))).alias("head"), F.count("*").alias("n")
    )
    held = [F.col(f"head.{c}").alias(f"b_{c}") for c in checks]
    heads = heads.where("n > 1 and head is not null").select("part", "key", F.col("head.node").alias("b"), *held, "n")
    # One row a bucket on this side; a crowded bucket's members are split by adaptive execution.
    met = entries.join(heads, ["part", "key"])
    return met.where((F.col("node") != F.col("b")) & (_all_apart(checks, [f"b_{c}" for c in checks]) <= look)).select("node", "b", "n")


def _largest(met: DataFrame) -> DataFrame:
    """Of a member's representatives (node, b, n) those of its STARS largest buckets."""
    order = Window.partitionBy("node").orderBy(F.desc("n"), "b")
    met = met.groupBy("node", "b").agg(F.max("n").alias("n")).withColumn("at", F.row_number().over(order))
    return met.where(F.col("at") <= STARS).select("node", "b", "n")


def _open_entries(rooted: DataFrame, large: DataFrame | None, partitions: list[tuple[int, list[int], int]], words: int) -> DataFrame:
    """Entries without those of buckets of SETTLED rows and more that are all of one root, which only ``large`` components can fill."""
    entries = _entries(rooted, partitions, words)
    if large is None:
        return entries
    mine = _entries(rooted.join(large, "root", "left_semi"), partitions, words).groupBy("part", "key")
    full = mine.agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    full = materialize(full.where((F.col("low") == F.col("high")) & (F.col("n") >= SETTLED)).select("part", "key", "low"), "full-buckets")
    mixed = entries.join(full, ["part", "key"]).where(F.col("root") != F.col("low")).select("part", "key").distinct()
    settled = materialize(full.join(mixed, ["part", "key"], "left_anti").select("part", "key"), "settled-buckets")
    return entries.join(settled, ["part", "key"], "left_anti")


def _sides(entries: DataFrame, words: int, look: int) -> tuple[DataFrame, DataFrame, Column]:
    """Entries under two sets of names, and the test of a pair: of two components, and alike at the first look."""
    checks = _check_names(words)
    one, two = (entries.select("part", "key", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "root", "near", *checks))) for side in "ab")
    return one, two, (F.col("a_root") != F.col("b_root")) & (_all_apart([f"a_{c}" for c in checks], [f"b_{c}" for c in checks]) <= look)


def _meeting(entries: DataFrame, words: int) -> DataFrame:
    """node and root of members that meet one of another component."""
    one, two, differ = _sides(entries, words, FIRST_LOOK)
    one, two = (side.withColumnsRenamed({"part": f"{m}_part", "key": f"{m}_key"}) for side, m in ((one, "a"), (two, "b")))
    partner = differ & ~(F.col("a_near") & F.col("b_near")) & dealing.same(["a_part", "a_key"], ["b_part", "b_key"])
    return one.join(two, partner, "left_semi").select(F.col("a_node").alias("node"), F.col("a_root").alias("root"))


def print_groups(prints: DataFrame, words: int, sure: int, distance: int, sets: ShingleSets | None = None) -> DataFrame:
    """node and root of every print (node, fp) that is linked to another; with ``sets`` near pairs link when their sets are alike.

    Candidates meet in buckets, one per partition and key.  First every member of a bucket is held
    against one representative, which joins large groups at a cost in proportion to their size.
    Then buckets are searched for links between what are still different components, and large
    buckets of a single component are left out: no link is lost, and no group is compared pair by
    pair.  With ``sets`` buckets only tell which nodes meet one of another component; the links
    among all of these are searched by the rarest elements of their sets.  Buckets are then taken
    ROUND partitions at a time, so the disks hold no more of them at once, however many the plan has.
    """
    partitions = plan(prints.select("fp"), sure, words)
    look = distance if words == 1 else FIRST_LOOK
    if sets:
        found = [materialize(_largest(_held_against_heads(prints, some, words, look)), "representatives") for some in _rounds(partitions)]
        met = _largest(_union(found))
    else:
        met = _held_against_heads(prints, partitions, words, look)
    star = _verified(met.select(F.col("node").alias("a"), "b"), prints, words, distance, sets)
    first = materialize(components(star, "a", "b"), "first-groups")
    rooted = materialize(prints.join(first, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    bridges = first.select("node", "root")
    if sets:
        large = rooted.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") >= SETTLED)
        large = materialize(large.select("root"), "large-groups")
        large = None if large.isEmpty() else large
        members = [materialize(_meeting(_open_entries(rooted, large, some, words), words).distinct(), "meeting") for some in _rounds(partitions)]
        return components(sets.links(_union(members).distinct(), bridges), "a", "b")
    open_ = _entries(rooted, partitions, words)
    crowds = materialize(first.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD).select("root"), "crowds")
    if not crowds.isEmpty():
        crowded = open_.join(crowds, "root").groupBy("part", "key", "root").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD)
        crowded = materialize(crowded.select("part", "key").distinct(), "crowded")
        held = open_.join(crowded, ["part", "key"]).groupBy("part", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        open_ = open_.join(held.where("low = high").select("part", "key"), ["part", "key"], "left_anti")
    one, two, differ = _sides(open_, words, look)
    # Both sides are one frame under two sets of names, so Spark shuffles it once.
    across = one.join(two, ["part", "key"]).where(differ & ~F.col("a_near") & (F.col("b_near") | (F.col("a_node") < F.col("b_node"))))
    found = across.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    bridges = bridges.union(across.select("a_root", "b_root") if words == 1 else _verified(found, prints, words, distance))
    return components(bridges, "node", "root")


def simhash_groups(documents: DataFrame, shingle: int = 5, words: int = LONG_WORDS, sure: int = LONG_SURE, distance: int = LONG_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits a word) and component_id of every row of ``documents``.

    A-Z are lower-cased; shingles of ``shingle`` words, repeats included, are hashed by XXH64; a
    bit is set if it is set in over half the hashes.  Documents of one word of 64 bits link when
    their fingerprints differ in at most ``distance`` bits, and all links up to ``sure`` bits are
    found.  Longer fingerprints only find candidates: pairs within ``distance`` bits link when their
    sets of shingles share SIMILARITY of their union or more, counted exactly.  A pair of just this
    similarity is found with chance RECALL (of independent bits), a more similar one with a higher
    chance.  component_id is the smallest doc_id reachable, itself included.  Long fingerprints
    go by a 64-bit hash; among 10^9 of them two share one with a chance of 3 %.

    Null and empty texts have fingerprint zero and link like any other.  Copies and repeated rows
    share a fingerprint and are one node of the search, however many they are.  Rows with a null
    doc_id keep their row; a group of such rows alone has a null component.  Only ``doc_id`` and
    ``text`` are read, so other columns cannot clash.  An empty table gives no rows.
    """
    node = F.col("fp")[0] if words == 1 else F.xxhash64("fp")
    docs = materialize(fingerprints(documents, shingle, words).withColumn("node", node), "fingerprints")
    prints = docs.groupBy("node").agg(F.min("fp").alias("fp"), F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"))
    prints = materialize(prints, "prints")

    sets = ShingleSets(documents, prints, shingle) if words > 1 else None
    roots = print_groups(prints.select("node", "fp"), words, sure, distance, sets)
    rooted = materialize(prints.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(smallest, "root").select("node", "component_id"), "named")
    digits = F.array_join(F.transform("fp", lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")
    return docs.join(named, "node").select("doc_id", digits.alias("fingerprint"), "component_id")
