"""SimHash groups against all pairs."""

import re

import pytest
import xxhash
from conftest_llm import SF, odd_rows, plain_components
from groundsheet.llm import simhash
from groundsheet.llm.queries import QUERIES


def plain_print(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, distance=3):
    prints = {k: plain_print(text, 3) for k, (_, text) in enumerate(rows)}
    pairs = [(a, b) for a in prints for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= distance]
    top = plain_components(pairs, list(prints))
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top[k]] = min(least.get(top[k], doc_id), doc_id)
    return sorted((str(d), f"{prints[k]:016x}", str(least.get(top[k]))) for k, (d, _) in enumerate(rows))


def found(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_odd_rows(spark, clashing):
    got = simhash.simhash_groups(clashing, shingle=3, words=1, sure=3, distance=3)
    assert found(got) == plain_groups([(r[0], r[1]) for r in odd_rows()])


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(QUERIES["op4_simhash_groups"](spark, SF)) == plain_groups(rows)


def test_empty_table(spark, none):
    assert simhash.simhash_groups(none, shingle=3, words=1, sure=3, distance=3).collect() == []
    assert simhash.simhash_groups(none).collect() == []


@pytest.mark.parametrize("widths", [(32,), (22,), (16,)])
def test_search_is_exact(spark, monkeypatch, widths):
    """Prints around some centres and at random, against all pairs, for every width of partitions."""
    import random

    monkeypatch.setitem(simhash.WIDTHS, 1, widths)
    draw = random.Random(sum(widths))
    values = [draw.getrandbits(64) for _ in range(300)]
    for centre in values[:8]:
        for _ in range(25):
            values.append(centre ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(6))}))
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(s, [s]) for s in signed], "node long, fp array<long>")
    got = {r.node: r.root for r in simhash.print_groups(frame, 1, 3, 3).collect()}
    pairs = [(signed[a], signed[b]) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3]
    assert {n: got.get(n, n) for n in signed} == plain_components(pairs, signed)


def test_allocate():
    costs = [{-1: 0, 0: 5, 1: 9}, {-1: 0, 0: 1, 1: 20}, {-1: 0, 0: 7, 1: 8}]
    assert simhash.allocate(costs, 0) == (9.0, [-1, 0, 1])
    assert simhash.allocate(costs, 9)[1] == []


def test_long_prints_find_similar_texts(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:395] + ["x"] * 5)), (3, " ".join(reversed(words))), (4, " ".join(words[::2]))]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}


def similar(a, b):
    a, b = ({tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (a, b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("width", [16, 22])
def test_recall_at_the_threshold(spark, monkeypatch, width):
    """Pairs at 0.80-0.85 are found at the stated recall by either width; pairs under 0.80 never link."""
    import random

    monkeypatch.setitem(simhash.WIDTHS, simhash.LONG_WORDS, (width,))
    draw = random.Random(width)
    rows, over, under = [], [], []
    while len(over) < 400 or len(under) < 200:
        text = [f"w{draw.randrange(10**6)}" for _ in range(300)]
        other = list(text)
        for at in draw.sample(range(300), draw.randrange(6, 12)):
            other[at] = f"x{draw.randrange(10**6)}"
        share = similar(text, other)
        chosen = over if 0.8 <= share <= 0.85 and len(over) < 400 else under if 0.7 <= share < 0.8 and len(under) < 200 else None
        if chosen is not None:
            chosen.append(len(rows))
            rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(other))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(frame).collect()}
    assert sum(got[k + 1] == k for k in over) >= 0.98 * len(over)
    assert not any(got[k + 1] == k for k in under)


def test_crowded_buckets(spark, monkeypatch):
    """Large groups are joined by representatives, and what still links to them is found."""
    monkeypatch.setattr(simhash, "CROWD", 5)
    import random

    draw = random.Random(9)
    values = {draw.getrandbits(64) for _ in range(100)}
    for centre in list(values)[:3]:
        values |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 12) for b in range(20, 26)}
        values |= {centre ^ (7 << a) for a in range(30, 40)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(s, [s]) for s in signed], "node long, fp array<long>")
    got = {r.node: r.root for r in simhash.print_groups(frame, 1, 3, 3).collect()}
    pairs = [(signed[a], signed[b]) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3]
    assert {n: got.get(n, n) for n in signed} == plain_components(pairs, signed)


def test_crowd_of_unlike_members(spark, monkeypatch):
    """Many edits of one text: links as by brute force, candidates in proportion to the group."""
    import random

    draw, counted = random.Random(3), []
    base = [f"w{k}" for k in range(150)]
    texts = []
    for size in range(1200):
        text = list(base)
        for at in draw.sample(range(150), 1 + size % 9):
            text[at] = f"x{draw.randrange(10**6)}"
        texts.append(text)
        if size % 40 == 0:  # a near copy of a member that stands apart
            texts.append([*text[:-1], f"y{size}"])
    alike = simhash.ShingleSets.alike

    def counting(self, pairs):
        counted.append(pairs.count())
        return alike(self, pairs)

    monkeypatch.setattr(simhash.ShingleSets, "alike", counting)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(frame).collect()}
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 9 * (shared := len(sets[a] & sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))]
    want = plain_components(pairs, range(len(sets)))
    assert sum(got[k] != want[k] for k in want) <= 0.01 * len(want)
    assert not any(want[got[k]] != want[k] for k in want)  # nothing links that should not
    assert sum(counted) < 60 * len(texts), counted


def test_dense_crowd_in_proportion(spark, monkeypatch):
    """A text and many light edits of it: few sets are compared for each text."""
    import random

    draw, counted = random.Random(5), []
    base = [f"w{k}" for k in range(150)]
    texts = [base]
    for size in range(900):
        text = list(base)
        for at in draw.sample(range(150), 1 + size % 5):
            text[at] = f"x{draw.randrange(10**6)}"
        texts.append(text)
    alike = simhash.ShingleSets.alike

    def counting(self, pairs):
        counted.append(pairs.count())
        return alike(self, pairs)

    monkeypatch.setattr(simhash.ShingleSets, "alike", counting)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(frame).collect()}
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 9 * (shared := len(sets[a] & sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))]
    want = plain_components(pairs, range(len(sets)))
    assert sum(got[k] != want[k] for k in want) <= 0.01 * len(want)
    assert not any(want[got[k]] != want[k] for k in want)
    assert sum(counted) < 10 * len(texts), counted


def test_drawn_pairs_are_the_same():
    """Drawn in parts, the pairs are those of one draw."""
    import numpy as np

    share = np.arccos(2 * simhash.SIMILARITY / (1 + simhash.SIMILARITY)) / np.pi
    whole = np.random.default_rng(simhash.SEED).random((simhash.TRIALS, 2 * simhash.BITS)) < share
    assert (simhash._differing(2) == whole).all()


def test_buckets_are_shuffled_in_rounds(spark, monkeypatch):
    """However many partitions a plan has, the entries of a few are on the disks at a time."""
    import random

    monkeypatch.setattr(simhash, "ROUND", 7, raising=False)
    draw, probed = random.Random(11), []
    entries = simhash._entries

    def counting(prints, partitions, words):
        probed.append(sum(threshold >= 0 for _, _, threshold in partitions))
        return entries(prints, partitions, words)

    monkeypatch.setattr(simhash, "_entries", counting)
    rows = []
    for k in range(0, 90, 3):
        text = [f"w{draw.randrange(10**6)}" for _ in range(120)]
        rows += [(k, " ".join(text)), (k + 1, " ".join([*text[:-1], "x"])), (k + 2, " ".join(draw.sample(text, 120)))]
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k - 1 if k % 3 == 1 else k for k in range(90)}
    assert max(probed) <= 7, probed
