"""Mixing: permutations, water filling, targets met and limits kept."""

import random
import re

import pytest
from conftest_llm import SF, odd_rows
from groundsheet.llm import mixing
from groundsheet.llm.queries import QUERIES
from pyspark.sql import functions as F


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_permutation(spark, n):
    keys = mixing.permutation_keys(F.lit(f"k{n}"))
    got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), keys)).collect()]
    assert sorted(got) == list(range(n))
    if n == 1000:
        assert sum(a == b for a, b in enumerate(got)) < 20


def plain_targets(sizes, weights=mixing.WEIGHTS, limit=mixing.LIMIT):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > limit * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: limit * sizes[s] for s in over}


def held(rows, got):
    """Sizes, targets, limits and totals of a mix of rows (doc_id, text, source)."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    targets = plain_targets(sizes) if rows else {}
    assert sorted((str(r.doc_id), r.size, str(r.source)) for r in got) == sorted((str(d), size(t), str(s)) for d, t, s in rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(2 * mixing.BLOCK_WORDS, 0.02 * targets[s]), s


def test_odd_rows(spark, clashing):
    got = mixing.mix(clashing).collect()
    held([(r[0], r[1], r[3]) for r in odd_rows()], got)
    again = mixing.mix(clashing.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_limits(spark):
    draw = random.Random(1)
    rows = [(k, " ".join(["w"] * draw.randrange(1, 400)), draw.choice("aabbbbbbbbcd") if k % 40 else "tiny") for k in range(400)]
    rows += [(1000, "just a few words", "small"), (1001, None, "empty")]
    held(rows, mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_empty_table(spark, none):
    assert mixing.mix(none).collect() == []


def test_whole_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held(rows, QUERIES["op7_mix_sources"](spark, SF).collect())
