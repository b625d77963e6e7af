import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundsheet.llm import hard_negatives

KINDS = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """All pairs in plain Python."""
    usable = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(256.0 * float(np.float32(x))) for x in vector])
        usable[vec_id] = min(usable.get(vec_id, row), row)
    found = []
    for a, (label, vector) in usable.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, other)), b, kind) for b, (kind, other) in usable.items() if b != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and -30 * p <= -100 * s[0] <= -90 * p][:10]
            found += [(a, positive, k, n, -p, -s) for k, (s, n, _) in enumerate(fits, 1)]
    return sorted(found)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clustered(n, width=16, seed=5):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    rows = []
    for k in range(n):
        v = centres[draw.integers(12)] + 0.4 * draw.normal(size=width)
        rows.append((k, [float(x) for x in (v / np.linalg.norm(v)).astype(np.float32)], int(draw.integers(10))))
    return rows


@pytest.mark.parametrize("block_rows", [10_000, 130])
def test_clusters_against_all_pairs(spark, block_rows):
    rows = clustered(1200) + [(1200 + k, clustered(1200)[k][1], 3) for k in range(0, 300)]  # ties by copies
    df = spark.createDataFrame(rows, KINDS)
    assert result(hard_negatives.hard_negatives(df, block_rows=block_rows)) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(250, 4) + [
        (300, None, 1), (400, [1.0, 0.0, 0.0, 0.0], None), (None, [1.0, 0.0, 0.0, 0.0], 1), (500, [nan, 0.0, 0.0, 0.0], 1),
        (501, [None, 0.0, 0.0, 0.0], 1), (502, [0.0, inf, 0.0, 0.0], 1), (600, [0.0] * 4, 2), (601, [0.0] * 4, 3), (602, [-0.1] * 4, 2),
        (700, [], 2), (701, [0.5], 2), (702, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 3), (800, [1.0, 0.0, 0.0, 0.0], 4), (800, [1.0, 0.0, 0.0, 0.0], 4), (800, [0.0, 1.0, 0.0, 0.0], 5),
        (900, [1e6, -2e6, 3e6, 1.0], 7), (901, [3e6, -2e6, 3e6, 1.0], 7), (902, [1e6, -1e6, 2e6, 1.0], 8),
    ]
    df = spark.createDataFrame(rows, KINDS)
    assert result(hard_negatives.hard_negatives(df, block_rows=90)) == plain(rows)
    extra = df.select("*", *(F.lit("x").alias(c) for c in ("block", "score", "slot", "parts", "rank", "worst", "n", "place")))
    assert result(hard_negatives.hard_negatives(extra)) == plain(rows)
    assert result(hard_negatives.hard_negatives(df.limit(0))) == []
    huge = spark.createDataFrame([(100, [3e38, 1.0], 1), (101, [3e38, 2.0], 1)], KINDS)
    assert result(hard_negatives.hard_negatives(huge)) == []


def test_one_dense_group_holds_a_third(spark):
    """Many copies of one vector under two labels: windows stay right and what a task finds stays in proportion."""
    rows = clustered(600)
    rows += [(1000 + k, rows[1][1], k % 2) for k in range(300)]
    df = spark.createDataFrame(rows, KINDS)
    assert result(hard_negatives.hard_negatives(df, block_rows=200)) == plain(rows)


def test_the_index_leaves_out_dimensions_and_pairs():
    rows = clustered(2000, 64)
    whole = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    index = hard_negatives.Index(np.arange(2000), np.zeros(2000, np.int64), whole)
    full = whole[:50] @ whole.T
    for share in (0.95, 0.6, 0.2, -1.0):
        limits = share * np.diag(full[:, :50])
        a, b, score = index.above(whole[:50], limits)
        assert (score == full[a, b]).all()
        met = set(zip(a.tolist(), b.tolist()))
        assert met >= set(zip(*(x.tolist() for x in np.nonzero(full >= limits[:, None]))))
        if share == 0.95:
            assert len(met) < 0.1 * full.size
