"""Grouped quantiles against numpy."""

import numpy as np
import pytest
from groundsheet.operators import quantiles

SHARES = [0.0, 0.1, 0.5, 0.77, 1.0]


@pytest.mark.parametrize("few", [1, 50, 4096])
def test_every_group(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    draw = np.random.default_rng(few)
    groups = {
        "even": draw.random(3000), "far": np.append(draw.random(900), [1e300, -1e300, 5e-324]), "signs": draw.normal(size=500) ** 5,
        "same": np.full(300, 2.5), "one": np.array([7.0]), "zero": np.append(-draw.lognormal(sigma=30, size=400), np.zeros(50)),
        "whole": draw.integers(0, 9, 500).astype(float), None: draw.lognormal(sigma=20, size=300),
    }
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("even", None), ("even", float("nan")), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {(r.k, r.p): r.value for r in quantiles.group_quantiles(frame, ["k"], "v", SHARES).collect()}
    assert got.keys() == {(k, p) for k in groups for p in SHARES}
    for (k, p), value in got.items():
        ordered = np.sort(groups[k])
        at = p * (len(ordered) - 1)
        a, b = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        assert value == (a if a == b else a + (b - a) * (at - np.floor(at))), (k, p)


def test_infinities_and_no_rows(spark):
    rows = [("a", float("-inf"))] + [("a", float(k)) for k in range(9)] + [("a", float("inf"))]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = [r.value for r in quantiles.group_quantiles(frame, ["k"], "v", [0.0, 0.5, 1.0]).orderBy("p").collect()]
    assert got == [float("-inf"), 4.0, float("inf")]
    assert quantiles.group_quantiles(frame.limit(0), ["k"], "v", [0.5]).collect() == []


def test_no_group_is_held(spark):
    frame = spark.range(20_000).selectExpr("id % 3 as k", "sin(id) as v")
    plan = quantiles.group_quantiles(frame, ["k"], "v", [0.5])._jdf.queryExecution().toString()
    assert "percentile" not in plan and "collect_list" not in plan
