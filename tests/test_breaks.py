import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundsheet.operators import breaks


def numbers(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")


def skewed(n, seed):
    """A third of the values are equal, the rest spans many magnitudes."""
    rng = random.Random(seed)
    return [7.0 if rng.random() < 0.34 else rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 6) for _ in range(n)]


@pytest.mark.parametrize("bins, fetch", [(4096, 50_000), (4, 3)])
def test_quantiles_are_exact(spark, monkeypatch, bins, fetch):
    """Small limits force many narrowing passes."""
    monkeypatch.setattr(breaks, "BINS", bins)
    monkeypatch.setattr(breaks, "FETCH", fetch)
    values = skewed(400, 1)
    probabilities = [0, 0.1, 0.25, 0.5, 0.9, 0.999, 1]
    got = breaks.quantiles(numbers(spark, [*values, None, float("nan")]), "v", probabilities)
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_quantiles_of_little(spark):
    assert breaks.quantiles(numbers(spark, [None]), "v", [0.5]) == [None]
    assert breaks.quantiles(numbers(spark, [3]), "v", [0, 0.5, 1]) == [3, 3, 3]
    classes = breaks.breaks_quantile(numbers(spark, range(11)), "v", 5).orderBy("class").collect()
    assert [(r.lo, r.hi) for r in classes] == [(0, 2), (2, 4), (4, 6), (6, 8), (8, 10)]


def deviation(values, edges):
    """Summed squared deviations of classes that end at the given values, ends included."""
    total, rest = 0.0, sorted(values)
    for hi in edges:
        part = [v for v in rest if v <= hi]
        rest = rest[len(part):]
        total += float(((np.array(part) - np.mean(part)) ** 2).sum()) if part else 0.0
    return total


@pytest.mark.parametrize("k", [3, 4])
def test_natural_breaks_are_optimal(spark, k):
    rng = random.Random(2)
    values = [round(rng.gauss(c, 1), 1) for c in (0, 10, 30) for _ in range(6)] + [10.0] * 5
    rows = breaks.breaks_jenks(numbers(spark, values), "v", k).orderBy("class").collect()
    best = min(
        deviation(values, [*cut, max(values)]) for cut in itertools.combinations(sorted(set(values))[:-1], k - 1)
    )
    assert deviation(values, [r.hi for r in rows]) == pytest.approx(best)


@pytest.mark.parametrize("bins", [2, 16, 2048])
def test_natural_breaks_do_not_depend_on_the_bins(spark, monkeypatch, bins):
    rng = random.Random(3)
    values = [round(rng.gauss(c, 2), 3) for c in (0, 40, 90) for _ in range(60)] + [1e6]
    exact = [r.hi for r in breaks.breaks_jenks(numbers(spark, values), "v", 4).orderBy("class").collect()]
    monkeypatch.setattr(breaks, "JENKS_BINS", bins)
    assert [r.hi for r in breaks.breaks_jenks(numbers(spark, values), "v", 4).orderBy("class").collect()] == exact
    assert deviation(values, exact) == pytest.approx(sum(deviation(values[k * 60 : k * 60 + 60], [1e9]) for k in range(3)))


def test_natural_breaks_with_a_far_value(spark):
    """Three clusters, thousands of distinct values: no class is lost to the empty stretch."""
    values = [k / 1500 for k in range(1500)] + [5 + k / 1500 for k in range(1500)] + [1e6]
    rows = breaks.breaks_jenks(numbers(spark, values), "v", 3).orderBy("class").collect()
    assert [r.hi for r in rows] == pytest.approx([1499 / 1500, 5 + 1499 / 1500, 1e6])


def test_quantiles_end_on_infinities_and_many_magnitudes(spark, monkeypatch):
    monkeypatch.setattr(breaks, "FETCH", 20)
    rng = random.Random(5)
    values = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(300)] + [0.0] * 30
    ends = [float("inf")] * 20 + [float("-inf")] * 10
    ordered = sorted(values + ends)
    got = breaks.quantiles(numbers(spark, values + ends), "v", [k / 359 for k in (0, 5, 10, 60, 180, 300, 339, 345, 359)])
    assert got == pytest.approx([ordered[k] for k in (0, 5, 10, 60, 180, 300, 339, 345, 359)])


def test_equal_interval_and_stddev(spark):
    df = numbers(spark, [0, 2, 4, 6, 8, 10])
    assert [r.hi for r in breaks.breaks_equal_interval(df, "v", 4).orderBy("class").collect()] == [2.5, 5, 7.5, 10]
    edges = [r.hi for r in breaks.breaks_stddev(df, "v", 4).orderBy("class").collect()]
    sd = np.std([0, 2, 4, 6, 8, 10], ddof=1)
    assert edges == pytest.approx([5 - sd, 5, 5 + sd, 10])


CLASSES = [
    {"min": -20, "max": 1.5, "color": "#0a3d62", "label": "cold"},
    {"min": 1.5, "max": 12, "color": "#3c8dbc"},
    {"min": None, "max": None, "color": "#777777"},
    {"min": 31, "max": None, "color": "#e55039", "label": "hot"},
]


def test_graduated_steps(spark):
    df = numbers(spark, [-90, -20, 1.4, 1.5, 30.9, 31, None])
    got = [r.color for r in breaks.classify(df, "v", CLASSES).collect()]
    assert got == ["#0a3d62"] * 3 + ["#3c8dbc"] * 2 + ["#e55039", None]


def test_categories_and_fallback(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string")
    classes = [{"value": "a", "color": "#111111"}, {"value": "c", "color": "#222222"}, {"value": None, "color": "#333333"}]
    got = sorted(r.color for r in breaks.classify(df, "v", classes).collect())
    assert got == ["#111111", "#111111", "#cccccc", "#cccccc"]
    table = breaks.categories(df, "v").withColumn("color", F.when(F.col("value") == "b", "#444444").otherwise("#555555"))
    got = {(r.v, r.color) for r in breaks.classify_values(df, "v", table).collect()}
    assert got == {("a", "#555555"), ("b", "#444444"), (None, "#555555")}


def test_legend(spark):
    rows = breaks.legend(numbers(spark, [1, -3, 4, 50]), "v", CLASSES).orderBy("class").collect()
    assert [(r.label, r.n) for r in rows] == [("cold", 2), ("2–12", 1), (None, 0), ("hot", 1)]
    with pytest.raises(ValueError):
        breaks.legend(numbers(spark, [1]), "v", CLASSES[:2])


def test_distribution_of_an_empty_field(spark):
    rows = {(r.part, r["item"]): r.value for r in breaks.distribution(numbers(spark, [None]), "v").collect()}
    assert rows[("stat", "count")] == 0 and rows[("percentile", "p50")] is None


def test_starts_found_between_neighbours():
    """The monotone search against all starts."""
    draw = np.random.default_rng(4)
    for n in (1, 2, 7, 60):
        v, w = np.sort(draw.lognormal(size=n)), draw.integers(1, 5, n).astype(float)
        table = np.stack([v, v, v * w, v * v * w, w], axis=1)
        cost, before = breaks._spread(table), draw.random(n + 1)
        got, start = breaks._least_starts(before, cost, np.arange(n + 1), 0, 0)
        for j in range(n + 1):
            options = before[: j + 1] + cost(np.arange(j + 1), np.full(j + 1, j))
            assert got[j] == options.min() and start[j] == options.argmin()
