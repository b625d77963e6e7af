"""Class breaks from a field's distribution.

Quantiles are exact at any size without sorting the column or holding its values in one
task: a histogram with a bounded number of bins narrows down, pass by pass, the interval
that holds each wanted rank.  Only bin counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
FETCH = 50_000  # distinct values fetched in one pass, over all open ranks together
JENKS_BINS = 2048
CLASS_LIMIT = 10_000
CLASS_SCHEMA = "class int, lo double, hi double"


def _values(df: DataFrame, field: str) -> DataFrame:
    v = F.col(field).cast("double")
    return df.select(v.alias("v")).where(v.isNotNull() & ~F.isnan(v))


def order_values(df: DataFrame, field: str, ranks: Sequence[int]) -> dict[int, float]:
    """Values at the given 0-based ranks of the sorted field."""
    values = _values(df, field)
    return _at_ranks(values, ranks, _span(values))


def _finite(v: Column) -> Column:
    return F.abs(v) < float("inf")


def _span(values: DataFrame) -> tuple[int, float, float, int, int]:
    """Rows, smallest and largest finite value, and the numbers of negative and positive infinities."""
    v = F.col("v")
    inside = F.when(_finite(v), v)
    return tuple(values.agg(
        F.count("*"), F.min(inside), F.max(inside), F.count_if(v == float("-inf")), F.count_if(v == float("inf"))
    ).first())


def _at_ranks(values: DataFrame, ranks: Sequence[int], span: tuple[int, float, float, int, int]) -> dict[int, float]:
    """Values at ranks; infinities are counted off at the ends and take no part in the narrowing."""
    n, lo, hi, low_ends, high_ends = span
    wanted = {r for r in ranks if 0 <= r < n}
    found: dict[int, float] = {r: float("-inf") for r in wanted if r < low_ends}
    found |= {r: float("inf") for r in wanted if r >= n - high_ends}
    values = values.where(_finite(F.col("v")))
    # rank -> (smallest value, largest value, rows before it, rows in it)
    open_ranks = {r: (lo, hi, low_ends, n - low_ends - high_ends) for r in wanted - set(found)}
    while open_ranks:
        found |= {r: s[0] for r, s in open_ranks.items() if s[0] == s[1]}
        open_ranks = {r: s for r, s in open_ranks.items() if r not in found}
        spans = sorted(set(open_ranks.values()))
        if not spans:
            break
        bins = _bin_counts(values, spans)
        for r, span_ in list(open_ranks.items()):
            before = span_[2]
            for b_lo, b_hi, count in bins[spans.index(span_)]:
                if r < before + count:
                    if (b_lo, b_hi) == span_[:2]:
                        raise ArithmeticError(f"values between {b_lo} and {b_hi} cannot be told apart")
                    open_ranks[r] = (b_lo, b_hi, before, count)
                    break
                before += count
    return found


def _bin_counts(values: DataFrame, spans: list[tuple]) -> dict[int, list[tuple]]:
    """Per span the bins (smallest, largest, rows) in order, at most BINS each.

    Spans with few rows get one bin per distinct value, which settles them.  Others are cut evenly:
    by order of magnitude where both ends have one sign and lie far apart, by value elsewhere, so
    that values of many magnitudes narrow as fast as even ones.
    """
    which = F.lit(None).cast("int")
    spot = F.lit(None).cast("double")
    v = F.col("v")
    for i, (lo, hi, _, rows) in enumerate(spans):
        inside = (v >= lo) & (v <= hi)
        which = F.when(inside, F.lit(i)).otherwise(which)
        if rows <= FETCH // len(spans):
            here = v
        else:
            here = _bin(v, lo, hi, max(2, BINS // max(1, len(spans) // 8)))
        spot = F.when(inside, here).otherwise(spot)
    rows = (
        values.select(which.alias("span"), spot.alias("spot"), "v")
        .where(F.col("span").isNotNull())
        .groupBy("span", "spot")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
        .collect()
    )
    out: dict[int, list[tuple]] = {i: [] for i in range(len(spans))}
    for r in sorted(rows, key=lambda r: (r["span"], r["lo"])):
        out[r["span"]].append((r["lo"], r["hi"], r["n"]))
    return out


def _bin(v: Column, lo: float, hi: float, bins: int) -> Column:
    """Number of the bin of a value in [lo, hi]: rising with the value, and never one bin for both ends."""
    small, large = sorted((abs(lo), abs(hi)))
    if lo * hi > 0 and large > 8 * small:
        sign = 1.0 if lo > 0 else -1.0
        low, step = math.log(small), (math.log(large) - math.log(small)) / bins
        spot = F.floor((F.log(F.abs(v)) - low) / step) * sign
    elif lo < 0 < hi:  # the two signs apart, each by magnitude in the next pass
        spot = F.signum(v)
    elif lo * hi == 0 and large > 0:
        top = math.log(large)
        near = F.greatest(F.lit(-bins), F.floor((F.log(F.abs(v)) - top) * 8))
        spot = F.when(v == 0, F.lit(-bins - 1)).otherwise(near) * (1.0 if hi > 0 else -1.0)
    else:
        spot = F.floor((v / 2 - lo / 2) / ((hi / 2 - lo / 2) / bins))
    # the ends have bins of their own, so every pass shrinks a span
    return F.when(v == lo, -1e9).when(v == hi, 1e9).otherwise(spot.cast("double"))


def quantiles(df: DataFrame, field: str, probabilities: Sequence[float]) -> list[float | None]:
    """Exact interpolated quantiles."""
    values = _values(df, field)
    return _quantiles(values, probabilities, _span(values))


def _quantiles(values: DataFrame, probabilities: Sequence[float], span: tuple) -> list[float | None]:
    if span[0] == 0:
        return [None for _ in probabilities]
    spots = [p * (span[0] - 1) for p in probabilities]
    at = _at_ranks(values, [r for s in spots for r in (math.floor(s), math.ceil(s))], span)

    def between(s: float) -> float:
        a, b = at[math.floor(s)], at[math.ceil(s)]
        return a if a == b else a + (b - a) * (s - math.floor(s))

    return [between(s) for s in spots]


def approx_quantiles(df: DataFrame, field: str, probabilities: Sequence[float], accuracy: int = 10_000) -> list[float]:
    """One-pass sketch instead of the exact passes."""
    row = _values(df, field).agg(F.percentile_approx("v", list(probabilities), accuracy)).first()
    return list(row[0] or [])


def distribution(df: DataFrame, field: str, probabilities: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), bins: int = 10) -> DataFrame:
    """Summary rows (``part``, ``item``, ``value``): statistics, percentiles, histogram."""
    values = _values(df, field)
    stats = values.agg(
        F.count("*").cast("double").alias("count"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.avg("v").alias("avg"),
        F.stddev("v").alias("stddev"),
    ).first()
    marks = _quantiles(values, probabilities, _span(values))
    rows = [("stat", k, stats[k]) for k in ("count", "min", "max", "avg", "stddev")]
    rows += [("percentile", f"p{p * 100:g}", q) for p, q in zip(probabilities, marks)]
    counts = histogram(df, field, bins, stats["min"], stats["max"]).collect() if stats["count"] else []
    rows += [("bin", f"{r['bin']}", float(r["count"])) for r in counts]
    return df.sparkSession.createDataFrame(rows, "part string, item string, value double")


def histogram(df: DataFrame, field: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Counts of equal-width bins 1..bins over [lo, hi]; the last bin holds hi."""
    v = F.col("v")
    spot = F.floor((v - lo) / F.lit(((hi - lo) / bins) or 1.0)).cast("int") + 1
    return _values(df, field).groupBy(F.least(F.lit(bins), spot).alias("bin")).count()


def _classes(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return df.sparkSession.createDataFrame(rows, CLASS_SCHEMA)


def breaks_quantile(df: DataFrame, field: str, k: int, exact: bool = True) -> DataFrame:
    steps = [i / k for i in range(k + 1)]
    return _classes(df, quantiles(df, field, steps) if exact else approx_quantiles(df, field, steps))


def breaks_equal_interval(df: DataFrame, field: str, k: int) -> DataFrame:
    lo, hi = _values(df, field).agg(F.min("v"), F.max("v")).first()
    return _classes(df, [lo + (hi - lo) * i / k for i in range(k + 1)])


def breaks_stddev(df: DataFrame, field: str, k: int) -> DataFrame:
    """k classes one standard deviation wide around the mean; the outer two are open
    and end at the extremes."""
    lo, hi, mean, sd = _values(df, field).agg(F.min("v"), F.max("v"), F.avg("v"), F.stddev("v")).first()
    inner = [mean + (i - k / 2) * sd for i in range(1, k)]
    return _classes(df, [lo, *[min(hi, max(lo, v)) for v in inner], hi])


def breaks_jenks(df: DataFrame, field: str, k: int) -> DataFrame:
    """Natural breaks: the k classes with the least within-class variance, exact at any size.

    Spark sums values in bins.  The best cuts between bins bound the optimum from above.  From
    below it is bounded by letting each cut fall inside a bin and leaving that bin's values out.
    Bins inside which the optimum may still be cut are split further, until none is left.
    """
    values = _values(df, field).where(_finite(F.col("v")))
    n, lo, hi = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return _classes(df, [])
    spans = [(lo, hi)]
    table = np.empty((0, 5))
    while True:
        table = np.vstack([table, _bin_sums(values, (lo, hi), spans, max(2, JENKS_BINS // len(spans)))])
        table = table[np.argsort(table[:, 0])]
        classes = min(k, len(table))
        total, cuts = _best_cuts(table, classes)
        divided = table[:, 0] < table[:, 1]
        open_ = divided & (_cut_inside(table, classes) < total) if len(table) >= k else divided
        if not open_.any():
            break
        spans = [tuple(row) for row in table[open_][:, :2]]
        table = table[~open_]
    edges = [table[0][0], *[table[c - 1][1] for c in cuts], table[-1][1]]
    return _classes(df, edges)


def _bin_sums(values: DataFrame, whole: tuple, spans: list[tuple], bins: int) -> np.ndarray:
    """Smallest and largest value, sum, sum of squares and rows of each bin of each span.

    Spans are parts of the even bins that the first pass cut ``whole`` into, and are found by these.
    """
    v, (lo, hi) = F.col("v"), whole
    span = hi - lo or 1.0
    x = (v - lo) / span  # sums of squares are taken on [0, 1]

    def coarse(value: Column) -> Column:
        return F.when(value == lo, -1).when(value == hi, JENKS_BINS).otherwise(F.floor((value - lo) / span * JENKS_BINS))

    table = values.sparkSession.createDataFrame([(float(a), float(b)) for a, b in spans], "a double, b double")
    table = F.broadcast(table.withColumn("bin", coarse(F.col("a"))))  # as many rows as the driver holds bins
    met = values.withColumn("bin", coarse(v)).join(table, "bin").where((v >= F.col("a")) & (v <= F.col("b")))
    if spans == [whole]:
        met = values.withColumns({"a": F.lit(lo), "b": F.lit(hi)})
        spot = coarse(v)
    else:
        spot = F.floor((v - F.col("a")) / (F.col("b") - F.col("a")) * bins)
        spot = F.when(v == F.col("a"), -1).when(v == F.col("b"), bins).otherwise(spot)
    rows = met.groupBy("a", spot).agg(F.min("v"), F.max("v"), F.sum(x), F.sum(x * x), F.count("*")).collect()
    return np.array([tuple(r)[2:] for r in rows], dtype=float)


def _spread(table: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Summed squared deviations of the rows from bin ``start`` up to bin ``end``."""
    total = np.vstack([np.zeros(3), np.cumsum(table[:, 2:], axis=0)])

    def cost(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        s, q, w = (total[end] - total[start]).T
        return np.maximum(q - s * s / np.maximum(w, 1), 0)

    return cost


def _least_starts(before: np.ndarray, cost: Callable, ends: np.ndarray, low: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the rising ``ends`` j the least before[i] + cost(i, j) over low <= i <= j - gap, and the first such i.

    Summed squares of sorted values make the best i rise with j, so every other end is searched only
    between its neighbours' starts: about len(ends) sums a level, and a logarithm of levels.
    """
    n = len(ends)
    value, start = np.full(n, np.inf), np.full(n, low)
    step = 1 << max(0, n - 1).bit_length()
    while step:
        at = np.arange(step - 1, n, 2 * step)
        if len(at):
            first = np.where(at >= step, start[at - step], low)
            last = np.where(at + step < n, start[np.minimum(at + step, n - 1)], ends[at] - gap)
            sizes = np.minimum(last, ends[at] - gap) - first + 1
            offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            starts = np.arange(sizes.sum()) + np.repeat(first - offsets, sizes)
            options = before[starts] + cost(starts, np.repeat(ends[at], sizes))
            value[at] = np.minimum.reduceat(options, offsets)
            hits = np.flatnonzero(options == np.repeat(value[at], sizes))
            start[at] = starts[hits[np.searchsorted(hits, offsets)]]
        step >>= 1
    return value, start


def _best_cuts(table: np.ndarray, k: int) -> tuple[float, list[int]]:
    """The least summed squared deviations with cuts between bins, and the first bins of classes 2..k."""
    cost, n = _spread(table), len(table)
    best = np.concatenate([[0.0], cost(np.zeros(n, int), np.arange(1, n + 1))])
    came = []
    for c in range(2, k + 1):
        now, back = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int)
        now[c:], back[c:] = _least_starts(best, cost, np.arange(c, n + 1), c - 1, 1)
        best = now
        came.append(back)
    cuts, j = [], n
    for back in reversed(came):
        j = back[j]
        cuts.append(int(j))
    return float(best[n]), cuts[::-1]


def _cut_inside(table: np.ndarray, k: int) -> np.ndarray:
    """Per bin a lower bound of the total of any k classes that cut it.

    A cut bin's values are left out, which never raises a total.
    """

    def relaxed(rows: np.ndarray) -> list[np.ndarray]:
        """By number of classes, least totals of the first j bins, cut bins left out."""
        cost, n = _spread(rows), len(rows)
        first = np.concatenate([[0.0], cost(np.zeros(n, int), np.arange(1, n + 1))])
        out = [first]
        for _ in range(k - 2):
            last = out[-1]
            reach = np.minimum(last, np.concatenate([[np.inf], last[:-1]]))  # start at j, or after the cut bin j - 1
            out.append(_least_starts(reach, cost, np.arange(n + 1), 0, 0)[0])
        return out

    n = len(table)
    if k < 2:
        return np.full(n, np.inf)
    left, right = relaxed(table), relaxed(table[::-1])
    options = [left[c - 1][:n] + right[k - c - 1][::-1][1:] for c in range(1, k)]
    return np.minimum.reduce(options)


def categories(df: DataFrame, field: str) -> DataFrame:
    """One class per distinct value, with its row count."""
    return df.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("count"))


# --- classes to rows ------------------------------------------------------------------

FALLBACK_COLOR = "#cccccc"  # colour of values no category names (fixed value)


def graduated(field: Column, classes: Sequence[dict], want: str = "color") -> Column:
    """Step function over classes ``{min, max, color, label}``.

    Values below the second class's min take the first class; a later class without a
    min is skipped; a null value stays null.
    """
    out = F.lit(classes[0][want])
    for c in classes[1:]:
        if c.get("min") is not None:
            out = F.when(field >= F.lit(float(c["min"])), F.lit(c[want])).otherwise(out)
    return F.when(field.isNotNull(), out)


def classify(df: DataFrame, field: str, classes: Sequence[dict], out: str = "color", want: str = "color") -> DataFrame:
    """Colour (or another class member) per row, from graduated or categorized classes.

    A categorized list is matched with a join, so it may be as long as the data needs.
    """
    if "value" not in classes[0]:
        return df.withColumn(out, graduated(F.col(field).cast("double"), classes, want))
    table = df.sparkSession.createDataFrame(
        [(str(c["value"]), c[want]) for c in classes if c.get("value") is not None],
        "_value string, _want string",
    ).dropDuplicates(["_value"])
    if len(classes) <= CLASS_LIMIT:
        table = F.broadcast(table)  # the list's length is known here
    matched = df.join(table, F.col(field).cast("string") == F.col("_value"), "left")
    return matched.withColumn(out, F.coalesce("_want", F.lit(FALLBACK_COLOR))).drop("_value", "_want")


def classify_values(df: DataFrame, field: str, classes: DataFrame) -> DataFrame:
    """Categorized colours from a table ``value, color`` of any size."""
    table = classes.select(F.col("value").alias("_value"), F.col("color").alias("_color"))
    matched = df.join(table, F.col(field).eqNullSafe(F.col("_value")), "left")
    return matched.withColumn("color", F.coalesce("_color", F.lit(FALLBACK_COLOR))).drop("_value", "_color")


def spec_classes(breaks: DataFrame, colors: Sequence[str]) -> list[dict]:
    """Classes for ``classify`` from a breaks table and as many colours."""
    rows = breaks.orderBy("class").collect()
    if len(rows) > len(colors):
        raise ValueError(f"{len(rows)} classes need as many colours")
    return [
        {"min": r["lo"], "max": r["hi"], "color": c, "label": f"{r['lo']:,.0f}–{r['hi']:,.0f}"}
        for r, c in zip(rows, colors)
    ]


def legend(df: DataFrame, field: str, classes: Sequence[dict]) -> DataFrame:
    """The class table with labels, colours and row counts; empty classes stay."""
    if not 3 <= len(classes) <= 7:
        raise ValueError("a legend reads well with 3 to 7 classes")
    numbered = [{**c, "n": i + 1} for i, c in enumerate(classes)]
    counts = (
        df.select(graduated(F.col(field).cast("double"), numbered, "n").alias("class"))
        .where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.count("*").alias("n"))
    )
    number = lambda v: None if v is None else float(v)
    table = df.sparkSession.createDataFrame(
        [(c["n"], number(c.get("min")), number(c.get("max")), c["color"], c.get("label")) for c in numbered],
        "class int, lo double, hi double, color string, label string",
    )
    label = F.coalesce(
        "label",
        F.when(F.col("hi").isNull(), F.concat(F.format_number("lo", 0), F.lit("+"))).otherwise(
            F.concat(F.format_number("lo", 0), F.lit("–"), F.format_number("hi", 0))
        ),
    )
    joined = table.join(counts, "class", "left")
    return joined.withColumn("label", label).withColumn("n", F.coalesce("n", F.lit(0)))
