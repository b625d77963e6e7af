"""Exact quantiles of every group at once, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundsheet.operators.lineage import materialize

#: Bins a span of values is cut into, and rows from which on it is cut instead of listed value by value.
BINS, FEW = 512, 4096


def _spot(v: Column, lo: Column, hi: Column) -> Column:
    """Number of a value's bin in [lo, hi], rising with the value; both ends have bins of their own, so spans shrink."""
    small, large = F.least(F.abs(lo), F.abs(hi)), F.greatest(F.abs(lo), F.abs(hi))
    step = (F.log(large) - F.log(small)) / BINS
    magnitudes = F.floor((F.log(F.abs(v)) - F.log(small)) / step).cast("double") * F.signum(lo)
    to_zero = F.when(v == 0, -BINS - 1.0).otherwise(F.greatest(F.lit(-1.0 * BINS), F.floor((F.log(F.abs(v)) - F.log(large)) * 8).cast("double")))
    even = F.floor(F.try_divide(v / 2 - lo / 2, (hi / 2 - lo / 2) / BINS)).cast("double")
    return (
        F.when(v == lo, -1e9).when(v == hi, 1e9)
        .when((lo < 0) & (hi > 0), F.signum(v))
        .when(lo * hi == 0, to_zero * F.when(hi > 0, 1.0).otherwise(-1.0))
        .when(large > 8 * small, magnitudes)
        .otherwise(even)
    )


def group_quantiles(df: DataFrame, keys: Sequence[str], field: str, probabilities: Sequence[float]) -> DataFrame:
    """``keys``, p and value: exact interpolated quantiles of ``field`` in every group, however large a group is.

    For each group and wanted rank the span of values that holds the rank is cut into bins, whose
    counts say which bin holds it; that bin is the next span, until it is a single value.  All groups narrow in the same pass,
    bins are counted before the shuffle, and spans stay rows of a table.  Null keys are a group; null and
    NaN values do not count, and a group without others gives no row.
    """
    v = F.col(field).cast("double")
    values = df.select(F.struct(*keys).alias("g"), v.alias("v")).where(v.isNotNull() & ~F.isnan(v))
    groups = values.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    groups = materialize(groups.withColumn("p", F.explode(F.lit([float(p) for p in probabilities]))), "groups")
    wanted = groups.withColumn("spot", F.col("p") * (F.col("n") - 1))
    wanted = wanted.withColumn("low", F.floor("spot")).withColumn("high", F.ceil("spot"))
    ranks = wanted.withColumn("rank", F.explode(F.array("low", "high")))
    spans = ranks.select("g", "rank", "lo", "hi", F.lit(0).cast("long").alias("before"), "n").distinct()
    found = None
    while True:
        settled = spans.where("lo = hi").select("g", "rank", F.col("lo").alias("at"))
        found = settled if found is None else found.union(settled)
        spans = spans.where("lo < hi")
        if spans.isEmpty():
            break
        distinct = spans.select("g", "lo", "hi", "before", "n").distinct()
        met = values.join(distinct, "g").where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        spot = F.when(F.col("n") <= FEW, F.col("v")).otherwise(_spot(F.col("v"), F.col("lo"), F.col("hi")))
        bins = met.groupBy("g", "lo", "hi", "before", spot.alias("spot")).agg(
            F.min("v").alias("b_lo"), F.max("v").alias("b_hi"), F.count("*").alias("rows")
        )
        ahead = Window.partitionBy("g", "lo", "hi").orderBy("b_lo").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("first", F.col("before") + F.coalesce(F.sum("rows").over(ahead), F.lit(0))).drop("before")
        held = spans.select("g", "rank", "lo", "hi").join(bins, ["g", "lo", "hi"])
        held = held.where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("rows")))
        spans = materialize(held.select(
            "g", "rank", F.col("b_lo").alias("lo"), F.col("b_hi").alias("hi"), F.col("first").alias("before"), F.col("rows").alias("n")
        ), "spans")
    low, high = found.toDF("g", "low", "a"), found.toDF("g", "high", "b")
    part = F.col("spot") - F.col("low")
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * part)
    return wanted.join(low, ["g", "low"]).join(high, ["g", "high"]).select("g.*", "p", value.alias("value"))
