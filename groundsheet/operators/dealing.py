"""Equi-joins whose work is the pairs they test, not the rows they read.

A few megabytes a side can stand for billions of pairs.  Adaptive execution sizes tasks by bytes and would
give all of them to one task, so the pairs of every key are counted first and rows dealt by them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.operators import lineage

#: Pairs that one task tests: a few seconds of work.
PAIRS = 20_000_000
SALT_LIMIT = 4096
MOST_TASKS = 20_000


def dealt(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], marks: tuple[str, str], pairs: int | None = None
) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """Both sides dealt over as many tasks as their pairs ask for, and the names of the columns to join on.

    The pairs of a key with over ``pairs`` of them are cut into blocks of rows by rows, about as wide as high,
    so either side is repeated about as often as the root of the number of blocks.  Sides with few pairs in all
    come back as they are.
    """
    pairs = pairs or PAIRS
    names = [f"_k{i}" for i in range(len(left_keys))]

    def counted(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
        return df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.count("*").cast("double").alias(out))

    work = lineage.materialize(counted(left, left_keys, "_l").join(counted(right, right_keys, "_r"), names), "work")
    each = F.col("_l") * F.col("_r")
    total, fullest = work.agg(F.sum(each), F.max(each)).first()
    if (total or 0) <= pairs:
        return left, right, list(left_keys), list(right_keys)
    tasks = min(MOST_TASKS, max(left.sparkSession.sparkContext.defaultParallelism, math.ceil(total / pairs)))
    left_keys, right_keys = list(left_keys), list(right_keys)
    if fullest > pairs:
        blocks = F.least(F.lit(SALT_LIMIT), F.ceil(each / pairs))
        # of all ways to cut them this one sends the fewest rows: left ones go _n1 times, right ones _n0 times
        across = F.least(blocks, F.greatest(F.lit(1), F.round(F.sqrt(blocks * F.col("_l") / F.col("_r"))))).cast("int")
        # no more rows than the whole work has tasks
        crowded = work.where(each > pairs).select(*names, across.alias("_n0"), F.ceil(blocks / across).cast("int").alias("_n1"))
        left, right = _salted(left, left_keys, crowded, names, marks[0], 0), _salted(right, right_keys, crowded, names, marks[1], 1)
        left_keys, right_keys = ([*keys, f"{m}_p0", f"{m}_p1"] for keys, m in zip((left_keys, right_keys), marks, strict=True))
    return left.repartition(tasks, *left_keys), right.repartition(tasks, *right_keys), left_keys, right_keys


def _salted(df: DataFrame, keys: Sequence[str], crowded: DataFrame, names: list[str], mark: str, mine: int) -> DataFrame:
    seen = df.columns
    spread = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if seen.count(c) == 1 and "map<" not in t and t != "variant"])
    table = crowded.toDF(*keys, f"{mark}_n0", f"{mark}_n1")
    count = [F.coalesce(F.col(f"{mark}_n{k}"), F.lit(1)) for k in (0, 1)]
    df = df.join(F.broadcast(table), list(keys), "left")
    df = df.withColumn(f"{mark}_p{mine}", F.pmod(spread, count[mine]).cast("int"))
    repeated = F.explode(F.sequence(F.lit(0), count[1 - mine] - 1))
    return df.withColumn(f"{mark}_p{1 - mine}", repeated).drop(f"{mark}_n0", f"{mark}_n1")


def join(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs: int | None = None) -> DataFrame:
    """Inner equi-join on ``keys``, dealt by pairs; the sides share no other column names."""
    inner = [f"_right{k}" for k in keys]
    one, two, left_keys, right_keys = dealt(left, right.withColumnsRenamed(dict(zip(keys, inner, strict=True))), keys, inner, ("_dl", "_dr"), pairs)
    return one.join(two, same(left_keys, right_keys)).drop(*right_keys, *(k for k in left_keys if k not in keys))


def same(left_keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for mine, other in zip(left_keys, right_keys, strict=True):
        on = on & (F.col(mine) == F.col(other))
    return on
