"""Quality rules whose thresholds follow each language and source.

Rates of every document go into quantile sketches with logarithmic buckets.  A sketch is rows of
(bucket, count), so sketches merge by adding counts: sources into languages, languages into all.
The thresholds are the sketches' quartiles widened by a multiple of their distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundsheet.llm.texts import filled, slices, split_parts, split_words
from groundsheet.operators.lineage import materialize

WINDOW = 5
MIN_WORDS, REPEAT_PERCENT = 10, 20
#: Bucket k of a sketch holds values up to GAMMA ** k: quantiles are right to one percent.
GAMMA, ZERO_BUCKET = 1.02, -10_000
#: A document fails outside the quartiles widened by REACH times their distance.
REACH = 3.0
#: Rates, the least distance of quartiles counted for each, and whether low values fail too.
RATES = {
    "symbol_rate": (0.1, False), "upper_rate": (0.1, False), "dup_line_rate": (0.15, False),
    "repeat_rate": (0.1, False), "mean_word": (1.0, True),
}
#: A sketch with fewer documents gives way to its language's, then to that of all documents.
MIN_GROUP = 100

_COUNTS = "n_words long, word_chars long, n_symbols long, n_upper long, n_lines long, n_dup_lines long, n_repeat_words long"


def _repeats(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Per word, whether a window of WINDOW words around it is found twice or more in its row."""
    n = len(codes) - WINDOW + 1
    hit = np.zeros(len(codes), bool)
    if n < 1:
        return hit
    start = np.flatnonzero(rows[:n] == rows[WINDOW - 1 :])
    if not len(start):
        return hit

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return pd.factorize(a * (int(b.max()) + 1) + b)[0].astype(np.int64)

    two = paired(codes[:-1], codes[1:])
    four = paired(two[start], two[start + 2])
    own = paired(paired(four, codes[start + 4]), rows[start])
    again = start[np.bincount(own)[own] > 1]
    for k in range(WINDOW):
        hit[again + k] = True
    return hit


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Base counts of non-null texts."""
    n = len(texts)
    rows, codes, words = split_words(texts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    line_rows, line_codes, lines = split_parts(pc.split_pattern(texts, "\n"))
    filled_ = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    keep = filled_[line_codes]
    line_rows, line_codes = line_rows[keep], line_codes[keep]
    first = pd.DataFrame({"r": line_rows, "c": line_codes}).duplicated()
    per_row = lambda r, w=None: np.bincount(r, weights=w, minlength=n).astype(np.int64)
    return {
        "n_words": per_row(rows),
        "word_chars": per_row(rows, chars[codes]),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False),
        "n_upper": pc.count_substring_regex(texts, r"\p{Lu}").to_numpy(zero_copy_only=False),
        "n_lines": per_row(line_rows),
        "n_dup_lines": per_row(line_rows, first.to_numpy()),
        "n_repeat_words": per_row(rows, _repeats(rows, codes)),
    }


def count_documents(documents: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the base counts of every whole text; a null text counts as empty."""
    kept = documents.select(*keys, F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {name: pa.array(v, pa.int64()) for name, v in counts(filled(batch)).items()}
            yield pa.RecordBatch.from_pydict({k: batch.column(k) for k in keys} | found)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keys).schema)
    return kept.mapInArrow(run, f"{fields}, {_COUNTS}")


def rates() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "upper_rate": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
        "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "mean_word": F.col("word_chars") / words,
    }


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, rate, bucket, n: one sketch per language, source and rate of documents with a word."""
    listed = [
        F.struct(
            F.lit(name).alias("rate"),
            F.when(value > 0, F.ceil(F.log(value) / math.log(GAMMA))).otherwise(ZERO_BUCKET).cast("int").alias("bucket"),
        )
        for name, value in rates().items()
    ]
    rows = counted.where("n_words > 0").select("lang", "source", F.inline(F.array(*listed)))
    return rows.groupBy("lang", "source", "rate", "bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, rate, docs, low and high from sketches merged to ``keys``."""
    merged = sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rate")
    upto = F.sum("n").over(group.orderBy("bucket"))
    ranked = merged.withColumn("upto", upto).withColumn("docs", F.sum("n").over(group))
    value = F.when(F.col("bucket") == ZERO_BUCKET, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket") - 0.5))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("docs") * q), value))
    least = F.element_at(F.create_map(*[F.lit(x) for name, (gap, _) in RATES.items() for x in (name, gap)]), F.col("rate"))
    both = F.element_at(F.create_map(*[F.lit(x) for name, (_, low) in RATES.items() for x in (name, low)]), F.col("rate"))
    cut = ranked.groupBy(*keys, "rate", "docs").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    gap = F.greatest(F.col("q3") - F.col("q1"), least) * REACH
    return cut.select(
        *keys, "rate", "docs", F.when(both, F.col("q1") - gap).alias("low"), (F.col("q3") + gap).alias("high")
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and ``cuts``, a map from rate to low and high, for every group in the sketches."""
    own, by_lang, all_ = fences(sketch, ["lang", "source"]), fences(sketch, ["lang"]), fences(sketch, [])
    wide = by_lang.select(F.col("lang").alias("l"), "rate", F.struct("docs", "low", "high").alias("wide"))
    widest = all_.select("rate", F.struct("docs", "low", "high").alias("widest"))
    found = own.select("lang", "source", "rate", F.struct("docs", "low", "high").alias("own"))
    found = found.join(wide, found.lang.eqNullSafe(F.col("l")) & (found.rate == wide.rate)).drop(wide.rate).join(widest, "rate")
    used = F.when(F.col("own.docs") >= MIN_GROUP, F.col("own")).when(F.col("wide.docs") >= MIN_GROUP, F.col("wide"))
    return found.withColumn("used", used.otherwise(F.col("widest"))).groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("rate", F.struct("used.low", "used.high")))).alias("cuts")
    )


def judge_quality(counted: DataFrame) -> DataFrame:
    """``counted`` with base_failed, failed_rates and kept.

    ``base_failed``: fewer than MIN_WORDS words, or over REPEAT_PERCENT percent of them in repeated
    windows.  ``failed_rates`` names the rates outside the thresholds of the document's language
    and source; ``kept`` is false if either holds anything against it.
    """
    sketch = materialize(sketches(counted), "sketches")
    cuts = materialize(thresholds(sketch), "thresholds").withColumnRenamed("lang", "l").withColumnRenamed("source", "s")
    joined = counted.join(cuts, counted.lang.eqNullSafe(F.col("l")) & counted.source.eqNullSafe(F.col("s")), "left")
    outside = [
        F.when((value > F.col("cuts")[name]["high"]) | (value < F.coalesce(F.col("cuts")[name]["low"], F.lit(-1.0))), F.lit(name))
        for name, value in rates().items()
    ]
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    judged = joined.withColumn("base_failed", base).withColumn("failed_rates", F.array_compact(F.array(*outside)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rates") == 0)).drop("l", "s", "cuts")


def quality_rules(documents: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, failed_rates and kept of every row of ``documents``.

    Needs doc_id, text, lang and source; other columns are not read.  Null and empty texts have no
    words and fail the base; null languages and sources are groups of their own; a null doc_id
    keeps its row; repeated rows are counted and judged one by one; an empty table gives no rows.
    Texts are counted whole, a few megabytes at a time.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), "text",
    )
    return judge_quality(materialize(count_documents(docs, ["doc_id", "lang", "source"]), "counts"))
