"""Quality counts against plain counting, thresholds against exact quartiles."""

import re

import numpy as np
import pyarrow as pa
from conftest_llm import SF, odd_rows
from groundsheet.llm import quality_rules
from groundsheet.llm.queries import QUERIES


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    hit = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)} if len(grams) < 2000 else set()
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:k] for k, x in enumerate(lines)), len(hit),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts():
    texts = [r[1] or "" for r in odd_rows()] + ["a b c d e " * 3, "a b c d e f a b c d e", "x\n x\nx \nx\n\n\n", "\n", "a\rb\x0bc"]
    got = quality_rules.counts(pa.array(texts))
    for k, text in enumerate(texts):
        assert tuple(int(got[n][k]) for n in NAMES) == plain_counts(text), text[:60]


def test_odd_rows(spark, clashing):
    rows = quality_rules.quality_rules(clashing).collect()
    assert sorted((str(r.doc_id), *(r[n] for n in NAMES)) for r in rows) == sorted((str(x[0]), *plain_counts(x[1])) for x in odd_rows())
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.failed_rates)
    assert all(r.kept for r in rows if r.doc_id and 20 <= r.doc_id < 60)


def test_empty_table(spark, none):
    assert quality_rules.quality_rules(none).collect() == []


def test_sketch_quartiles(spark):
    """Fences from sketches are within the sketch's accuracy of fences from all values."""
    from pyspark.sql import functions as F

    frame = spark.range(5000).select(
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(100).alias("n_words"),
        (300 + F.pmod(F.xxhash64("id"), F.lit(500))).alias("word_chars"), F.pmod("id", F.lit(90)).alias("n_symbols"),
        F.lit(5).alias("n_upper"), F.lit(10).alias("n_lines"), F.lit(0).alias("n_dup_lines"), F.lit(0).alias("n_repeat_words"),
    ).repartition(7)
    rows = frame.collect()
    cuts = {r.rate: r for r in quality_rules.fences(quality_rules.sketches(frame), ["lang"]).collect()}
    for name, exact in (("symbol_rate", [r.n_symbols / 100 for r in rows]), ("mean_word", [r.word_chars / 100 for r in rows])):
        q1, q3 = np.quantile(exact, [0.25, 0.75])
        gap = max(q3 - q1, quality_rules.RATES[name][0]) * quality_rules.REACH
        assert abs(cuts[name].high - (q3 + gap)) <= 0.04 * (q3 + gap)
    assert cuts["dup_line_rate"].docs == 5000 and cuts["dup_line_rate"].low is None


def test_thresholds_follow_the_group(spark):
    """What is usual in one source fails in another."""
    rows = [(k, f"word{k} " * 1 + " ".join(f"| cell{k}x{j}" for j in range(20)), "en", "tables", 0) for k in range(150)]
    rows += [(1000 + k, " ".join(f"plain{k}y{j}" for j in range(40)), "en", "prose", 0) for k in range(150)]
    rows += [(5000, " ".join(f"| other{j}" for j in range(20)), "en", "prose", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(frame).collect()}
    assert not kept[5000] and sum(kept.values()) == 300


def test_whole_table(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op5_quality_rules"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.n_words < 1500:
            assert tuple(r[n] for n in NAMES) == plain_counts(rows[r.doc_id])
