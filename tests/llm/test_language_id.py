"""Language identification: rules of the contract, held-out accuracy, odd rows."""

import re
import zlib

from conftest_llm import SF, odd_rows
from groundsheet.llm import language_id
from groundsheet.llm.queries import QUERIES


def is_held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_odd_rows(spark, clashing):
    rows = language_id.language_id(clashing).collect()
    texts = {}
    for r in odd_rows():
        texts.setdefault(r[0], []).append(r[1])
    learned = {r[2] for r in odd_rows() if r[2] and r[1] is not None and not is_held(r[0])}
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.held_out == is_held(r.doc_id) and 0 <= r.score <= 1
        bare = not any(re.search(r"[^\W\d_]", t or "") and any(c.isalpha() for c in t) for t in texts[r.doc_id])
        if bare:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id is not None:
            assert r.lang_pred in learned
    known = {r.doc_id: r.lang_pred for r in rows}
    assert known[1] == known[6 + 14] == "en" and known[7] == known[45] == "de"


def test_nothing_learned_and_empty(spark, odd, none):
    from pyspark.sql import functions as F

    rows = language_id.language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in rows} == {"und"}
    assert language_id.language_id(none).collect() == []


def test_margin_rejects():
    one = language_id.Classifier({"en": b"the river and the boats", "xx": b"the river and the boats"})
    assert one.judge(b"the river")[2] is True
    two = language_id.Classifier({"en": b"the river and the boats of the miller", "de": b"zweihundert schafe im nebel"})
    assert two.judge(b"and the boats of the miller") [0::2] == ("en", False)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op8_language_id"](spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 200 and sum(held) / len(held) > 0.96
    assert sum(r.rejected for r in rows) < 0.02 * len(rows)


def test_unlearned_languages_and_noise_are_rejected(spark):
    """Most texts of a language that was left out and of random letters go; texts of learned ones stay."""
    import random

    draw = random.Random(5)
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang", "text")
    left_out = docs.groupBy("lang").count().orderBy("count").first().lang
    noise = [(-k - 1, None, " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randrange(2, 10))) for _ in range(300))) for k in range(100)]
    rows = docs.selectExpr("doc_id", f"nullif(lang, '{left_out}') as lang", "text").union(spark.createDataFrame(noise, docs.schema))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rejected = {r.doc_id: r.rejected for r in language_id.language_id(rows).collect()}
    share = lambda some: sum(rejected[k] for k in some) / len(some)
    assert share([k for k, lang in truth.items() if lang == left_out]) > 0.9
    assert share([k for k in rejected if k < 0]) > 0.9
    assert share([k for k, lang in truth.items() if lang not in (None, left_out)]) < 0.02


def test_every_piece_counts(spark, monkeypatch):
    """Each drawn text has its share of a dictionary, whole characters only."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(language_id, "DICTIONARY_BYTES", 2000)
    docs = spark.createDataFrame([(k, "de", f"{chr(97 + k)}" + " grüße überall" * 30) for k in range(20)], "doc_id long, lang string, text string")
    learned = language_id.learn_dictionaries(docs, F.lit(True))["de"]
    assert 1800 < len(learned) <= 2000 and learned.decode().count("gr") >= 20 * 5
