import math
import random

import pytest
from pyspark.sql import functions as F

from groundsheet.functions import text
from groundsheet.operators import lineage, search

PAIRS = [
    ("الإسكندرية", "الاسكندريه"),
    ("مَكْتَبَــة", "مكتبه"),
    ("سنة ١٩٤٥", "سنه 1945"),
    ("\tBlue   Lagoon  at Noon ", "blue lagoon at noon"),
    ("ٱلمستشفى لؤلؤ سائق بناء آخر", "المستشفي لولو سايق بنا اخر"),
    ("Çà \n et LÀ", "çà et là"),
]


def test_normalize(spark):
    df = spark.createDataFrame(PAIRS, "a string, want string")
    for r in df.select("want", text.normalize("a").alias("got")).collect():
        assert r.got == r.want


def test_rules_and_persian_digits(spark):
    df = spark.createDataFrame([("۱۲",), ("abc",)], "a string")
    rows = df.select(
        text.normalize("a").alias("kept"),
        text.normalize("a", fold_persian=True).alias("folded"),
        text.applied_rules("a").alias("rules"),
    ).collect()
    assert (rows[0].kept, rows[0].folded) == ("۱۲", "12")
    assert rows[0].rules == ["lowercase", "arabic", "collapse_whitespace"]
    assert rows[1].rules == ["lowercase", "collapse_whitespace"]


def test_tokens_drop_the_article_of_long_words_only(spark):
    df = spark.createDataFrame([("الجبال البر a-b  c3",)], "t string")
    assert df.select(text.tokenize("t").alias("w")).first().w == ["جبال", "البر", "a", "b", "c3"]


def test_match(spark):
    df = spark.createDataFrame([(1, "الأندلسية"), (2, "x")], "id int, n string")
    assert [r.id for r in text.match_normalized(df, "n", "الاندلسيه").collect()] == [1]
    assert [r.id for r in text.match_normalized(df, "n", "اندلس", like=True).collect()] == [1]


@pytest.mark.parametrize(
    "docs, asked, first",
    [
        (["Lighthouses of the north coast", "Ferry lines", "Harbour cranes and ferry docks"], "lighthouses", 0),
        (["الحدائق في المدينة", "الجسور"], "حدائق", 0),
    ],
)
def test_ranking(spark, docs, asked, first):
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    index = search.bm25_index(rows, lineage.scratch_path(spark, "index"))
    queries = spark.createDataFrame([(1, asked), (2, "nothing here")], "query_id long, text string")
    hits = search.bm25_search(index, queries, 5).orderBy("query_id", "rank").collect()
    assert hits[0]["doc"] == first and {h["query_id"] for h in hits} == {1}


@pytest.mark.parametrize("limit", [search.QUERY_WORDS, 1])
def test_scores_against_the_formula(spark, monkeypatch, limit):
    """Also beyond the limit up to which query words are broadcast."""
    monkeypatch.setattr(search, "QUERY_WORDS", limit)

    docs = ["a b a c", "b b", "", "a d e f g"]
    index = search.bm25_index(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), lineage.scratch_path(spark, "index")
    )
    queries = spark.createDataFrame([(1, "a a b")], "query_id long, text string")
    got = {h["doc"]: h["score"] for h in search.bm25_search(index, queries, 10).collect()}
    split = [d.split() for d in docs]
    avgdl = max(1.0, sum(map(len, split)) / len(split))
    for i, words in enumerate(split):
        want = 0.0
        for q in ["a", "a", "b"]:
            f, df = words.count(q), sum(q in w for w in split)
            if f:
                idf = math.log((len(docs) - df + 0.5) / (df + 0.5) + 1)
                want += idf * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(words) / avgdl))
        assert got.get(i, 0.0) == pytest.approx(want)


def test_labels_fall_back_to_english(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    labels = spark.createDataFrame(
        [("a", "en", "A"), ("a", "ar", "ا"), ("b", "en", "B"), ("c", "fr", "C")], "key string, locale string, label string"
    )
    got = {r.key: r.label for r in text.translate_fallback(keys, labels, "ar").collect()}
    assert got == {"a": "ا", "b": "B", "c": None}
    assert text.is_supported_locale("ar") and not text.is_supported_locale("xx")
    assert len(text.LOCALES) == 16


def test_words_are_unicode(spark):
    row = spark.createDataFrame([("straße x² ½ Ⅷ",)], "t string").select(text.tokenize(F.lower("t")).alias("w")).first()
    assert row.w == ["straße", "x²", "½", "ⅷ"]


def _ranked(docs, asked, limit):
    """Top lists by the formula, in plain Python."""
    split = [(d or "").split() for d in docs]
    avgdl = max(1.0, sum(map(len, split)) / len(split))
    held = {}
    for i, words in enumerate(split):
        for w in set(words):
            held.setdefault(w, {})[i] = words.count(w)
    out = set()
    for q, text_ in asked:
        scores = {}
        for w in text_.split():
            df = len(held.get(w, {}))
            for i, f in held.get(w, {}).items():
                idf = math.log((len(docs) - df + 0.5) / (df + 0.5) + 1.0)
                scores[i] = scores.get(i, 0.0) + idf * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(split[i]) / avgdl))
        ranked = sorted((-round(s, 9), i) for i, s in scores.items() if s > 0)[:limit]
        out |= {(q, i, n, round(-s, 6)) for n, (s, i) in enumerate(ranked, 1)}
    return out


def test_top_lists_leave_out_documents_that_cannot_win(spark):
    """One word stands in every document; few documents come within reach of a top list."""
    draw = random.Random(3)
    docs = [" ".join(["all"] + [f"w{int(draw.paretovariate(0.7))}" for _ in range(draw.randrange(1, 30))]) for _ in range(6000)] + [None, ""]
    asked = [(q, " ".join(["all", "all", *(f"w{draw.randrange(1, 300)}" for _ in range(draw.randrange(1, 6)))])) for q in range(40)] + [(98, "all"), (99, "nothing")]
    index = search.bm25_index(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), lineage.scratch_path(spark, "index"))
    queries = spark.createDataFrame(asked, "query_id long, text string")
    hits = search.bm25_search(index, queries, 5).collect()
    assert {(h.query_id, h.doc, h.rank, round(h.score, 6)) for h in hits} == _ranked(docs, asked, 5)
    words = search.weighed_words(index, queries.where("query_id < 98"), "query_id", "text", None)
    sharing = words.select("query", "term").join(index.postings, "term").select("query", "doc").distinct().count()
    assert sharing == 40 * 6000 and search.contenders(index, search.judged_words(index, words, 5)).count() < sharing / 10
    parts = search._parts(index, words, 5)
    assert parts.count() < sharing / 10


def test_word_counts_of_a_row(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (None,), (["x"],)], "w array<string>")
    found = rows.select(search._counted(F.col("w")).alias("c")).collect()
    assert [None if r.c is None else [tuple(e) for e in r.c] for r in found] == [[("a", 1), ("b", 3)], None, None, [("x", 1)]]


def test_a_documents_postings_stay_together(spark, tmp_path):
    """One file has all words of a document: the index needs no shuffle, and a search sums where it reads."""
    docs = spark.range(400).repartition(4).selectExpr("id as doc_id", "concat_ws(' ', 'every', concat('w', id % 7), concat('v', id % 11)) as text")
    index = search.bm25_index(docs, str(tmp_path / "index"))
    files = index.postings.select("doc", F.input_file_name().alias("file")).groupBy("doc").agg(F.countDistinct("file").alias("n"), F.count("*").alias("words"))
    assert files.agg(F.max("n"), F.min("words"), F.count("*")).first()[:] == (1, 3, 400)
    assert index.postings.select(F.input_file_name()).distinct().count() == 4
