"""Ranked search: an index of stored tables and exact BM25 top lists.

The index is three tables, so it can be written once and searched many times: postings
``doc, term, tf, dl``, terms ``term, df, top`` and one row of totals.  ``top`` is the largest part of a
score that a word gives to any document, but for the word's weight.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from groundsheet.functions import text
from groundsheet.functions.geometry import let
from groundsheet.operators import lineage

QUERY_WORDS = 200_000
#: Postings of a query's rarest words that are scored first, as a multiple of the top list's length.
SEED = 20
#: Scores are compared to nine digits; bounds give way by more than that.
SLACK = 1e-6
K1, B = 1.5, 0.75  # usual BM25 parameters (fixed values)


@dataclass
class Index:
    postings: DataFrame
    terms: DataFrame
    totals: DataFrame

    @staticmethod
    def read(spark: SparkSession, path: str) -> Index:
        return Index(*[spark.read.parquet(f"{path}/{t}") for t in ("postings", "terms", "totals")])


def _words(df: DataFrame, key: str, body: str, locale: str | None) -> DataFrame:
    words = text.tokenize(text.normalize(body, locale))
    return df.select(F.col(key), words.alias("words")).withColumn("dl", F.coalesce(F.size("words"), F.lit(0)))


def _counted(words) -> Column:
    """Each different word with its count, from one sort of the row's words: runs of equal words."""

    def runs(listed: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(listed) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(listed, i) != F.get(listed, i - 1)))
        return let(starts, lambda found: F.transform(found, lambda at, n: F.struct(
            F.get(listed, at).alias("term"), (F.coalesce(F.get(found, n + 1), F.size(listed)) - at).alias("tf")
        )))

    return F.when(F.size(words) > 0, let(F.sort_array(words), runs))


def _exploded(words: DataFrame, *keys: str) -> DataFrame:
    """One row per word.  The outer form keeps Spark from testing the array's size below
    the split, which would split every text a second time."""
    return words.select(*keys, F.explode_outer("words").alias("term")).where(F.col("term").isNotNull())


def bm25_index(docs: DataFrame, path: str, doc: str = "doc_id", body: str = "text", locale: str | None = None) -> Index:
    """Build the index under ``path``.

    Texts are split and their words counted row by row; the postings stay where their documents
    are read, without a shuffle.
    """
    spark = docs.sparkSession
    split = text.tokenize(text.normalize(body, locale))
    # one expression from text to entries, and the outer form: else Spark splits every text again for the size of its words
    entries = let(split, lambda w: let(_counted(w), lambda found: F.transform(
        found, lambda e: F.struct(e["term"].alias("term"), e["tf"].alias("tf"), F.size(w).alias("dl"))
    )))
    words = docs.select(F.col(doc).alias("doc"), F.inline_outer(entries)).where(F.col("term").isNotNull())
    # A file holds all words of its documents, sorted: a search skips what has none of its words, and adds
    # up most of a document's score in the task that reads it.
    words.sortWithinPartitions("term", "doc").write.parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    n = docs.count()
    words_in_all = F.coalesce(F.sum("tf"), F.lit(0)).cast("double")
    totals = stored.agg(F.lit(n).cast("long").alias("n"), (words_in_all / max(n, 1)).alias("avgdl"))
    totals.write.parquet(f"{path}/totals")
    avgdl = _usual_length(spark.read.parquet(f"{path}/totals"))
    stored.groupBy("term").agg(F.count("*").alias("df"), F.max(_impact(avgdl)).alias("top")).write.parquet(f"{path}/terms")
    return Index.read(spark, path)


def _usual_length(totals: DataFrame) -> Column:
    return F.greatest(totals.select("avgdl").scalar(), F.lit(1.0))


def _impact(avgdl: Column) -> Column:
    return F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))


def weighed_words(index: Index, queries: DataFrame, query: str, body: str, locale: str | None) -> DataFrame:
    """query, term, weight, most (the largest part of a score it can give) and df of the queries' words that are indexed."""
    wanted = _words(queries, query, body, locale).transform(_exploded, query).groupBy(F.col(query).alias("query"), "term").agg(F.count("*").alias("times"))
    if lineage.fits(wanted, QUERY_WORDS):
        wanted = F.broadcast(wanted)
    n = index.totals.select("n").scalar()
    idf = F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
    found = index.terms.join(wanted, "term").select("query", "term", "df", (F.col("times") * idf).alias("weight"), "top")
    return lineage.materialize(found.withColumn("most", F.col("weight") * F.col("top")), "weighed")


def _sums(index: Index, words: DataFrame) -> DataFrame:
    """query, doc and the sum of the words' parts of its score."""
    if lineage.fits(words, QUERY_WORDS):
        words = F.broadcast(words)
    hits = index.postings.join(words.select("query", "term", "weight"), "term")
    return hits.groupBy("query", "doc").agg(F.sum(F.col("weight") * _impact(_usual_length(index.totals))).alias("part"))


def _scored(index: Index, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """query, doc and the sum of the words' parts of these pairs; all words of their documents are looked at."""
    held = index.postings.join(pairs.select("query", "doc"), "doc")
    told = held.join(words.select("query", "term", "weight"), ["query", "term"])
    return told.groupBy("query", "doc").agg(F.sum(F.col("weight") * _impact(_usual_length(index.totals))).alias("part"))


def _seed(words: DataFrame, limit: int) -> DataFrame:
    """A query's rarest words, as many as have SEED times ``limit`` postings."""
    rarest = W.partitionBy("query").orderBy("df", "term").rowsBetween(W.unboundedPreceding, -1)
    return words.withColumn("before", F.coalesce(F.sum("df").over(rarest), F.lit(0))).where(F.col("before") < SEED * limit)


def judged_words(index: Index, words: DataFrame, limit: int) -> DataFrame:
    """The words with ``floor``, a score that a query's last winner has at least, and ``idle``: they cannot reach it together.

    The documents that look best by a query's rarest words are scored whole: the last of
    ``limit`` winners has at least the least of these scores.
    """
    best = W.partitionBy("query").orderBy(F.col("part").desc(), "doc")
    first = _sums(index, _seed(words, limit)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    last = _scored(index, lineage.materialize(first, "first"), words).groupBy("query").agg(F.count("*").alias("n"), F.min("part").alias("floor"))
    last = last.where(F.col("n") >= limit).select("query", (F.col("floor") - SLACK).alias("floor"))
    weakest = W.partitionBy("query").orderBy("most", "term").rowsBetween(W.unboundedPreceding, W.currentRow)
    judged = words.join(last, "query", "left").withColumn("sum", F.sum("most").over(weakest))
    return lineage.materialize(judged.withColumn("idle", F.coalesce(F.col("sum") < F.col("floor"), F.lit(False))), "judged")


def contenders(index: Index, judged: DataFrame) -> DataFrame:
    """query, doc and part (of the score, without idle words) of all documents that can be among a query's winners.

    Idle words name no winner by themselves: only documents with another word are looked at,
    and of these only those whose part from the other words comes within reach of the floor.
    """
    reach = judged.groupBy("query").agg(F.max("floor").alias("floor"), F.sum(F.when(F.col("idle"), F.col("most")).otherwise(0.0)).alias("most"))
    sums = _sums(index, judged.where("not idle")).join(F.broadcast(reach) if lineage.fits(reach, QUERY_WORDS) else reach, "query")
    return sums.where(F.col("floor").isNull() | (F.col("part") + F.col("most") >= F.col("floor"))).select("query", "doc", "part")


def _parts(index: Index, words: DataFrame, limit: int) -> DataFrame:
    """query, doc and part, the whole score, of every document that can win, or of all that share a word.

    Looking at candidates' own words pays only where few candidates stand for many postings;
    posting counts tell this beforehand.  Both ways give the same winners.
    """
    each = index.postings.count() / max(1, index.totals.first().n)
    hits = F.coalesce(F.sum("df"), F.lit(0))
    asked, all_ = words.agg(F.countDistinct("query"), hits).first()
    if 2 * (_seed(words, limit).agg(hits).first()[0] + asked * limit * each) >= all_:
        return _sums(index, words)
    judged = judged_words(index, words, limit)
    saved = judged.where("idle").agg(hits).first()[0]
    if 2 * saved < all_:
        return _sums(index, words)
    near = lineage.materialize(contenders(index, judged), "contenders")
    if near.count() * each >= saved:
        return _sums(index, words)
    rest = _scored(index, near, judged.where("idle")).withColumnRenamed("part", "more")
    return near.join(rest, ["query", "doc"], "left").select("query", "doc", (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("part"))


def bm25_search(
    index: Index,
    queries: DataFrame,
    limit: int,
    query: str = "query_id",
    body: str = "text",
    locale: str | None = None,
) -> DataFrame:
    """Top ``limit`` documents of every query, scores above zero, ties by document; exact.

    A word repeated in a query counts again.  Documents that cannot reach a query's last
    winner are dropped before they are scored, where that saves postings.
    """
    words = weighed_words(index, queries, query, body, locale)
    scores = _parts(index, words, limit).select("query", "doc", F.col("part").alias("score"))
    # sums differ in their last digits with the order of addition; that must not rank copies
    best = W.partitionBy("query").orderBy(F.round("score", 9).desc(), "doc")
    ranked = scores.where(F.col("score") > 0).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= limit).withColumnRenamed("query", query)
