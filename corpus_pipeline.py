"""From raw documents to sampled token ids: five stages, each a training-data operator applied to whole tables.

Every stage takes the documents that the one before it kept, carries each row's columns in one
struct (so no column name can clash) and, but for the last, returns the columns of documents.
Null texts count as empty; empty tables pass through; the docstrings of the operators state the rest.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.llm import language_id, mixing, pieces, quality_rules, simhash
from groundsheet.llm.texts import small_batches
from groundsheet.operators.lineage import materialize


def _packed(docs: DataFrame, *also: str) -> DataFrame:
    """Each row as the struct ``doc``, beside the columns that an operator reads."""
    small_batches(docs.sparkSession)
    kinds = {"doc_id": "long"}
    return docs.select(F.struct("*").alias("doc"), *(F.col(c).cast(kinds.get(c, "string")).alias(c) for c in also))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some margin; null texts and texts without a letter go."""
    rows = _packed(docs, "doc_id", "lang", "text")
    usable = ~language_id.held_out(F.col("doc_id"))
    dictionaries = language_id.learn_dictionaries(rows, usable)
    told = language_id.identify(rows, dictionaries, ["doc"], language_id.learn_margin(rows, usable, dictionaries))
    return told.where(~F.col("rejected")).select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's and source's thresholds."""
    counted = quality_rules.count_documents(_packed(docs, "lang", "source", "text"), ["doc", "lang", "source"])
    judged = quality_rules.judge_quality(materialize(counted, "counted-documents"))
    return judged.where("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Of rows that share this doc_id the first by order stays.  Rows with a null doc_id have no
    place in that order and stay.
    """
    small_batches(spark)
    groups = materialize(simhash.simhash_groups(docs), "groups")
    kept = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = materialize(kept.withColumnRenamed("doc_id", "kept_id"), "kept")
    rows = _packed(docs, "doc_id")
    single = kept.where("rows = 1")
    found = rows.where("doc_id is not null").join(single, F.col("doc_id") == F.col("kept_id"), "left_semi")
    found = found.union(rows.where("doc_id is null")).select("doc")
    repeated = kept.where("rows > 1")
    if not repeated.isEmpty():
        first = rows.join(repeated, F.col("doc_id") == F.col("kept_id")).groupBy("kept_id").agg(F.min("doc").alias("doc"))
        found = found.union(first.select("doc"))
    return found.select("doc.*")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: words taken over size, the rest decided by a hash of the id."""
    taken = mixing.mix(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    chance = F.pmod(F.xxhash64("doc_id", "source"), F.lit(1_000_003)) / 1_000_003
    times = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + chance).cast("int")
    wanted = taken.where("taken > 0").select(F.col("doc_id").alias("i"), F.col("source").alias("s"), times.alias("times"))
    rows = _packed(docs, "doc_id", "source")
    joined = rows.join(wanted.where("times > 0"), F.col("doc_id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")))
    return joined.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("doc.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document."""
    small_batches(spark)
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("quality_rules", quality),
    ("simhash_dedup", near_duplicates),
    ("mix_sources", mixed_sources),
    ("sample_pieces", encoded),
]

#: Compression and sampling have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
