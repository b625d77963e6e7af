import hashlib
import random
import re

import pytest
from conftest_llm import SCHEMA
from pyspark.sql import functions as F

from groundsheet.llm import chunk_recipes


def plain(rows):
    """doc_id, keep_id, group_size, kept and digest of every row, by a dictionary of normalised texts."""
    groups = {}
    for n, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append((doc_id is None, doc_id or 0, n, doc_id))
    found = []
    for text, members in groups.items():
        first = min(members)
        digest = hashlib.sha256(text.encode()).hexdigest()
        found += [(m[3], first[3], len(members), m == first, digest) for m in members]
    return sorted(found, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("bits", [chunk_recipes.HASH_BITS, 3])
def test_odd_rows_against_a_dictionary(odd, bits):
    """Three bits make nearly all chunks share a hash with others: they must be told apart."""
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(chunk_recipes.exact_groups(odd, bits)) == plain(rows)


def test_clashing_columns_and_empty_tables(clashing, odd, none):
    assert result(chunk_recipes.exact_groups(clashing)) == result(chunk_recipes.exact_groups(odd))
    assert chunk_recipes.exact_groups(none).count() == 0


def test_white_space_and_long_texts(spark):
    draw = random.Random(7)
    long = " ".join(draw.choice(["river", "grain", "mill", "ßtone"]) + str(draw.randrange(1000)) for _ in range(60_000))
    texts = [long, long.replace(" ", "\n\t"), " " + long, long + " ", long[:-1] + "x", "a b", "a  b", " a b", "", None, " ", "\n\n", " ", "a" * 50_000, "a" * 50_001]
    rows = list(enumerate(texts, 1))
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], SCHEMA)
    assert result(chunk_recipes.exact_groups(docs.repartition(3))) == plain(rows)


def test_whole_table_against_a_dictionary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(chunk_recipes.exact_groups(docs)) == plain(rows)


def test_chunks_follow_content():
    """Cuts depend on the bytes around them: a text put behind another shares its chunks but the first few."""
    draw = random.Random(1)
    text = bytes(draw.randrange(97, 123) for _ in range(100_000))

    def chunks(data):
        ends = chunk_recipes.cuts(data)
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    assert b"".join(chunks(text)) == text
    sizes = [len(c) for c in chunks(text)]
    assert max(sizes) <= chunk_recipes.LONGEST and min(sizes[:-1]) >= chunk_recipes.SHORTEST and 600 < sum(sizes) / len(sizes) < 2500
    assert len(set(chunks(text)) - set(chunks(b"another beginning" * 20 + text))) <= 4


def test_one_large_group_of_copies(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same  text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text")
    )
    found = chunk_recipes.exact_groups(docs).groupBy("kept").agg(F.count("*"), F.max("group_size")).collect()
    assert {tuple(r) for r in found} == {(True, 20_001, 10_000), (False, 9_999, 10_000)}
