"""The pipeline's stages on odd rows, against brute force, and as a whole."""

import re
import zlib

import corpus_pipeline
import pytest
from conftest_llm import ENGLISH, SCHEMA, SF, odd_rows
from groundsheet.llm import language_id, mixing, pieces, quality_rules

FILTERS = dict(corpus_pipeline.STAGES[:4])


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_stages_are_the_five():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_dedup", "mix_sources", "sample_pieces"]


@pytest.mark.parametrize("name", list(FILTERS))
def test_columns_stay_and_empty_tables_pass(spark, clashing, none, name):
    out = FILTERS[name](spark, clashing, SF)
    assert out.columns == clashing.columns
    assert {str(tuple(r)[:2]) for r in out.collect()} <= {str(r[:2]) for r in odd_rows()}
    assert FILTERS[name](spark, none, SF).collect() == []


def test_language_stage(spark, odd):
    """What goes is what the operator rejects; every row of a text with a clear language stays."""
    rejected = {(r.doc_id) for r in language_id.language_id(odd).collect() if r.rejected}
    got = rows(FILTERS["language_id"](spark, odd, SF))
    assert got == sorted((r for r in odd_rows() if r[0] is not None and r[0] not in rejected or r[1] and r[0] is None), key=str)
    assert sum(r[0] == 2 for r in got) == 2


def test_quality_stage(spark, odd):
    kept = [r.doc_id for r in quality_rules.quality_rules(odd).collect() if r.kept]
    assert sorted(map(str, kept)) == sorted(str(r[0]) for r in rows(FILTERS["quality_rules"](spark, odd, SF)))


def test_dedup_stage(spark):
    """Exact and near copies leave one, the smallest id; different texts and texts half alike stay."""
    words = [f"{a}{b}" for a in ("river", "stone", "grain", "cloud") for b in range(120)]
    base = " ".join(words)
    near = " ".join(words[:200] + ["changed"] + words[201:])
    half = " ".join(words[:240] + [f"new{k}" for k in range(240)])
    data = [(5, base), (3, base), (9, near), (9, near), (4, base.upper()), (11, half), (12, ENGLISH), (None, base), (20, None), (21, ""), (3, base)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in data], SCHEMA)
    got = rows(FILTERS["simhash_dedup"](spark, frame, SF))
    assert sorted((r[0] for r in got), key=str) == [11, 12, 20, 3, None] and [r[1] for r in got if r[0] == 3] == [base]


def test_mixing_stage(spark):
    """Copies follow the words taken, and each source comes near its target."""
    data = [(k, " ".join([f"w{k}"] * (20 + k % 30)), "en", "abc"[k % 3] if k % 10 else "a", 1) for k in range(900)]
    frame = spark.createDataFrame(data, SCHEMA)
    taken = {r.doc_id: r for r in mixing.mix(frame).collect()}
    copies = {}
    for r in rows(FILTERS["mix_sources"](spark, frame, SF)):
        copies[r[0]] = copies.get(r[0], 0) + 1
    for k, r in taken.items():
        assert r.taken // r.size <= copies.get(k, 0) <= -(-r.taken // r.size)
    words = {}
    for k, n in copies.items():
        words[taken[k].source] = words.get(taken[k].source, 0) + n * taken[k].size
    for source, n in words.items():
        target = next(r.target for r in taken.values() if r.source == source)
        assert abs(n - target) < 0.08 * target


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = out.collect()
    assert out.columns == ["doc_id", "n_ids", "ids", "lossless"] and len(got) > 50 and all(r.lossless for r in got)
    import numpy as np
    import public_tokenizers

    lattice = pieces.lattice(public_tokenizers.path("piece_bpe_32k.model"))
    for r in got:
        assert lattice.decode(np.array(r.ids)) == texts[r.doc_id]
        assert len(re.findall(r"\S+", texts[r.doc_id])) >= quality_rules.MIN_WORDS
    assert len({zlib.crc32(texts[r.doc_id].lower().encode()) for r in got}) == len({r.doc_id for r in got})
