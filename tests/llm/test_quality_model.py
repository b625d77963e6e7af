"""Factorisation machine: the identity, the fit, held-out quality, odd rows."""

import itertools
import zlib

import numpy as np
from conftest_llm import SF, odd_rows
from groundsheet.llm import quality_model
from groundsheet.llm.queries import QUERIES


def test_sum_of_squares_identity():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(6, 9)) * (draw.random((6, 9)) < 0.6)
    model = {"b": np.array([0.3]), "w": draw.normal(size=9), "v": draw.normal(size=(9, 4))}
    plain = [
        0.3 + r @ model["w"] + sum(r[i] * r[j] * (model["v"][i] @ model["v"][j]) for i, j in itertools.combinations(range(9), 2))
        for r in x
    ]
    assert np.allclose(quality_model.margin(x, model), plain)


def test_fit_learns_an_interaction():
    """Exclusive or: no linear model tells these apart."""
    draw = np.random.default_rng(2)
    x = (draw.random((600, 6)) < 0.5).astype(np.float32)
    y = (x[:, 0] != x[:, 1]).astype(float)
    model = quality_model.fit(x, y)
    assert ((quality_model.margin(x, model) > 0) == (y > 0)).mean() > 0.95
    assert all(np.array_equal(a, b) for a, b in zip(model.values(), quality_model.fit(x, y).values(), strict=True))


def test_odd_rows_and_empty(spark, clashing, none):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (2, 0), (4, 0), (6, None), (None, 1), (12, 0), (99, 1)], "doc_id long, quality int"
    )
    rows = quality_model.quality_scores(clashing, labels).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert quality_model.quality_scores(none, labels).collect() == []
    assert len(quality_model.quality_scores(clashing, labels.limit(0)).collect()) == len(rows)


def test_held_out_quality(spark):
    sf = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op10_quality_model"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = [r.score for r in held if truth[r.doc_id] == 1]
    bad = [r.score for r in held if truth[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93


def test_slices_bound_rows():
    """Many short texts are cut by rows, as each becomes a dense row."""
    import pyarrow as pa
    from groundsheet.llm.texts import slices

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2500)), "text": ["two words"] * 2500})
    cut = list(slices([batch], rows=quality_model.SLICE_ROWS))
    assert [len(c) for c in cut] == [1000, 1000, 500] and pa.Table.from_batches(cut).column("doc_id").to_pylist() == list(range(2500))
