import random

import pytest
from pyspark.sql import functions as F

from groundsheet.operators import lineage, registry, scenes
from groundsheet.streaming import layer_state

SCHEMA = "id string, seq long, op string, name string, value double"


def replay(rows):
    """The document edits, one after another."""
    doc = {}
    for id_, seq, op, name, value in sorted(rows, key=lambda r: r[1]):
        if op == "upsert":
            doc.pop(id_, None)
            doc[id_] = {"name": name, "value": value, "style": None, "position": seq}
        elif op == "remove":
            doc.pop(id_, None)
        elif id_ in doc:
            doc[id_]["style"] = name
    return doc


def changes(n, seed):
    rng = random.Random(seed)
    ids = ["hot"] * 5 + [f"l{i}" for i in range(10)]
    return [(rng.choice(ids), i, rng.choice(["upsert", "upsert", "style", "remove"]), f"n{i}", float(i)) for i in range(n)]


def as_doc(df):
    return {r.id: {k: r[k] for k in ("name", "value", "style", "position")} for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_folding_equals_replaying(spark, seed):
    rows = changes(120, seed)
    assert as_doc(registry.apply_layer_changes(spark.createDataFrame(rows, SCHEMA))) == replay(rows)


def test_upsert_replaces_moves_to_the_end_and_drops_the_style(spark):
    rows = [("a", 1, "upsert", "first", 1.0), ("b", 2, "upsert", "b", 2.0), ("a", 3, "style", "red", None), ("a", 4, "upsert", "second", 4.0),
            ("b", 5, "style", "blue", None), ("c", 6, "style", "x", None), ("c", 7, "remove", None, None)]
    out = registry.apply_layer_changes(spark.createDataFrame(rows, SCHEMA)).orderBy("position").collect()
    assert [(r.id, r.name, r.style) for r in out] == [("b", "b", "blue"), ("a", "second", None)]


def test_batches_in_any_order_and_twice(spark):
    rows = changes(90, 9)
    parts = [rows[60:], rows[:30], rows[30:60], rows[:30]]
    folds = [registry.fold_changes(spark.createDataFrame(p, SCHEMA)) for p in parts]
    merged = folds[0]
    for f in folds[1:]:
        merged = merged.union(f)
    assert as_doc(registry.present_layers(registry.merge_folded(merged))) == replay(rows)


def test_stream_restarts_and_compacts(spark, tmp_path):
    rows = changes(80, 11)
    source, state, marks = (str(tmp_path / n) for n in ("in", "state", "marks"))
    for part in (rows[:40], rows[40:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        layer_state.start(layer_state.read_changes(spark, source), state, marks).awaitTermination()
    assert as_doc(layer_state.current_state(spark, state)) == replay(rows)
    layer_state.compact(spark, state, str(tmp_path / "small"))
    assert as_doc(layer_state.current_state(spark, str(tmp_path / "small"))) == replay(rows)


DOCUMENT_SCHEMA = "id string, name string, value double, style string, position int"


@pytest.mark.parametrize("seed", range(2))
def test_changes_to_a_stored_document(spark, tmp_path, seed):
    """A document's layers are as if added, and styled, before all changes; in batch and in a stream."""
    rows = changes(60, seed)
    document = [("hot", "h", 1.0, "red", 0), ("l1", None, None, None, 1), ("l77", "kept", 7.0, "blue", 2), ("twice", "a", 1.0, None, 3), ("twice", "b", 2.0, None, 4)]
    before = [(d[0], registry.START + 2 * d[4], "upsert", d[1], d[2]) for d in document]
    before += [(d[0], registry.START + 2 * d[4] + 1, "style", d[3], None) for d in document if d[3]]
    want = replay(before + rows)
    stored = spark.createDataFrame(document, DOCUMENT_SCHEMA)
    assert as_doc(registry.apply_layer_changes(spark.createDataFrame(rows, SCHEMA), stored)) == want
    assert as_doc(registry.apply_layer_changes(spark.createDataFrame([], SCHEMA), stored)) == replay(before)
    source, state, marks = (str(tmp_path / n) for n in ("in", "state", "marks"))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(source)
    layer_state.start(layer_state.read_changes(spark, source), state, marks).awaitTermination()
    for _ in range(2):
        layer_state.begin(stored, state)
    assert as_doc(layer_state.current_state(spark, state)) == want


def test_resolve(spark):
    layers = spark.createDataFrame(
        [("roads", "https://h/0", "t1"), ("parcels", "s3://b/p.parquet", None), ("s3://b/p.parquet", "s3://b/q.parquet", "t2"), ("bare", None, "t3")],
        "id string, ref string, token string",
    )
    asked = spark.createDataFrame([("roads",), ("https://h/0",), ("s3://b/p.parquet",), ("bare",), ("other",)], "ref string")
    got = {r.ref: (r.reference, r.token) for r in registry.resolve_layer(layers, asked).collect()}
    assert got == {
        "roads": ("https://h/0", "t1"), "https://h/0": ("https://h/0", "t1"),
        "s3://b/p.parquet": ("s3://b/p.parquet", None), "bare": ("bare", None), "other": ("other", None),
    }


def test_sources_kinds_and_redaction(spark):
    rows = [("a.PARQUET",), ("x.geoparquet",), ("y.json",), ("z.GeoJSON",), ("f.gpkg",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "p string").select(registry.classify_source("p")).collect()]
    assert got == ["geoparquet", "geoparquet", "geojson", "geojson", "file", "app", "app"]
    df = spark.createDataFrame([("a", "secret"), ("b", None)], "id string, token string")
    assert [r.token for r in registry.redact(df).collect()] == ["<redacted>", None]
    nested = registry.redact(df.select("id", F.struct("token").alias("source")), "source.token")
    assert [r[0] for r in nested.select("source.token").collect()] == ["<redacted>", None]


def test_diff_is_null_safe(spark):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "y")], "id string, n int, s string")
    new = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("d", 4, "z")], "id string, n int, s string")
    assert {r.id: r.change for r in registry.layer_diff(old, new).collect()} == {"b": "changed", "c": "removed", "d": "added"}


def test_inventory_fallbacks(spark):
    reported = spark.createDataFrame([("a", None, None), ("b", "B", "/d/b.parquet"), ("z", None, None)], "id string, name string, path string")
    known = spark.createDataFrame([("a", "known a", "arcgis", "https://h/1"), ("k", "K", "geoparquet", "p")], "id string, name string, type string, ref string")
    rows = {r.id: tuple(r)[1:] for r in registry.layer_inventory(reported, known).collect()}
    assert rows == {"a": ("known a", "arcgis", "https://h/1"), "b": ("B", "geoparquet", "/d/b.parquet"), "z": ("z", "app", None)}
    assert registry.layer_inventory(reported, known, live=True).count() == 4


def test_index_of_dark_pixels_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (0.1, 0.3, 0.2)], "red double, nir double, green double")
    rows = df.select(scenes.spectral_index("ndvi").alias("v"), scenes.spectral_index("ndwi").alias("w")).collect()
    assert rows[0].v is None and rows[1].v == pytest.approx(0.5) and rows[1].w == pytest.approx(-0.2)
    with pytest.raises(ValueError):
        scenes.spectral_index("evi")


def test_shared_folder_follows_the_session(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        master, applicationId = "spark://cluster:7077", "app-1"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        lineage.shared_folder(Session())
    Session.conf[lineage.SETTING] = "hdfs://shared/steps/"
    assert lineage.shared_folder(Session()) == "hdfs://shared/steps"
    assert lineage.scratch_path(Session(), "x").startswith("hdfs://shared/steps/x-")


def test_materialized_steps_are_read_back(spark):
    kept = lineage.materialize(spark.range(5), "five")
    assert kept.count() == 5 and "five-" in kept.inputFiles()[0]
    assert not spark.range(3).transform(lineage.spread).isEmpty()
    assert lineage.spread(spark.range(0, 9, numPartitions=1)).rdd.getNumPartitions() == 8
