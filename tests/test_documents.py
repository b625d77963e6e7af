import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsheet.functions import geometry as G
from groundsheet.sources import documents


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def features(n, seed=1):
    draw = random.Random(seed)
    odd = ['plain', 'with "quotes" and \\ back', "braces } { ] [", 'a "}" b', "ä😀\n", "", '"features":[{', "\\"]
    return [
        {
            "type": "Feature",
            "properties": {"id": k, "name": odd[k % len(odd)] * draw.randrange(1, 30), "more": {"list": [{"x": 1}, {"y": [2]}], "none": None}},
            "geometry": {"type": "Point", "coordinates": [k / 7, -k / 3]},
        }
        for k in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_collection_by_many_tasks(spark, tmp_path, small_ranges, indent):
    made = features(150)
    head = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "links": [{"type": "link", "href": "{"}]}
    text = json.dumps(head | {"features": made, "after": [{"type": "note"}]}, indent=indent, ensure_ascii=False)
    (tmp_path / "one.geojson").write_text(text)
    path = str(tmp_path / "one.geojson")
    assert documents._ranges(spark, path).rdd.getNumPartitions() >= 8
    found = [json.loads(r.text) for r in documents.array_members(spark, path).collect()]
    assert sorted((f for f in found if f.get("type") == "Feature"), key=lambda f: f["properties"]["id"]) == made
    fields = T.StructType().add("id", "long").add("name", "string")
    layer = documents.read_geojson_documents(spark, path, fields).df
    rows = sorted(layer.select("id", "name", G.x("geom").alias("x")).collect())
    assert [(r.id, r.name, round(r.x, 9)) for r in rows] == [(f["properties"]["id"], f["properties"]["name"], round(f["geometry"]["coordinates"][0], 9)) for f in made]
    assert documents.read_geojson_documents(spark, path).df.count() == 150


def test_member_longer_than_several_ranges_and_several_files(spark, tmp_path, small_ranges):
    long = {"type": "Feature", "properties": {"id": 1, "name": "{" * 5000}, "geometry": {"type": "LineString", "coordinates": [[k, {"z": k}["z"]] for k in range(900)]}}
    nested = {"type": "Feature", "properties": {"id": 2, "deep": [[{"a": [{"b": "}"}] * 200}]] * 3}, "geometry": None}
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"features": [long, nested]}) + "\n\n")
    (tmp_path / "c.json").write_text('{"features": []}')
    (tmp_path / "d.json").write_text('{"features": [{"type": "Feature", "properties": {"id": 9}}, {"type": "Feature", "prop')
    found = documents.array_members(spark, str(tmp_path)).collect()
    ids = sorted(json.loads(r.text)["properties"]["id"] for r in found)
    assert ids == [1, 1, 2, 2, 9]
    assert [json.loads(r.text) for r in found if '"deep"' in r.text] == [nested, nested]


def test_feature_service_document(spark, tmp_path, small_ranges):
    made = [{"attributes": {"id": k, "name": "n}" * k}, "geometry": {"x": k * 1.5, "y": -k}} for k in range(60)]
    fields = [{"name": n, "type": "t", "alias": n} for n in ("id", "name")]
    (tmp_path / "page.json").write_text(json.dumps({"geometryType": "esriGeometryPoint", "fields": fields, "features": made}, indent=1))
    df = documents.read_featureset_documents(spark, str(tmp_path), T.StructType().add("id", "long").add("name", "string")).df
    rows = df.select("id", "name", G.x("geom").alias("x"), G.y("geom").alias("y")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(k, "n}" * k, k * 1.5, -float(k)) for k in range(60)]
    assert df.where(F.col("geom").isNull()).count() == 0
