import json

import pytest
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.layer import Layer
from groundsheet.sources import files


@pytest.mark.parametrize(
    "ref, ok",
    [("data/schools.geoparquet", True), ("s3://bucket/x.parquet", True), ("X.GeoParquet", True), ("https://host/FeatureServer/0", False), ("roads.geojson", False)],
)
def test_references(ref, ok):
    assert files.is_parquet_reference(ref) is ok


def test_places(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.parquet").write_text("")
    (tmp_path / "out.parquet").write_text("")
    places = files.Places(local_root=str(tmp_path / "in"), url_prefix="s3://bucket/maps")
    assert places.resolve("a.parquet").endswith("in/a.parquet")
    assert places.resolve("s3://bucket/maps/x.parquet") == "s3://bucket/maps/x.parquet"
    for bad in ("../out.parquet", str(tmp_path / "out.parquet"), "s3://bucket/maps2/x.parquet", "s3://bucket/maps/../y.parquet"):
        with pytest.raises(PermissionError):
            places.resolve(bad)
    with pytest.raises(FileNotFoundError):
        places.resolve("none.parquet")
    for off in ("a.parquet", "https://host/a.parquet"):
        with pytest.raises(PermissionError):
            files.Places().resolve(off)


def test_service_pages_one_document_per_file(spark, tmp_path):
    pages = [
        {"geometryType": "esriGeometryPoint", "features": [{"attributes": {"OBJECTID": 1, "name": "a"}, "geometry": {"x": 1, "y": 2}},
                                                            {"attributes": {"OBJECTID": 2, "name": None}}]},
        {"features": [{"attributes": {"OBJECTID": 3, "name": "c"}, "geometry": {"rings": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]},
    ]
    for i, p in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(p, indent=1))
    layer = files.read_featureset(spark, str(tmp_path))
    rows = layer.df.select("OBJECTID", "name", G.as_wkt("geom").alias("w")).orderBy("OBJECTID").collect()
    assert [tuple(r) for r in rows] == [(1, "a", "POINT (1 2)"), (2, None, None), (3, "c", "POLYGON ((0 0, 1 0, 1 1, 0 0))")]


def test_geojson_collection_and_lines(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"n": 1, "t": "x \"q\""}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}},
        {"type": "Feature", "properties": {"n": 2, "t": None}, "geometry": None}]}
    (tmp_path / "c.geojson").write_text(json.dumps(doc, indent=2))
    layer = files.read_geojson(spark, str(tmp_path / "c.geojson"))
    want = [(1, 'x "q"', "LINESTRING (0 0, 1 1)"), (2, None, None)]
    show = lambda df: [tuple(r) for r in df.select("n", "t", G.as_wkt("geom")).orderBy("n").collect()]
    assert show(layer.df) == want
    files.write_geojson(layer.df, str(tmp_path / "lines"))
    for r in spark.read.text(str(tmp_path / "lines")).collect():
        assert json.loads(r[0])["type"] == "Feature"
    assert show(files.read_geojson(spark, str(tmp_path / "lines"), lines=True).df) == want
    files.write_geojson(layer.df.drop("geom"), str(tmp_path / "plain"), geom=None)
    assert json.loads(spark.read.text(str(tmp_path / "plain")).first()[0])["n"] in (1, 2)


def test_rewritten_layer_has_selective_boxes(spark, tmp_path):
    df = spark.range(1000).select("id", G.point(F.col("id") % 360 - 180.0, F.col("id") % 90 * 1.0).alias("geom"))
    files.write_layer(Layer("p", df, "geom"), str(tmp_path / "layer"), cells=8)
    back = spark.read.parquet(str(tmp_path / "layer"))
    assert back.count() == 1000 and set(back.columns) == {"id", "geom", "xmin", "ymin", "xmax", "ymax"}
    assert back.where("xmin <= -170 and xmax >= -180").count() == 33
