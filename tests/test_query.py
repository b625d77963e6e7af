import pytest
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.layer import Layer, as_layer, find_geometry
from groundsheet.operators import describe, guard
from groundsheet.operators.query import query_data


@pytest.fixture()
def schools(spark):
    rows = [(i, f"school {i}", float(i * 100), 46.7 + i * 0.001, 24.6) for i in range(20)] + [(99, None, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, title string, capacity double, lon double, lat double")
    return Layer("schools", df.withColumn("geom", G.point("lon", "lat")), "geom", box=("lon", "lat", "lon", "lat"))


def ids(result):
    return [r.id for r in result.records.collect()]


def test_paging_order_and_nulls_last(schools):
    up = query_data(schools, order_by_fields="capacity", page_size=3, record_offset=18)
    assert ids(up) == [18, 19, 99]
    down = query_data(schools, order_by_fields="capacity DESC, id asc", page_size=2)
    assert ids(down) == [19, 18] and down.total.first()[0] == 21
    assert query_data(schools).records.columns == ["id", "title", "capacity", "lon", "lat"]


def test_buffer_in_metres(schools):
    # a hundredth of a degree of longitude is about 1,012 m at this latitude
    at = {"x": 46.7, "y": 24.6}
    near = query_data(schools, geometry=at, buffer_distance=500, buffer_units="esriSRUnit_Meter", order_by_fields="id")
    assert ids(near) == [0, 1, 2, 3, 4]
    assert ids(query_data(schools, geometry=at, buffer_distance=1, buffer_units="km", order_by_fields="id"))[-1] == 9
    assert ids(query_data(schools, geometry=at, buffer_distance=0.0025, order_by_fields="id")) == [0, 1, 2]


def test_filters_that_cannot_apply_are_errors(schools):
    with pytest.raises(ValueError):
        query_data(schools, geometry={"foo": 1})
    with pytest.raises(ValueError):
        query_data(Layer("flat", schools.df.drop("geom")), geometry={"x": 1, "y": 1})
    with pytest.raises(ValueError):
        query_data(schools, statistics=[("median", "capacity")])
    for bad in ({"out_fields": "id, (select 1)"}, {"order_by_fields": "id; drop"}, {"where": "1=1; drop table t"}):
        with pytest.raises(guard.Refused):
            query_data(schools, **bad)


def test_unknown_relation_means_intersects(schools):
    with pytest.warns(UserWarning):
        found = query_data(schools, geometry={"xmin": 46.7, "ymin": 24, "xmax": 46.7015, "ymax": 25}, spatial_rel="near")
    assert sorted(ids(found)) == [0, 1]


def test_statistics_honour_order_and_synonyms(schools):
    out = query_data(
        schools, where="capacity is not null", statistics=[("Mean", "capacity"), ("std", "capacity"), ("count", "id")],
        group_by="title", order_by_fields="mean_capacity DESC",
    ).records
    assert out.columns == ["title", "mean_capacity", "std_capacity", "count_id"]
    assert out.first().mean_capacity == 1900


def test_geometry_next_to_chosen_fields(schools):
    row = query_data(schools, out_fields="id", order_by_fields="id", page_size=1, return_geometry=True).records.first()
    assert row.asDict() == {"id": 0, "geometry": '{"type":"Point","coordinates":[46.7,24.6]}'}


def test_box_columns_reach_the_scan(spark, schools, tmp_path):
    path = str(tmp_path / "schools")
    schools.df.write.parquet(path)
    stored = Layer("s", spark.read.parquet(path), "geom", box=("lon", "lat", "lon", "lat"))
    found = query_data(stored, geometry={"xmin": 46.7, "ymin": 24, "xmax": 46.7025, "ymax": 25}, out_fields="id", page_size=None)
    plan = found.records._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(lon,46.7025)" in plan and "title" not in plan.split("ReadSchema")[1]
    assert sorted(ids(found)) == [0, 1, 2]


def test_describe(schools):
    rows = {r.name: r for r in describe.describe_layer(schools).collect()}
    assert rows["title"].fieldValueType == "nameOrTitle" and rows["lon"].fieldValueType == "countOrAmount"
    assert rows["capacity"].fieldValueType == "nameOrTitle"  # the rule looks for "city" anywhere in a name
    assert rows["geom"].isGeometry and rows["geom"].sampleValues == []
    assert rows["id"].sampleValues == ["0", "1", "2"]


@pytest.mark.parametrize(
    "name, kind, hint",
    [
        ("built", "timestamp_ntz", "dateAndTime"), ("city_date", "date", "dateAndTime"), ("CityCode", "int", "nameOrTitle"),
        ("pop", "decimal(10,2)", "countOrAmount"), ("OBJECTID", "esriFieldTypeOID", "countOrAmount"), ("span", "interval", "countOrAmount"),
        ("kind", "string", "text"),
    ],
)
def test_value_hints(name, kind, hint):
    assert describe.field_value_type(name, kind) == hint


def test_geometry_column_is_found_by_name_then_by_content(spark):
    df = spark.createDataFrame([(b"\x01\x02\x03", b"x")], "blob binary, other binary")
    assert find_geometry(df) is None
    shaped = df.withColumn("shape", G.point(F.lit(1), F.lit(2)))
    assert find_geometry(shaped) == "shape"
    assert as_layer(shaped.withColumn("Geometry", F.col("shape"))).geom == "Geometry"
