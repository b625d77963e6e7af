import json

import pytest

from groundsheet.functions import geometry as G
from groundsheet.operators import columns, query

# A hut with a courtyard, a forked path and some wells, on a metric grid; None where nothing is recognized.
HUT = [[10, 10], [10, 50], [60, 50], [60, 10], [10, 10]]
YARD = [[20, 20], [40, 20], [30, 35], [20, 20]]
CASES = [
    ({"rings": [HUT, YARD]}, "POLYGON ((10 10, 10 50, 60 50, 60 10, 10 10), (20 20, 40 20, 30 35, 20 20))"),
    ({"rings": [HUT], "hasZ": False}, "POLYGON ((10 10, 10 50, 60 50, 60 10, 10 10))"),
    ({"paths": [[[5, 7], [12, 7.5]], [[12, 7.5], [12, 30], [-4, 31]]]}, "MULTILINESTRING ((5 7, 12 7.5), (12 7.5, 12 30, -4 31))"),
    ({"paths": [[[5, 7], [12, 7.5], [20, 9]]]}, "LINESTRING (5 7, 12 7.5, 20 9)"),
    ({"paths": [[[3, 3]], [[5, 7], [12, 7.5]]]}, "LINESTRING (5 7, 12 7.5)"),
    ({"points": [[-8, 14], [33.25, -2], [0, 100]]}, "MULTIPOINT ((-8 14), (33.25 -2), (0 100))"),
    ({"points": [["north", 4], [6, 8], [11]]}, "MULTIPOINT ((6 8))"),
    ({"y": -33.5, "x": 151.25, "spatialReference": {"wkid": 4326}}, "POINT (151.25 -33.5)"),
    ({"ymax": 9, "xmax": 7, "ymin": 4, "xmin": -3}, "POLYGON ((-3 4, 7 4, 7 9, -3 9, -3 4))"),
    ({"xmin": -3, "ymin": 4, "xmax": 7, "ymax": 9, "x": 5, "y": 5}, "POLYGON ((-3 4, 7 4, 7 9, -3 9, -3 4))"),
    ({"y": 12}, None),
    ({"paths": []}, None),
    ({"points": []}, None),
    ({"curves": [[1, 2]]}, None),
    ({}, None),
]


def test_column_form(spark):
    rows = [(i, json.dumps(c)) for i, (c, _) in enumerate(CASES)]
    df = columns.decode_esri(spark.createDataFrame(rows, "i int, doc string"), "doc")
    got = {r.i: r.wkt for r in df.select("i", G.as_wkt("geom").alias("wkt")).collect()}
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]


def test_filter_geometry_uses_the_same_rule(spark):
    shape = query.filter_shape(spark, {"rings": [HUT, YARD]})
    assert shape.box == (10, 10, 60, 50)
    with pytest.raises(ValueError):
        query.filter_shape(spark, {"curves": []})


@pytest.mark.parametrize("multi, area", [(False, None), (True, 2.0)])
def test_second_shell(spark, multi, area):
    doc = {"rings": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]], [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]]}
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    row = columns.decode_esri(df, "doc", multi_shell=multi).select(
        G.area("geom").alias("a"), G.is_valid("geom").alias("ok")
    ).first()
    assert row.ok is multi
    if multi:
        assert row.a == area
