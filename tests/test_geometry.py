import pytest
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.functions import project, sqlnames
from groundsheet.operators import columns, process

WKT = [
    "POINT (1 2)",
    "LINESTRING (0 0, 1 1.5)",
    "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 0.5, 2 0.5, 2 1, 1 0.5))",
    "MULTIPOINT ((1 2), (3 4))",
    "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))",
    "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, -1 0.00001))",
    "POLYGON EMPTY",
]


@pytest.fixture()
def shapes(spark):
    df = spark.createDataFrame([(w,) for w in WKT] + [(None,)], "wkt string")
    return df.withColumn("geom", G.from_wkt("wkt"))


def test_text_round_trips(shapes):
    back = G.as_wkt(G.from_geojson(G.as_geojson("geom")))
    for r in shapes.select("wkt", G.as_wkt("geom").alias("a"), back.alias("b")).collect():
        if r.wkt and "0.00001" in r.wkt:
            assert r.a == r.b
        else:
            assert r.wkt == r.a == r.b


def test_geojson_with_spaces_heights_and_numbers(spark):
    docs = [
        ('{"type":"Point","coordinates":[ 1.5 , -2e1, 7 ]}', "POINT (1.5 -20)"),
        ('{"type": "LineString", "coordinates": [[0, 0, 1], [1, 1, 2]]}', "LINESTRING (0 0, 1 1)"),
        ('{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}', "MULTIPOINT ((1 2), (3 4))"),
    ]
    df = spark.createDataFrame(docs, "doc string, want string")
    for r in df.select("want", G.as_wkt(G.from_geojson("doc")).alias("got")).collect():
        assert r.got == r.want


def test_measures_by_dimension(shapes):
    rows = {r.wkt: r for r in process.measure_layer(shapes).collect()}
    poly = rows[WKT[2]]
    assert poly.area == pytest.approx(8 - 0.25) and poly.length == 0 and poly.perimeter > 13
    line = rows[WKT[1]]
    assert line.length == pytest.approx((1 + 1.5**2) ** 0.5) and line.perimeter == 0 and line.area == 0
    assert rows[None].area is None


def test_bad_text(spark):
    df = spark.createDataFrame([("POINT (1 2)",), ("POINT (a b)",), ("hello",)], "w string")
    kept = columns.decode_geometry(df, "w", "wkt", on_error="null")
    assert kept.where("geom is null").count() == 2
    with pytest.raises(Exception):
        columns.decode_geometry(df, "w", "wkt").select(G.area("geom")).collect()


def test_accessors_bounds_flip_repair(spark):
    df = spark.createDataFrame([("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))",)], "w string").withColumn("geom", G.from_wkt("w"))
    fixed = process.repair_layer(df).select("was_fixed", G.area("geom").alias("a")).first()
    assert fixed.was_fixed and fixed.a == pytest.approx(2.0)
    row = columns.bounds_columns(df).first()
    assert (row.xmin, row.ymin, row.xmax, row.ymax) == (0, 0, 2, 2)
    line = spark.createDataFrame([("LINESTRING (1 2, 3 4)",)], "w string").withColumn("geom", G.from_wkt("w"))
    acc = columns.geometry_accessors(process.flip_layer(line)).first()
    assert (acc.geom_type, acc.n_points, acc.start_x, acc.end_y, acc.x) == ("LINESTRING", 2, 2.0, 3.0, None)


def test_simplify_keeps_a_subset_and_hull_covers(spark):
    wkt = "LINESTRING (0 0, 1 0.1, 2 -0.1, 3 5, 4 6, 5 7, 6 8.1)"
    df = spark.createDataFrame([(wkt,)], "w string").withColumn("geom", G.from_wkt("w"))
    thin = process.simplify_layer(df, 0.5).select(G.as_wkt("geom").alias("w")).first().w
    kept = {p.strip() for p in thin[thin.index("(") + 1 : -1].split(",")}
    assert kept < {p.strip() for p in wkt[wkt.index("(") + 1 : -1].split(",")}
    hull = process.hulls(df.withColumn("line", F.col("geom")))
    assert hull.select(G.predicate("covers", "geom", "line").alias("c")).first().c


def test_buffer_area_is_near_the_circle(spark):
    df = spark.range(1).select(G.point(F.lit(500000.0), F.lit(4000000.0)).alias("geom"))
    area = process.buffer_layer(df, 50_000).select(G.area("geom").alias("a")).first().a
    assert area == pytest.approx(3.141592653589793 * 50_000**2, rel=0.01)


# Published UTM coordinates: (lon, lat, code, easting, northing)
@pytest.mark.parametrize(
    "lon, lat, code, east, north",
    [
        (-79.387139, 43.642567, 32617, 630084.30, 4833438.55),  # CN Tower
        (151.215297, -33.856784, 32756, 334897.0, 6252270.0),  # Sydney, to about a metre
        (9.0, 0.0, 32632, 500000.0, 0.0),
    ],
)
def test_utm(spark, lon, lat, code, east, north):
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    out = process.reproject_points(df, 4326, code, "lon", "lat", ("x", "y"))
    row = process.reproject_points(out, code, 4326, "x", "y", ("lon2", "lat2")).first()
    assert abs(row.x - east) < (60 if code == 32756 else 0.5) and abs(row.y - north) < (60 if code == 32756 else 0.5)
    assert (row.lon2, row.lat2) == (pytest.approx(lon, abs=1e-9), pytest.approx(lat, abs=1e-9))


@pytest.mark.parametrize("code", [3857, 6933, 32632])
def test_projection_of_any_kind_closes(spark, code):
    shapes = [w.replace("POINT (1 2)", "POINT (9.1 48.2)") for w in WKT]
    df = spark.createDataFrame([(w,) for w in shapes], "wkt string").withColumn("geom", G.from_wkt("wkt"))
    there = process.reproject_layer(df, 4326, code)
    back = process.reproject_layer(there, code, 4326)
    close = F.coalesce(G.distance("geom", G.from_wkt("wkt")), F.lit(0.0))
    for r in back.select("wkt", G.kind("geom").alias("k"), G.vertex_count("geom").alias("n"), close.alias("d"),
                         G.kind(G.from_wkt("wkt")).alias("k0"), G.vertex_count(G.from_wkt("wkt")).alias("n0")).collect():
        assert (r.k, r.n) == (r.k0, r.n0) and r.d < 1e-7


def test_equal_area_keeps_areas(spark):
    """A cell between two meridians and two parallels has a known area on the ellipsoid."""
    df = spark.range(1).select(G.envelope(F.lit(0), F.lit(0), F.lit(360), F.lit(90)).alias("geom"))
    area = process.reproject_layer(df, 4326, 6933).select(G.area("geom").alias("a")).first().a
    assert 2 * area == pytest.approx(5.10065622e14, rel=1e-6)


def test_unknown_codes_are_refused():
    with pytest.raises(ValueError):
        project.stages(4326, 2154)
    assert project.utm_code(46.7, 24.6) == 32638 and project.utm_code(-70, -33) == 32719


SHAPES = [
    "POINT (2 3)", "POINT (6 6)", "LINESTRING (2 3, 6 6, 6 1)", "LINESTRING (0 3, 9 3)", "MULTIPOINT ((2 3), (7 7))",
    "POLYGON ((0 0, 6 0, 6 6, 0 6, 0 0))", "POLYGON ((6 0, 9 0, 9 6, 6 6, 6 0))", "MULTILINESTRING ((0 0, 1 1), (5 5, 8 5))",
    "POLYGON ((-4 -4, 10 -4, 10 10, -4 10, -4 -4), (1 1, 3 1, 3 2, 1 2, 1 1))",
    "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((5 5, 8 5, 8 8, 5 8, 5 5)))",
]


def test_sql_names_are_the_columns(spark):
    """Every kind of geometry, in select lists, conditions, subqueries and groups, without a Python worker."""
    df = spark.createDataFrame([(w,) for w in SHAPES], "w string").select("w", G.from_wkt("w").alias("g"))
    df.createOrReplaceTempView("shapes")
    pairs = sqlnames.query(
        spark,
        """select a.w as a, b.w as b, ST_Distance(a.g, b.g) as d, ST_DWithin(a.g, b.g, 1.5) as n, ST_Intersects(a.g, b.g) as i,
             st_contains(a.g, b.g) as c, ST_Covers(a.g, b.g) as v, ST_Area(ST_Intersection(a.g, b.g)) as o
           from shapes a cross join shapes b where not ST_Disjoint(ST_Envelope(a.g), ST_Buffer(b.g, 100))""",
    )
    a, b = F.col("a.g"), F.col("b.g")
    plain = df.alias("a").crossJoin(df.alias("b")).select(
        F.col("a.w").alias("a"), F.col("b.w").alias("b"), G.distance(a, b).alias("d"), G.within_distance(a, b, 1.5).alias("n"),
        G.predicate("intersects", a, b).alias("i"), G.predicate("contains", a, b).alias("c"), G.predicate("covers", a, b).alias("v"),
        G.area(G.intersection(a, b)).alias("o"),
    )
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, plain.collect()))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    "sql, want",
    [
        ("select ST_X(ST_Point(cast(null as double), 1)) as x, ST_Y(ST_Point(3, 1)) as y, ST_X(g) as z from shapes where w like 'LINE%(2%'", [(None, 1.0, None)]),
        ("with b as (select ST_Buffer(ST_Point(id, 0), 1) g from range(3)) select ST_AsText(ST_Envelope(ST_Union_Agg(g))) as u from b", [("POLYGON ((-1 -1, -1 1, 3 1, 3 -1, -1 -1))",)]),
        ("select count(*) as n from shapes s where exists (select 1 from shapes t where t.w <> s.w and ST_Touches(s.g, t.g))", None),
        ("select ST_AsText(ST_Transform(ST_Point(10, 50), 'EPSG:4326', 'EPSG:3857')) as t", [("POINT (1113194.9079327357 6446275.841017158)",)]),
        ("select ST_NPoints(g) as n, sum(ST_Area(g)) as a from shapes where w like 'MULTIPOLY%' group by ST_NPoints(g)", [(10, 13.0)]),
    ],
)
def test_sql_names_anywhere(spark, sql, want):
    df = spark.createDataFrame([(w,) for w in SHAPES], "w string").select("w", G.from_wkt("w").alias("g"))
    df.createOrReplaceTempView("shapes")
    rows = [tuple(r) for r in sqlnames.query(spark, sql).collect()]
    assert rows == want if want is not None else rows[0][0] > 0


@pytest.mark.parametrize("sql", ["select ST_X()", "select ST_Transform(ST_Point(0, 0), concat('EPSG:', id), 'EPSG:3857') from range(2)"])
def test_sql_names_used_wrongly(spark, sql):
    with pytest.raises(ValueError):
        sqlnames.query(spark, sql)
