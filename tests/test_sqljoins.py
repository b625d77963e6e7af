import math

import pytest
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.functions import sqlnames
from groundsheet.operators import sqljoins


@pytest.fixture(scope="module")
def views(spark):
    spots = spark.range(300).select(
        F.col("id"), ((F.col("id") * 37) % 101).cast("double").alias("px"), ((F.col("id") * 53) % 97).cast("double").alias("py"), (F.col("id") % 5).alias("kind")
    )
    spots = spots.select("*", F.when(F.col("id") % 50 != 7, G.point("px", "py")).alias("geom"))
    crowd = spark.range(500).select((F.col("id") + 1000).alias("id"), F.lit(50.5).alias("px"), F.lit(50.5).alias("py"), F.lit(9).alias("kind"), G.point(F.lit(50.5), F.lit(50.5)).alias("geom"))
    spots.union(crowd).createOrReplaceTempView("j_spots")
    boxes = spark.range(40).select(F.col("id"), (F.col("id") * 2.5).alias("x0"), (F.col("id") % 9 * 10.0).alias("y0"), (1 + F.col("id") % 4 * 20.0).alias("side"))
    boxes = boxes.select("*", G.envelope(F.col("x0"), F.col("y0"), F.col("x0") + F.col("side"), F.col("y0") + F.col("side")).alias("geom"), F.concat(F.lit("box "), F.col("id")).alias("name"))
    boxes.createOrReplaceTempView("j_boxes")


PLANNED = [
    "select s.id, b.id as box, b.name from j_spots s join j_boxes b on ST_Within(s.geom, b.geom) and s.kind < 4 where b.id > 3",
    "select s.id, b.id as box from j_spots s, j_boxes b where ST_DWithin(b.geom, s.geom, b.side / 10) and s.kind <> 2",
    "select a.id, b.id as other, a.kind from j_spots a join j_spots b on ST_Distance(a.geom, b.geom) <= 14 and a.id < b.id and a.kind = b.kind and a.id < 900",
    "with near as (select id, ST_Buffer(geom, 2) as zone from j_spots where kind = 1), big as (select * from j_boxes where side > 1)"
    " select n.id, g.name from near n join big g on ST_Intersects(n.zone, g.geom)",
    "select s.id, b.name from j_spots s left join j_boxes b on ST_Contains(b.geom, s.geom) and b.side > 30",
    "select s.* from j_spots s left semi join j_boxes b on ST_Contains(b.geom, s.geom)",
    "select s.id, s.kind from j_spots s left anti join j_boxes b on ST_Covers(b.geom, s.geom) and s.kind = b.id % 5",
    "select x.name, count(*) as n from (select * from j_spots where kind > 1) s join j_boxes x on ST_Touches(x.geom, s.geom) group by x.name having count(*) > 1",
    "select s.id, b.name, c.id as third from j_spots s join j_boxes b on ST_Within(s.geom, b.geom) join j_boxes c on ST_Overlaps(b.geom, c.geom) and c.id < 9 where s.kind = 3",
    "select * from j_spots s join j_boxes b on ST_Within(s.geom, b.geom) where s.id < 40",
]
LEFT_ALONE = [
    "select s.id, b.id as box from j_spots s join j_boxes b on ST_Within(s.geom, b.geom) or s.id = b.id",
    "select s.id, count(*) as n from j_spots s join j_boxes b on ST_Disjoint(s.geom, b.geom) group by s.id",
    "select id from j_boxes b where exists (select 1 from j_spots s where ST_Within(s.geom, b.geom))",
    "select s.id, b.id as box from j_spots s join j_boxes b on ST_DWithin(s.geom, b.geom, s.kind + b.id)",
]


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sql", PLANNED)
def test_same_rows_as_the_nested_loop_without_one(spark, views, sql):
    found, plainly = sqljoins.query(spark, sql), sqlnames.query(spark, sql)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert found.columns == plainly.columns
    assert rows(found) == rows(plainly) != []


@pytest.mark.parametrize("sql", LEFT_ALONE)
def test_other_conditions_stay_right(spark, views, sql):
    assert rows(sqljoins.query(spark, sql)) == rows(sqlnames.query(spark, sql)) != []


def test_a_crowded_place_is_dealt_over_salts(spark, views):
    sql = "select s.id, b.id as box from j_spots s join j_boxes b on ST_Within(s.geom, b.geom)"
    assert rows(sqljoins.query(spark, sql, hot_rows=50)) == rows(sqlnames.query(spark, sql))


def test_empty_sides_and_negative_distances(spark, views):
    assert rows(sqljoins.query(spark, "select s.id from j_spots s join j_boxes b on ST_DWithin(s.geom, b.geom, -1)")) == []
    assert rows(sqljoins.query(spark, "select s.id from (select * from j_spots where id < 0) s join j_boxes b on ST_Within(s.geom, b.geom)")) == []
    kept = sqljoins.query(spark, "select s.id, b.id as box from j_spots s left join (select * from j_boxes where id < 0) b on ST_Within(s.geom, b.geom)")
    assert kept.count() == 800 and kept.where("box is not null").count() == 0


BUFFERED = "(select id, ST_Buffer(geom, 5) as zone from j_centre)"


@pytest.mark.parametrize(
    "sql",
    [
        f"with n as {BUFFERED} select n.id, b.id as box from n join j_corners b on ST_Intersects(n.zone, b.geom)",
        f"with j_corner as {BUFFERED}, n as (select * from j_corner where id < 9), j_centre as (select 1 as id) "
        "select n.id, b.id as box from j_corners b, n where ST_Intersects(b.geom, n.zone) and n.id < 5",
        f"select n.id, b.id as box from (select s.zone, s.id from {BUFFERED} s) n join j_corners b on ST_Intersects(n.zone, b.geom)",
        f"select n.id, b.id as box from {BUFFERED} n left join j_corners b on ST_Intersects(n.zone, b.geom)",
        f"select n.id, b.id as box from j_corners b left join {BUFFERED} n on ST_Intersects(b.geom, n.zone) where n.id is not null",
        "select n.id, b.id as box from j_centre n join j_corners b on ST_Intersects(ST_Buffer(n.geom, 2), ST_Buffer(b.geom, 3))",
        "select n.id, b.id as box from j_centre n join j_corners b on n.id < b.id or ST_Intersects(ST_Buffer(n.geom, 5), b.geom)",
    ],
)
def test_a_buffer_reaches_as_far_as_its_radius(spark, sql):
    """Boxes whose corner lies between two corners of the buffer's polygon, 4.99 and 5.01 from its middle."""
    corner = F.lit(math.pi / 32)
    spark.range(1).select((F.col("id") + 4).alias("id"), G.point(F.lit(0.0), F.lit(0.0)).alias("geom")).createOrReplaceTempView("j_centre")
    far = spark.createDataFrame([(1, 4.99), (2, 5.01)], "id long, far double").select("id", (F.col("far") * F.cos(corner)).alias("x"), (F.col("far") * F.sin(corner)).alias("y"))
    far.select("id", G.envelope("x", "y", F.lit(9.0), F.lit(9.0)).alias("geom")).createOrReplaceTempView("j_corners")
    found = sqljoins.query(spark, sql)
    assert found.columns == ["id", "box"]
    assert [tuple(r) for r in found.collect()] == [(4, 1)]


def test_the_left_side_of_a_semi_join_keeps_its_columns(spark, views):
    sql = "select * from (select id, ST_Buffer(geom, 2) as zone from j_spots) s left semi join j_boxes b on ST_Intersects(s.zone, b.geom)"
    assert sqljoins.query(spark, sql).columns == ["id", "zone"]
    assert sqljoins.query(spark, "select * from (select id, ST_Buffer(geom, 2) as zone from j_spots) s join j_boxes b on ST_Intersects(s.zone, b.geom)").columns == [
        "id", "zone", "id", "x0", "y0", "side", "geom", "name"
    ]
