import pytest
from pyspark.sql import functions as F
from test_joins import BOX, boxes, nested_loop

from groundsheet.functions import geometry as G
from groundsheet.operators import dealing, joins


def test_few_bytes_with_many_pairs_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(dealing, "PAIRS", 500)
    a, b = boxes(spark, 220, 1), boxes(spark, 180, 2)
    got = joins.box_pairs(a, b, BOX, BOX).select(joins.of("a", "id"), joins.of("b", "id").alias("o"), F.spark_partition_id().alias("task")).collect()
    assert sorted((r[0], r[1]) for r in got) == nested_loop(a, b)
    assert len({r.task for r in got}) > 8


@pytest.mark.parametrize("swap", [False, True])
def test_one_key_is_spread_and_loses_nothing(spark, swap):
    one = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    two = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    got = dealing.join(*((two, one) if swap else (one, two)), ["k"], pairs=1000).select("a", "b", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.a, r.b) for r in got) == [(a, b) for a in range(300) for b in range(40)]
    assert len({r.task for r in got}) > 4


def shapes_of_all_kinds(spark):
    """Rectangles that share borders, corners and whole boxes, and shapes that fill their boxes only in part."""
    rows = []
    for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (1, 1), (4, 4), (0, 0)]):
        for size in (2, 1):
            rows.append(f"POLYGON (({x} {y}, {x + size} {y}, {x + size} {y + size}, {x} {y + size}, {x} {y}))")
        rows.append(f"POLYGON (({x} {y}, {x + 2} {y}, {x} {y + 2}, {x} {y}))")
        rows.append(f"LINESTRING ({x} {y}, {x + 2} {y + i % 3})")
    rows += ["POINT (2 2)", "POINT (1 1)", "POLYGON EMPTY"]
    return spark.createDataFrame(list(enumerate(rows)), "id int, w string").select("id", G.from_wkt("w").alias("geom"))


@pytest.mark.parametrize("predicate", sorted(G.PREDICATES))
def test_rectangles_by_numbers_and_other_shapes_agree_with_jts(spark, predicate):
    shapes = shapes_of_all_kinds(spark)
    got = joins.spatial_join(shapes, shapes, predicate).select("id", "b_id").collect()
    other = shapes.toDF("b_id", "b_geom")
    placed = shapes.where(~G.is_empty("geom")).crossJoin(other.where(~G.is_empty("b_geom")))
    want = placed.where(G.predicate(predicate, F.col("geom"), F.col("b_geom"))).select("id", "b_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_box_that_is_not_the_shape_own_is_not_believed(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0)], "id int, x0 double, y0 double, x1 double, y1 double").withColumn("geom", G.envelope(F.lit(0), F.lit(0), F.lit(1), F.lit(1)))
    b = spark.createDataFrame([(2, 5.0, 5.0, 6.0, 6.0)], "id int, x0 double, y0 double, x1 double, y1 double").withColumn("geom", G.envelope(*BOX))
    assert joins.spatial_join(a, b, a_box=BOX, b_box=BOX).count() == 0


def test_blocks_are_as_wide_as_high(spark):
    """Neither side of a crowded key is repeated for every block of its pairs."""
    one = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    two = spark.range(300).select(F.lit(1).alias("j"), F.col("id").alias("b"))
    left, right, left_keys, right_keys = dealing.dealt(one, two, ["k"], ["j"], ("_l", "_r"), 1000)
    assert left.count() + right.count() < 8000  # 27,300 with one side repeated for each of 90 blocks
    met = left.join(right, dealing.same(left_keys, right_keys))
    assert met.count() == met.select("a", "b").distinct().count() == 300 * 300
    per_block = met.groupBy(*left_keys).count().agg(F.max("count")).first()[0]
    assert per_block < 3000


def test_shapes_of_rectangles_are_not_joined_for_a_test_by_numbers(spark):
    """What a result does not ask for is not sent; what it asks for are the shapes as they were."""
    shapes = shapes_of_all_kinds(spark)
    met = joins.spatial_join(shapes, shapes, "overlaps")
    plan = met.select("id", "b_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "a__geom" not in plan and "_own_shape" not in plan
    own = {r.id: bytes(r.geom) for r in shapes.collect()}
    rows = met.collect()
    assert rows and all(bytes(r.geom) == own[r.id] and bytes(r.b_geom) == own[r.b_id] for r in rows)
