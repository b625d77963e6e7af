import random

import pytest
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.operators import joins

BOX = ("x0", "y0", "x1", "y1")


def boxes(spark, n, seed, hot=0.35):
    """Boxes from point-like to continent size, a third of them crowded into one spot."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        crowded = rng.random() < hot
        x = 10 + rng.random() * 0.01 if crowded else rng.uniform(-180, 180)
        y = 20 + rng.random() * 0.01 if crowded else rng.uniform(-80, 80)
        w, h = rng.choice([0, 1e-3, 0.5, 4, 64]), rng.choice([1e-4, 0.25, 16, 90])
        rows.append((i, x, y, x + w, y + h))
    rows.append((n, None, None, None, None))
    return spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double")


def nested_loop(a, b, grow=0.0):
    on = (
        (F.col("a.x0") <= F.col("b.x1") + grow) & (F.col("a.x1") >= F.col("b.x0") - grow)
        & (F.col("a.y0") <= F.col("b.y1") + grow) & (F.col("a.y1") >= F.col("b.y0") - grow)
    )
    rows = a.alias("a").crossJoin(b.alias("b")).where(on).select("a.id", "b.id").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("hot_rows", [joins.HOT_ROWS, 7])
@pytest.mark.parametrize("grow", [0.0, 3.0])
def test_cells_find_what_the_nested_loop_finds(spark, hot_rows, grow):
    a, b = boxes(spark, 220, 1), boxes(spark, 180, 2)
    got = joins.box_pairs(a, b, BOX, BOX, grow=grow, hot_rows=hot_rows)
    rows = got.select(joins.of("a", "id"), joins.of("b", "id").alias("o")).collect()
    assert sorted(tuple(r) for r in rows) == nested_loop(a, b, grow)


def test_points_in_boxes_on_borders(spark):
    points = spark.createDataFrame([(0, 0.0, 0.0), (1, 4.0, 4.0), (2, 4.0, 0.5), (3, -1e-9, 0.0)], "id int, lon double, lat double")
    tiles = spark.createDataFrame([(i, 4.0 * i, 0.0, 4.0 * i + 4, 4.0) for i in range(2)], "id int, x0 double, y0 double, x1 double, y1 double")
    shaped = tiles.withColumn("geom", G.envelope(*BOX))
    want = [(0, 0), (1, 0), (1, 1), (2, 0), (2, 1)]
    for polygons, geom in ((tiles, None), (shaped, "geom")):
        got = joins.point_in_polygon(points, polygons, geom=geom, box=BOX).select("id", "b_id").collect()
        assert sorted(tuple(r) for r in got) == want


def test_empty_sides(spark):
    a = boxes(spark, 5, 3)
    none = a.where("false")
    assert joins.box_pairs(a, none, BOX, BOX).count() == 0
    assert joins.box_pairs(none, a, BOX, BOX).count() == 0


def places(spark, n, seed, same=0.34):
    """Points of which a third share one location and a third form a dense cluster."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        u = rng.random()
        if u < same:
            x, y = 30.0, 30.0
        elif u < 0.67:
            x, y = 30 + rng.random() * 1e-3, 30 + rng.random() * 1e-3
        else:
            x, y = rng.uniform(-180, 180), rng.uniform(-80, 80)
        rows.append((i, x, y))
    return spark.createDataFrame(rows, "id long, lon double, lat double")


def brute_nearest(a, b, k):
    out = []
    for i, x, y in a:
        ranked = sorted(((x - u) * (x - u) + (y - v) * (y - v), j) for j, u, v in b)[:k]
        out += [(i, j, r + 1) for r, (_, j) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 4])
@pytest.mark.parametrize("leaf", [16, 2])
def test_nearest_is_exact(spark, monkeypatch, k, leaf):
    monkeypatch.setattr(joins, "LEAF_ROWS", leaf)
    monkeypatch.setattr(joins, "FAN", 4)
    a, b = places(spark, 60, 4), places(spark, 300, 5)
    got = joins.nearest(a, b, k).select("id", "b_id", "rank").collect()
    want = brute_nearest([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()], k)
    assert sorted(tuple(r) for r in got) == want


def test_nearest_with_few_or_no_rows(spark):
    a, b = places(spark, 5, 6), places(spark, 2, 7)
    assert joins.nearest(a, b, 10).count() == 10
    assert joins.nearest(a, b.where("false"), 3).count() == 0


def shapes(spark, n, seed):
    """Points, lines and polygons of all sizes, some of them copies, some without a place."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y, size = rng.uniform(-50, 50), rng.uniform(-50, 50), 10 ** rng.uniform(-2, 1.5)
        kind = rng.randrange(5)
        if kind == 0:
            text = f"POINT ({x} {y})"
        elif kind == 1:
            text = f"LINESTRING ({x} {y}, {x + size} {y - size / 2}, {x} {y + size})"
        elif kind == 2:
            text = f"POLYGON (({x} {y}, {x + size} {y}, {x} {y + size}, {x} {y}))"
        elif kind == 3:
            text = "LINESTRING (1 1, 2 3)"
        else:
            text = None if i % 2 else "POLYGON EMPTY"
        rows.append((i, text))
    return spark.createDataFrame(rows, "id long, w string").select("id", G.from_wkt("w").alias("geom"))


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_shapes_against_all_pairs(spark, monkeypatch, k):
    monkeypatch.setattr(joins, "FAN", 4)
    monkeypatch.setattr(joins, "LEAF_ROWS", 4)
    a, b = shapes(spark, 60, 1), shapes(spark, 150, 2)
    got = joins.nearest(a, b, k, a_xy=None, b_xy=None).select("id", "b_id", "distance", "rank").collect()
    placed = b.where(~G.is_empty("geom")).toDF("b_id", "b_geom")  # an empty shape is nowhere, its distance would read 0
    pairs = a.crossJoin(placed).select("id", "b_id", G.distance("geom", "b_geom").alias("distance"))
    pairs = pairs.where("distance is not null").collect()
    want = []
    for i in {p.id for p in pairs}:
        ranked = sorted((p.distance, p.b_id) for p in pairs if p.id == i)[:k]
        want += [(i, j, d, r + 1) for r, (d, j) in enumerate(ranked)]
    want = [w for w in want if w[0] in {r.id for r in a.where(~G.is_empty("geom")).collect()}]
    got = [tuple(r) for r in got]
    assert sorted(got) == sorted(want) and len(got) >= 40 * k


def test_nearest_of_points_to_lines(spark):
    lines = shapes(spark, 80, 3)
    spots = places(spark, 40, 4)
    got = joins.nearest(spots, lines, 2, b_xy=None).collect()
    plain = spots.crossJoin(lines.toDF("b_id", "b_geom")).select("id", "b_id", G.distance(G.point("lon", "lat"), F.col("b_geom")).alias("d"))
    best = {}
    for r in plain.where("d is not null").orderBy("d", "b_id").collect():
        best.setdefault(r.id, []).append(r.b_id)
    known = {r.id for r in lines.where(~G.is_empty("geom")).collect()}
    assert {(r.id, r.b_id) for r in got} == {(i, j) for i, found in best.items() for j in [j for j in found if j in known][:2]}


def test_a_stray_coordinate_costs_no_candidates(spark):
    """One place at 1e12 used to put all others into one cell; so many pairs would then be compared."""
    crowd = spark.range(20_000).select("id", (F.col("id") % 200 / 10).alias("lon"), F.floor(F.col("id") / 200).cast("double").alias("lat"))
    b = crowd.union(spark.createDataFrame([(99_999, 1e12, -1e12)], "id long, lon double, lat double"))
    a = crowd.where("id % 40 = 0")
    pairs = joins._met(a, b, 2, "id", "id", ("lon", "lat"), ("lon", "lat"), "", "")
    assert a.count() == 500 and pairs.count() < 500 * 40


def test_distance_join_of_lines(spark):
    lines = spark.createDataFrame([(1, "LINESTRING (0 0, 10 0)"), (2, "LINESTRING (0 9, 10 9)")], "id int, w string")
    spots = spark.createDataFrame([(1, 5.0, 3.0), (2, 20.0, 20.0)], "id int, lon double, lat double")
    got = joins.distance_join(lines.withColumn("geom", G.from_wkt("w")), spots, 3.0, b_xy=("lon", "lat")).collect()
    assert [(r.id, r.b_id, r.distance) for r in got] == [(1, 1, 3.0)]


def test_prefix_collision_is_refused(spark):
    a = boxes(spark, 3, 8).withColumn("b_id", F.lit(1)).withColumn("geom", G.envelope(*BOX))
    with pytest.raises(ValueError):
        joins.spatial_join(a, a, a_box=BOX, b_box=BOX)


def test_plan_is_an_equi_join(spark):
    a = boxes(spark, 50, 9)
    plan = joins.box_pairs(a, a, BOX, BOX)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
