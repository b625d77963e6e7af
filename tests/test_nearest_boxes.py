import random

from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.operators import joins


def layers(spark):
    """Crowded rectangles of many sizes, with triangles and points between them."""
    rng = random.Random(11)
    rows = []
    for i in range(400):
        x, y, size = rng.randrange(40), rng.randrange(40), rng.choice([1, 4, 10])
        box = f"POLYGON (({x} {y}, {x + size} {y}, {x + size} {y + size}, {x} {y + size}, {x} {y}))"
        rows.append((i, [box, box, box, f"POLYGON (({x} {y}, {x + size} {y}, {x} {y + size}, {x} {y}))", f"POINT ({x} {y})"][i % 5]))
    shapes = spark.createDataFrame(rows, "id long, w string").select("id", G.from_wkt("w").alias("geom"))
    spots = spark.createDataFrame([(i, rng.uniform(-5, 50), rng.uniform(-5, 50)) for i in range(50)], "id long, lon double, lat double")
    return spots, shapes


def best(spots, shapes, k):
    pairs = spots.crossJoin(shapes.toDF("b_id", "b_geom")).select("id", "b_id", G.distance(G.point("lon", "lat"), F.col("b_geom")).alias("d")).collect()
    held = {}
    for d, b, a in sorted((p.d, p.b_id, p.id) for p in pairs):
        held.setdefault(a, []).append((b, d))
    return sorted((a, b, d, r + 1) for a, found in held.items() for r, (b, d) in enumerate(found[:k]))


def test_nearest_of_points_among_overlapping_rectangles(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 300)
    spots, shapes = layers(spark)
    got = joins.nearest(spots, shapes, 3, b_xy=None).select("id", "b_id", "distance", "rank").collect()
    assert sorted(map(tuple, got)) == best(spots, shapes, 3)


def test_rectangles_that_hold_a_point_are_not_all_candidates(spark, monkeypatch):
    """Three hundred rectangles around a point are equally near; its three first keys are all that is needed."""
    boxes = spark.range(300).select("id", G.envelope(-1 - F.col("id"), F.lit(-1), F.lit(1), 1 + F.col("id")).alias("geom"))
    kept = []
    within = joins._within_reach
    def watched(pairs, mine, order, *rest):
        out = within(pairs, mine, order, *rest)
        if order == "bk":
            kept.append(out.count())
        return out
    monkeypatch.setattr(joins, "_within_reach", watched)
    spot = spark.createDataFrame([(1, 0.0, 0.0)], "id long, lon double, lat double")
    assert [r.b_id for r in joins.nearest(spot, boxes, 3, b_xy=None).orderBy("rank").collect()] == [0, 1, 2]
    assert kept == [3]
