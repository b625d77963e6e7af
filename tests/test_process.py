import random

import pytest
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.operators import process

BOX = ("x0", "y0", "x1", "y1")
SCHEMA = "id long, k string, x0 double, y0 double, x1 double, y1 double"


def boxes(spark, n, seed, spread=40.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.choice([(5.0, 5.0), (rng.uniform(0, spread), rng.uniform(0, spread))])
        rows.append((i, rng.choice("ab"), x, y, x + rng.uniform(0.5, 6), y + rng.uniform(0.5, 6)))
    return spark.createDataFrame(rows, SCHEMA).withColumn("geom", G.envelope(*BOX))


def total(df, expr="sum(a)"):
    return df.withColumn("a", G.area("geom")).selectExpr(f"{expr} as t").first().t or 0.0


@pytest.mark.parametrize("cap", [3, 11])
def test_tiled_union_equals_plain_union(spark, cap):
    df = boxes(spark, 150, 1)
    copies = df.union(df).union(df)
    plain = {r.k: r.a for r in process.dissolve(df, ["k"]).select("k", G.area("geom").alias("a")).collect()}
    tiled = {r.k: r.a for r in process.dissolve(copies, ["k"], cap=cap).select("k", G.area("geom").alias("a")).collect()}
    assert tiled == {k: pytest.approx(v) for k, v in plain.items()}


def test_tiled_union_splits_one_crowded_spot(spark, monkeypatch):
    monkeypatch.setattr(process, "TILE_STEPS", 2)
    df = spark.range(200).select(
        "id", F.lit("a").alias("k"), G.envelope(-F.col("id") - 1.0, F.lit(-1.0), F.col("id") + 1.0, F.lit(1.0)).alias("geom")
    )
    out = process.dissolve(df, ["k"], cap=4)
    assert out.count() == 1 and total(out) == pytest.approx(2 * 400)


def test_hulls_in_steps(spark):
    df = boxes(spark, 80, 2)
    one = process.hulls(df, ["k"]).select("k", G.area("geom").alias("a"))
    many = process.hulls(df, ["k"], cap=5).select("k", G.area("geom").alias("a"))
    assert {r.k: round(r.a, 6) for r in one.collect()} == {r.k: round(r.a, 6) for r in many.collect()}


def test_collections_keep_every_member(spark):
    df = boxes(spark, 60, 3)
    crowd = df.union(df.where("id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2500)))).drop("n"))
    whole = process.collect_layer(crowd, ["k"])
    assert whole.count() == 2 and whole.agg(F.sum("members")).first()[0] == 2560
    parts = process.collect_layer(crowd, ["k"], part_by=F.pmod(F.monotonically_increasing_id(), F.lit(4)))
    assert parts.agg(F.sum("members")).first()[0] == 2560 and parts.count() > 2
    assert total(parts) == pytest.approx(total(crowd))


def test_long_lines_come_in_connected_parts(spark):
    rng = random.Random(4)
    rows = [("a" if i % 3 else "b", i, rng.random(), rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "track string, seq int, lon double, lat double")
    whole = process.make_lines(df, ["track"], ["seq"])
    cut = process.make_lines(df, ["track"], ["seq"], part_by=F.floor(F.col("seq") / 60))
    lengths = lambda d: {r.track: r.l for r in d.groupBy("track").agg(F.sum(G.length("geom")).alias("l")).collect()}
    assert whole.count() == 2 and cut.count() == 14 and {r.vertices for r in whole.collect()} == {266, 134}
    assert lengths(cut) == {k: pytest.approx(v) for k, v in lengths(whole).items()}


def test_areas_add_up(spark):
    """a = (a and b) + (a minus b), and the three parts of a union cover the union."""
    a = boxes(spark, 25, 5, 30)
    b = process.dissolve(boxes(spark, 25, 6, 30), ["k"]).where("k = 'a'").withColumn("id", F.lit(1))
    cut = total(process.clip_layer(a, b))
    rest = total(process.erase(a, b, "id"))
    assert cut + rest == pytest.approx(total(a))
    flat_a = process.dissolve(a.withColumn("k", F.lit("x")), ["k"]).withColumn("id", F.lit(7))
    pieces = process.overlay_union(flat_a, b.select("id", "geom"), "id", "id")
    both = flat_a.select("geom").union(b.select("geom")).withColumn("k", F.lit(1))
    assert total(pieces) == pytest.approx(total(process.dissolve(both, ["k"])))
    assert pieces.where("id is null").count() == 1 and pieces.where("b_id is null").count() == 1


def test_erase_by_touching_shapes(spark):
    """A cover of polygons, lines and points (shapes that only touch) takes just the area."""
    a = spark.range(1).select("id", G.envelope(*map(F.lit, (0, 0, 4, 4))).alias("geom"))
    masks = [
        "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))", "POLYGON ((4 4, 5 4, 5 5, 4 5, 4 4))", "POLYGON ((2 2, 6 2, 6 6, 2 6, 2 2))",
        "POLYGON ((-3 1, 0 1, 0 2, 1 2, 1 3, -3 3, -3 1))",
    ]
    b = spark.createDataFrame([(w,) for w in masks], "w string").select(G.from_wkt("w").alias("geom"))
    assert total(process.erase(a, b, "id")) == pytest.approx(16 - 4 - 1)
    covered = spark.range(1).select(G.envelope(*map(F.lit, (-1, -1, 5, 5))).alias("geom"))
    assert process.erase(a, covered, "id").count() == 0


def test_buffer_and_select_in_a_metric_zone(spark):
    """Schools 500 m buffered, kept where they meet a district, handed out in degrees."""
    schools = spark.createDataFrame([(1, 46.700, 24.60), (2, 46.800, 24.60)], "id int, lon double, lat double").select(
        "id", G.point("lon", "lat").alias("geom")
    )
    # the district's edge lies about 400 m east of school 1
    district = spark.range(1).select("id", G.envelope(F.lit(46.704), F.lit(24.5), F.lit(46.75), F.lit(24.7)).alias("geom"))
    got = process.buffer_and_select(schools, 500, district, metric=32638).select("id", "b_id", "geojson").collect()
    assert [(r.id, r.b_id) for r in got] == [(1, 0)]
    assert got[0].geojson.startswith('{"type":"Polygon","coordinates":[[[46.70')
    assert process.buffer_and_select(schools, 300, district, metric=32638).count() == 0


def test_extent_and_bins(spark):
    df = boxes(spark, 30, 8)
    plain = df.agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first()
    assert tuple(process.layer_extent(df).first()) == pytest.approx(tuple(plain))
    spots = spark.createDataFrame([(0.9, 0.9), (1.1, -0.9), (-0.9, 0.2)], "lon double, lat double")
    near = {(r.cell_x, r.cell_y): r.n for r in process.grid_bin(spots, 2.0, [F.count("*").alias("n")], snap="floor").collect()}
    assert near == {(0, 0): 1, (0, -2): 1, (-2, 0): 1}
