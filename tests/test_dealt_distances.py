from pyspark.sql import functions as F

from groundsheet.operators import dealing, intervals, sphere


def test_bands_and_spots_of_one_bucket_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(dealing, "PAIRS", 2000)
    bands = spark.range(200).select(F.col("id").alias("band"), F.lit(1.0).alias("lo"), F.lit(1.5).alias("hi"))
    spots = spark.range(150).select(F.col("id").alias("spot"), F.lit(1.2).alias("v"))
    got = intervals.range_join(bands, spots, "lo", "hi", "v").select("band", "spot", F.spark_partition_id().alias("task")).collect()
    assert len({(r.band, r.spot) for r in got}) == len(got) == 200 * 150 and len({r.task for r in got}) > 4


def test_points_of_one_cube_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(dealing, "PAIRS", 2000)
    spots = spark.createDataFrame([(i, i / 1e5, 5.0) for i in range(150)], "id long, lon double, lat double")
    got = sphere.distance_join_metres(spots, spots, 1000).select("id", "b_id", F.spark_partition_id().alias("task")).collect()
    assert len({(r.id, r.b_id) for r in got}) == len(got) == 150 * 150 and len({r.task for r in got}) > 4
