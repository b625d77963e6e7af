import time

from pyspark.sql import functions as F

from groundsheet.operators import lineage


def shuffled(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(k)) for k in range(blocks.size()) if str(blocks.apply(k)).startswith("shuffle_")}


def test_a_written_step_leaves_no_shuffle_behind(spark):
    before = shuffled(spark)
    asked = spark.conf.get(lineage.CLEANUP, None) if hasattr(lineage, "CLEANUP") else None
    step = lineage.materialize(spark.range(10_000).groupBy(F.col("id") % 100).count(), "shuffled")
    until = time.time() + 10
    while shuffled(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled(spark) - before
    assert step.count() == 100 and spark.conf.get(lineage.CLEANUP, None) == asked
