"""Layer state kept current from a stream of change rows.

Each micro-batch is folded to one row per layer and written under its batch number.
Folds combine by maxima, so the current state is a merge of the written folds: nothing
is rewritten per batch, a replayed batch overwrites its own folder with the same
content, and rows that arrive late or twice change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from groundsheet.operators import registry

CHANGE_SCHEMA = "id string, seq bigint, op string, name string, value double"


def read_changes(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CHANGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start(changes: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """Fold every available change into ``state``, then stop."""

    def write_fold(batch: DataFrame, number: int) -> None:
        folded = registry.fold_changes(batch)
        folded.write.mode("overwrite").parquet(f"{state}/batch={number}")

    return (
        changes.writeStream.foreachBatch(write_fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def begin(document: DataFrame, state: str) -> None:
    """Lay a stored document under a stream's folds; it may be laid again, before or after batches."""
    registry.fold_state(document).write.mode("overwrite").parquet(f"{state}/batch=-1")


def current_state(spark: SparkSession, state: str) -> DataFrame:
    folds = spark.read.schema(registry.FOLDED).parquet(state)
    return registry.present_layers(registry.merge_folded(folds))


def compact(spark: SparkSession, state: str, target: str) -> None:
    """Merge all folds into a fresh folder with one fold; removals are kept."""
    folds = spark.read.schema(registry.FOLDED).parquet(state)
    registry.merge_folded(folds).write.parquet(f"{target}/batch=0")
