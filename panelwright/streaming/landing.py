"""Incremental ingest: only files that arrived since the last run are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_new_files(
    spark: SparkSession, folder: str, schema: T.StructType, state: str, handle: Callable[[DataFrame, int], None]
) -> None:
    """Hands the rows of new CSV files to ``handle(rows, batch_id)`` and returns when none are left.

    ``state`` is a folder on shared storage; a batch that failed is handed over
    again with the same id, so ``handle`` writes to a place named after the id.
    """
    query = (
        spark.readStream.schema(schema)
        .option("header", True)
        .csv(folder)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_batches(target: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to its own folder, so that a replay overwrites itself."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write
