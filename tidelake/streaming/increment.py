"""Keyed upserts of whatever files arrived since the last run, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelake.operators.lake import VersionedTable


def upsert_available(spark: SparkSession, source_dir: str, schema, table: VersionedTable, keys: list[str], order: list[str], checkpoint: str, timeout: int = 600) -> None:
    """Take all files that are there now, each once; a batch that is repeated after a failure changes nothing, as upserts are idempotent."""

    def take(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            table.merge(batch, keys, order, newer=order[0])

    query = spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("the increment took too long")
