"""Folds over telemetry: newest status of each table, totals, failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_status(events: DataFrame, keys: list[str], status: str, order: list[str]) -> DataFrame:
    """The status that came last for each key."""
    return events.groupBy(*keys).agg(F.max_by(status, F.struct(*order)).alias("last_status"), F.count("*").alias("events"))


def totals(statuses: DataFrame, status: str = "status", rows: str = "rows") -> DataFrame:
    count = lambda s: F.count_if(F.col(status) == s)
    return statuses.agg(count("success").alias("completed"), count("running").alias("running"), count("failed").alias("failed"), F.coalesce(F.sum(rows), F.lit(0)).alias("rows"))


def failure_summary(events: DataFrame, by: list[str], at: str, table: str) -> DataFrame:
    """One row for each kind of failure: how often, when first, on which tables."""
    return events.groupBy(*by).agg(F.count("*").alias("failures"), F.min(at).alias("first_seen"), F.array_join(F.sort_array(F.collect_set(F.col(table).cast("string"))), ",").alias("tables"))


def progress_lines(events: DataFrame) -> DataFrame:
    """Table status from ingest events: newest mode and status, rows, finished slices, guardrail actions."""
    e = F.col("event")
    status = F.when(e == "ingest.table.start", "running").when(e == "ingest.table.success", "success").when(e == "ingest.table.failure", "failed")
    marked = events.where(F.col("schema").isNotNull() & F.col("table").isNotNull()).withColumn("_status", status)
    newest = lambda c, when: F.max_by(F.when(when, F.col(c)), F.when(when, F.col("ts")))
    return marked.groupBy("schema", "table").agg(
        newest("mode", F.col("mode").isNotNull()).alias("mode"), F.coalesce(newest("_status", F.col("_status").isNotNull()), F.lit("pending")).alias("status"),
        newest("rows", e == "ingest.table.success").alias("rows"), F.count_if((e == "ingest.slice.progress") & (F.col("state") == "completed")).alias("slices_done"),
        F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(F.when(e == "guardrail.precision", F.struct("ts", "state"))), False), 1, 2), lambda s: s["state"]), ",").alias("guardrail"),
        newest("message", e == "ingest.table.failure").alias("last_error"),
    )
