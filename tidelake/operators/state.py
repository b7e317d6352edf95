"""Load state: an append-only event log and watermarks, as parquet tables."""

from __future__ import annotations

import json
import time
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.sources.storage import Outbox, Storage

EVENTS = "sourceId string, schema_name string, table_name string, load_date date, mode string, phase string, status string, rows_written bigint, watermark string, location string, strategy string, error string, metadata_json string, event_at string, run_id string, event_seq bigint, event_id string, ts timestamp_ntz"
WATERMARKS = "sourceId string, schema_name string, table_name string, watermark string, last_loaded_date string, event_id string, updated_at timestamp_ntz"
KNOWN = ("rows_written", "watermark", "location", "strategy", "error")


def status_rank(status: Column) -> Column:
    return F.when(status == "success", 3).when(status == "failed", 2).when(status == "started", 1).otherwise(0)


def latest_progress(rows: DataFrame, keys: list[str], at: str = "updated_at") -> DataFrame:
    """The newest row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), F.xxhash64(*rows.columns).desc())
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def best_status(rows: DataFrame, keys: list[str], status: str = "status", at: str = "ts", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The highest status of each key (success, failed, started, anything else), the newest of equal ones; skipped rows don't count."""
    w = Window.partitionBy(*keys).orderBy(status_rank(F.col(status)).desc(), F.col(at).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in tiebreak))
    return rows.where(F.col(status) != "skipped").withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def progress_fallback(rows: DataFrame, keys: list[str], watermark: str = "watermark", loaded: str = "last_loaded_date") -> DataFrame:
    """Without a time of update: the greatest watermark of each key, and the load date that goes with it."""
    out = [F.max(watermark).alias(watermark), F.max_by(loaded, watermark).alias(loaded)]
    return rows.groupBy(*keys).agg(*out) if keys else rows.agg(*out)


def split_extra(extra: dict, known: tuple[str, ...] = KNOWN) -> dict:
    """Known keys as columns of their own, the rest as compact JSON in ``metadata_json``."""
    rest = {k: v for k, v in extra.items() if k not in known}
    return {k: extra[k] for k in known if k in extra} | ({"metadata_json": json.dumps(rest, sort_keys=True, separators=(",", ":"), default=str)} if rest else {})


def revived(row: dict) -> dict:
    """A row from the outbox's JSON, its date and times typed again."""
    typed = {"load_date": lambda v: datetime.fromisoformat(v).date(), "ts": datetime.fromisoformat, "updated_at": datetime.fromisoformat}
    return {k: typed[k](v) if k in typed and isinstance(v, str) else v for k, v in row.items()}


class StateStore:
    """Events and watermarks under one folder.  Rows carry an event id, and readers take each id once, so replays do no harm."""

    def __init__(self, spark: SparkSession, root: str, source_id: str, run_id: str | None = None, flush_every: int = 50, flush_seconds: float = 120, outbox: Outbox | None = None):
        """``outbox``: rows are put there before they wait for a flush, and those that a broken run left are written now."""
        self.spark, self.root, self.source_id = spark, root.rstrip("/"), source_id
        self.flush_seconds, self.flushed_at = flush_seconds, time.monotonic()
        self.run_id, self.flush_every, self.seq = run_id or uuid.uuid4().hex, flush_every, 0
        self.pending: dict[str, list[dict]] = {"events": [], "watermarks": []}
        self.outbox, self.kept, self.read_once = outbox, [], {}
        for kind in self.pending if outbox else ():
            outbox.replay(kind, lambda rows, kind=kind: self.replay(kind, [revived(r) for r in rows]))

    def _row(self, schema: str, table: str) -> dict:
        self.seq += 1
        return {"sourceId": self.source_id, "schema_name": schema, "table_name": table, "event_id": uuid.uuid4().hex, "_now": datetime.now(UTC).replace(tzinfo=None)}

    def mark(self, schema: str, table: str, load_date, mode: str, phase: str, status: str, **extra) -> None:
        row = self._row(schema, table)
        now = row.pop("_now")
        day = datetime.strptime(load_date, "%Y-%m-%d").date() if isinstance(load_date, str) else load_date
        self._add("events", row | {"load_date": day, "mode": mode, "phase": phase, "status": status, "event_at": now.isoformat(), "run_id": self.run_id, "event_seq": self.seq, "ts": now} | split_extra(extra))

    def set_progress(self, schema: str, table: str, watermark: str, last_loaded_date: str) -> None:
        row = self._row(schema, table)
        self._add("watermarks", row | {"watermark": str(watermark), "last_loaded_date": last_loaded_date, "updated_at": row.pop("_now")})

    def _add(self, kind: str, row: dict) -> None:
        row.pop("_now", None)
        if self.outbox:
            self.kept.append(self.outbox.put(kind, [row]))
        self.pending[kind].append(row)
        self.read_once.clear()
        if len(self.pending[kind]) >= self.flush_every or time.monotonic() - self.flushed_at >= self.flush_seconds:
            self.flush()

    def flush(self) -> None:
        """Write what is pending, to a folder of its own, so that stores of several tables can flush at once; rows stay pending if that fails."""
        self.flushed_at = time.monotonic()
        for kind, schema in (("events", EVENTS), ("watermarks", WATERMARKS)):
            rows = self.pending[kind]
            if rows:
                names = [p.split()[0] for p in schema.split(", ")]
                self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema).coalesce(1).write.parquet(f"{self.root}/{kind}/{uuid.uuid4().hex}")
                self.pending[kind] = []
        for path in self.kept:
            self.outbox.done(path)
        self.kept = []

    def replay(self, kind: str, rows: list[dict]) -> None:
        self.pending[kind] += rows
        self.flush()

    def preload(self) -> None:
        """Fetch the best status of every table's days and the newest watermarks at once, for ``day_status`` and ``progress`` to use until something is written."""
        key = ["schema_name", "table_name"]
        best = best_status(self.events(), [*key, "load_date", "mode", "phase"], tiebreak=("event_seq",)).select(*key, F.col("load_date").cast("string").alias("day"), "mode", "phase", "status", "ts").collect()
        newest = latest_progress(self.watermarks(), key).collect()
        self.read_once = {"days": best, "progress": {(r["schema_name"], r["table_name"]): (r["watermark"], r["last_loaded_date"]) for r in newest}}

    def _read(self, kind: str, schema: str) -> DataFrame:
        self.flush()
        store = Storage(self.spark)
        own = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/{kind}") if store.exists(f"{self.root}/{kind}") else self.spark.createDataFrame([], schema)
        return own.where(F.col("sourceId") == self.source_id).dropDuplicates(["event_id"])

    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    def watermarks(self) -> DataFrame:
        return self._read("watermarks", WATERMARKS)

    def day_status(self, schema: str, table: str, load_date: str, mode: str | None = None) -> dict[str, bool]:
        """For each phase of a table's day: did it end in success?  The best status counts."""
        if "days" in self.read_once:
            own = [r for r in self.read_once["days"] if (r["schema_name"], r["table_name"], r["day"]) == (schema, table, str(load_date)) and mode in (None, r["mode"])]
            done = {p: any(r["status"] == "success" for r in own if r["phase"] == p) for p in {r["phase"] for r in own}}
            return {"raw": False, "finalize": False} | done
        rows = self.events().where((F.col("schema_name") == schema) & (F.col("table_name") == table) & (F.col("load_date") == F.to_date(F.lit(load_date))))
        rows = rows.where(F.col("mode") == mode) if mode else rows
        found = {r["phase"]: r["status"] == "success" for r in best_status(rows, ["phase"], tiebreak=("event_seq",)).collect()}
        return {"raw": found.get("raw", False), "finalize": found.get("finalize", False)} | found

    def progress(self, schema: str, table: str) -> tuple[str, str] | None:
        """(watermark, last loaded date), the newest."""
        if "progress" in self.read_once:
            return self.read_once["progress"].get((schema, table))
        rows = self.watermarks().where((F.col("schema_name") == schema) & (F.col("table_name") == table))
        row = latest_progress(rows, ["schema_name", "table_name"]).first()
        return None if row is None else (row["watermark"], row["last_loaded_date"])
