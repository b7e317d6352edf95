"""The two load strategies: full refresh, and keyed increments."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.events import Bus, Event
from tidelake.functions.columns import before_watermark, with_derived, with_ingest_columns
from tidelake.operators import profile, upsert
from tidelake.operators.lake import Landing, VersionedTable, register_external, set_location
from tidelake.operators.state import StateStore
from tidelake.plans.slicing import Slice, SlicingPolicy, plan_slices
from tidelake.sources import files

EPOCH_DAY = "1900-01-01"


class Loader:
    """One source table's loads.  ``source`` has read_full, read_slice and count_between."""

    def __init__(self, spark: SparkSession, config: dict, source, landing: Landing, state: StateStore, run_id: str, bus: Bus | None = None, table: VersionedTable | None = None, snapshot: dict | None = None):
        self.spark, self.config, self.source, self.landing, self.state, self.run_id = spark, config, source, landing, state, run_id
        self.bus, self.table, self.snapshot = bus or Bus(), table, snapshot
        self.schema, self.name = config["schema"], config["table"]

    def _emit(self, type_: str, **payload) -> None:
        self.bus.publish(Event(type_.split(".")[0], type_, {"schema": self.schema, "table": self.name} | payload))

    def _prepared(self, df: DataFrame) -> DataFrame:
        """Checked against the snapshot, missing columns padded, ingest columns added."""
        if self.snapshot is not None:
            policy = profile.DriftPolicy.of(self.config.get("schema_policy"))
            try:
                profile.schema_drift(self.snapshot, df.schema, policy)
            except profile.SchemaDriftError:
                df = upsert.extend_missing(df, self.config.get("snapshot_types") or dict.fromkeys(self.snapshot, "string"))
                profile.schema_drift(self.snapshot, df.schema, policy)
        elif profile.DriftPolicy.of(self.config.get("schema_policy")).require_snapshot:
            raise profile.SchemaDriftError("no snapshot")
        return with_ingest_columns(df, self.run_id)

    def full_refresh(self, load_date: str, reload: bool = False) -> dict:
        done = {} if reload else self.state.day_status(self.schema, self.name, load_date, "full")
        if done.get("finalize"):
            return {"table": self.name, "mode": "full", "skipped": True, "reason": "finalized"}
        mark = lambda phase, status, **x: self.state.mark(self.schema, self.name, load_date, "full", phase, status, **x)
        out = {"table": self.name, "mode": "full", "rows": 0, "raw": self.landing.zones.raw(load_date), "final": self.landing.zones.final, "finalized": False}
        if not done.get("raw"):
            mark("raw", "started")
            written = self.landing.write_raw(with_derived(self._prepared(self.source.read_full()), self.config.get("derived") or []), load_date)
            out["rows"] = written["rows"]
            mark("raw", "success" if written["rows"] else "skipped", rows_written=written["rows"], location=written["location"])
            if not written["rows"]:  # the old final stays
                return out | {"skipped": True, "reason": "empty"}
        if self.config.get("finalize_full_refresh", True):
            mark("finalize", "started")
            if self.config.get("finalize_strategy") == "hive_set_location" and (hive := self.config.get("hive") or {}).get("enabled"):
                out["final"] = out["raw"]
                register_external(self.spark, hive["db"], self.name, out["raw"])
                set_location(self.spark, hive["db"], self.name, out["raw"])
            else:
                self.landing.finalize(load_date)
            mark("finalize", "success", location=out["final"])
            out["finalized"] = True
        return out

    def incremental(self, load_date: str, now: datetime | None = None, lag_seconds: int | None = None, reload: bool = False) -> dict:
        c = self.config
        column, kind, keys = c["incremental_column"], c.get("incr_col_type"), c["primary_keys"]
        mark = lambda phase, status, **x: self.state.mark(self.schema, self.name, load_date, "scd1", phase, status, **x)
        last, last_day = (None if reload else self.state.progress(self.schema, self.name)) or (c["initial_watermark"], EPOCH_DAY)
        lower = before_watermark(last, lag_seconds if lag_seconds is not None else int(c.get("lag_seconds", 0)), kind)
        plan_path = f"{self.landing.slices_dir(column)}/../_PLAN.json"
        held = self.landing.storage.read_json(plan_path)
        if held and held["lower"] == lower:  # a run that broke off: its slices again, with its bounds
            slices = tuple(Slice(*s) for s in held["slices"])
        else:
            plan = plan_slices(lower, kind, self.source.count_between, now or datetime.now(), SlicingPolicy.of(c.get("scd1_slicing")))
            slices = plan.slices
            self.landing.storage.write_json(plan_path, {"lower": lower, "slices": [(s.lower, s.upper) for s in slices]})
            self._emit("plan.adapt", slices=len(slices), estimate=plan.estimate)
        mark("raw", "started")
        for part in slices:
            staged = self.landing.stage_slice(column, part, with_derived(self._prepared(self.source.read_slice(part)), c.get("derived") or []))
            self._emit("ingest.slice.progress", status="completed", lower=part.lower, upper=part.upper, rows=staged.get("rows"))
        waiting = [p for p in self.landing.pending_slices(column)]
        out = {"table": self.name, "mode": "scd1", "rows": 0, "raw": self.landing.zones.raw_base, "wm": last, "last_loaded_date": last_day, "staged_slices": len(slices)}
        if waiting:
            source = files.slices(self.spark, waiting)
            found = upsert.new_watermark(source.withColumn("load_date", F.to_date(F.lit(load_date))), column, kind).withColumn("rows", F.lit(0)).first()
            rows = sum((self.landing.storage.read_json(f"{p}/_RANGE.json") or {}).get("rows", 0) for p in waiting)
            if rows:
                mark("intermediate", "started")
                if self.table is not None:
                    dated = source.withColumn("load_date", F.to_date(F.lit(load_date)))
                    self.table.merge(dated, keys, [column, "load_timestamp"], c.get("merge_filter"), newer=column)
                mark("intermediate", "success", rows_written=rows)
                for path in waiting:
                    self.landing.append_raw(path, load_date)
            self.landing.mark_landed(waiting)
            mark("raw", "success" if rows else "skipped", rows_written=rows)
            if found["watermark"] is not None:
                out |= {"wm": found["watermark"], "last_loaded_date": found["last_loaded_date"]}
                self.state.set_progress(self.schema, self.name, out["wm"], out["last_loaded_date"])
                mark("watermark", "success", watermark=out["wm"])
            out["rows"] = rows
        self.landing.storage.delete(plan_path)
        self.state.flush()
        return out

    def run(self, load_date: str, **options) -> dict:
        self._emit("ingest.table.start", mode=self.config.get("mode", "full"), load_date=load_date)
        try:
            options = {k: v for k, v in options.items() if v is not None}
            full = self.config.get("mode", "full") == "full"
            out = self.full_refresh(load_date, bool(options.get("reload"))) if full else self.incremental(load_date, **options)
        except Exception as e:
            self.state.mark(self.schema, self.name, load_date, self.config.get("mode", "full"), "raw", "failed", error=str(e).split("\n")[0])
            self.state.flush()
            self._emit("ingest.table.failure", message=str(e).split("\n")[0], error_type=type(e).__name__)
            raise
        self.state.flush()
        self._emit("ingest.table.success", rows=out.get("rows", 0))
        return out


def run_tables(spark: SparkSession, loads: dict[str, Callable[[], dict]], parallel: int = 4) -> tuple[list[dict], list[dict]]:
    """Loads side by side, each in its own scheduler pool and job group; (results, errors)."""

    def one(item):
        name, load = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setJobGroup(name, name)
        try:
            return load(), None
        except Exception as e:  # noqa: BLE001  one table's error doesn't stop the others
            return None, {"table": name, "error": str(e).split("\n")[0]}

    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(one, loads.items()))
    return [r for r, _ in done if r is not None], [e for _, e in done if e is not None]
