"""Command line: ``ingest``, ``recon``, ``watch`` and ``failures``."""

from __future__ import annotations

import argparse
import json
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidelake import config as configuration
from tidelake import orchestration
from tidelake.events import Bus, Event, Heartbeat, Notifier, log_line, state_subscriber
from tidelake.metadata import DICTIONARIES, Dictionary, SnapshotStore, capture, jdbc_asker
from tidelake.functions.names import table_identifier
from tidelake.operators import maintenance, profile, recon
from tidelake.operators.lake import CatalogTable, Landing, VersionedTable, Zones, mirror, register_external, set_up_catalog
from tidelake.operators.state import StateStore
from tidelake.pipeline import Loader, run_tables
from tidelake.sources.jdbc import JdbcTable
from tidelake.sources.storage import Outbox, Storage

LOG = "ts string, event string, schema string, table string, mode string, status string, rows long, message string, error_type string"


def session(config: dict) -> SparkSession:
    runtime = config["runtime"]
    builder = SparkSession.builder.appName(runtime.get("job_name", "tidelake")).config("spark.scheduler.mode", "FAIR").config("spark.sql.session.timeZone", runtime.get("timezone", "UTC"))
    for k, v in (runtime.get("spark") or {}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def parts(spark: SparkSession, config: dict, table: dict, run_id: str, bus: Bus):
    """(loader, landing, versioned table or None) of one configured table."""
    runtime = config["runtime"]
    zones = Zones(runtime["raw_root"], runtime["final_root"], table["schema"], table["table"], bool(runtime.get("append_table_schema")))
    landing = Landing(spark, zones, (runtime.get("staging") or {}).get("root"), runtime.get("write_format", "parquet"), runtime.get("compression", "snappy"))
    inter, own = runtime.get("intermediate") or {}, table.get("intermediate") or {}
    settings = configuration.partition_settings(inter.get("partition_defaults"), own.get("partition"), own.get("merge_filter"))
    target = None
    if inter.get("enabled") and table.get("mode") == "scd1":
        if inter.get("catalog"):  # a catalog whose tables have MERGE
            set_up_catalog(spark, inter["catalog"], inter.get("catalog_settings") or {})
            target = CatalogTable(spark, f"{inter['catalog']}.{inter.get('db', table['schema'])}.{table_identifier(table['schema'], table['table'])}", inter.get("format", "iceberg"), settings["spec"])
        else:
            target = VersionedTable(spark, inter["warehouse"], table["schema"], table["table"], settings["spec"])
    state_root = runtime.get("state_root", f"{runtime['final_root']}/_state")
    outbox = Outbox(Storage(spark), f"{state_root}/outbox/{table_identifier(table['schema'], table['table'])}")
    state = StateStore(spark, state_root, runtime.get("source_id", "default"), run_id, int(runtime.get("state_flush_every", 50)), outbox=outbox)
    bus.subscribe(state_subscriber(state, table["schema"], table["table"]), "state")
    meta = runtime.get("metadata") or {}
    kept = SnapshotStore(Storage(spark), meta["cache_path"], float(meta.get("ttl_hours", 24))).latest(meta.get("source_id", "default"), table["schema"], table["table"]) if meta.get("enabled") else None
    source = JdbcTable.of(spark, config["jdbc"], table)
    if rules := meta.get("guardrails"):
        guard = profile.precision_guardrail(kept and kept.content.get("fields"), rules.get("max_precision"), rules.get("violation_action"), rules.get("open_precision_action"), rules.get("fallback"))
        bus.publish(Event("guardrail", "guardrail.precision", {"schema": table["schema"], "table": table["table"], "status": guard.status, "issues": list(guard.issues)}))
        source = source.guarded(guard)
    loader = Loader(spark, {"schema_policy": meta.get("schema_policy"), "scd1_slicing": runtime.get("scd1_slicing"), "finalize_full_refresh": runtime.get("finalize_full_refresh", True), "finalize_strategy": runtime.get("finalize_strategy"), "hive": runtime.get("hive")} | table | settings, source, landing, state, run_id, bus, target, kept.types if kept else None)
    return loader, landing, target, settings


def to_reload(wanted: str | None, tables: list[dict]) -> set[str]:
    """Tables to load anew: those named, all of them for ``*`` or an empty list, none without the option."""
    if wanted is None:
        return set()
    named = {w.strip().lower() for w in wanted.split(",") if w.strip()}
    return named if named - {"*"} else {f"{t['schema']}.{t['table']}".lower() for t in tables}


def days(load_date: str, start: str | None, end: str | None) -> list[str]:
    """The days of a backfill, both ends included, or the one load date."""
    if not (start or end):
        return [load_date]
    first, last = date.fromisoformat(start or end), date.fromisoformat(end or load_date)
    if first > last:
        raise configuration.ConfigError("the backfill ends before it starts")
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def ingest(args, config: dict) -> int:
    configuration.validate(config)
    run_id = uuid.uuid4().hex
    if args.dump_orchestration_plan:
        print(json.dumps(orchestration.plan(config, (f"--config={args.config}",), run_id), indent=2, sort_keys=True))
        return 0
    spark, bus = session(config), Bus()
    job = config["runtime"].get("job_name", "tidelake")
    bus.subscribe(lambda e: print(log_line(e, job, run_id), flush=True))
    tables = configuration.only_tables(config["tables"], args.only_tables)
    reload = to_reload(args.reload, tables)
    if (meta := config["runtime"].get("metadata") or {}).get("enabled"):
        dictionary = Dictionary(meta["queries"], tuple(meta.get("probes") or ())) if meta.get("queries") else DICTIONARIES.get(str(config["jdbc"].get("dialect", "")).lower())
        if tables and dictionary is not None:
            options = JdbcTable.of(spark, config["jdbc"], tables[0]).options()
            store = SnapshotStore(Storage(spark), meta["cache_path"], float(meta.get("ttl_hours", 24)))
            found = capture(jdbc_asker(spark, options), dictionary, store, meta.get("source_id", "default"), [(t["schema"], t["table"]) for t in tables], tuple(meta.get("skip") or ()), options["url"])
            bus.publish(Event("metadata", "metadata.capture", {"tables": found}))
    made = {f"{t['schema']}.{t['table']}": (t, *parts(spark, config, t, run_id, bus)) for t in tables}
    if args.maintenance_mode:
        jobs = [(n, landing, target, settings | {"primary_keys": t["primary_keys"], "incremental_column": t["incremental_column"]}) for n, (t, _, landing, target, settings) in made.items() if target is not None]
        print(json.dumps(found := maintenance.run_all(jobs, args.maintenance_mode), default=str))
        return int(any(r["status"] == "error" for r in found))
    notices = Storage(spark)
    outlet = config["runtime"].get("notify_path")
    notifier = Notifier(lambda lines: notices.write_text(f"{outlet}/{uuid.uuid4().hex}.jsonl", lines) if outlet else None, args.notify_interval_seconds)
    bus.subscribe(notifier.hear)
    with Heartbeat(bus, lambda: {"tables": len(made)}, args.heartbeat_seconds), notifier:
        results, errors = [], []
        for day in days(args.load_date, args.start_date, args.end_date):
            loads = {n: (lambda l=loader, n=n, d=day: l.run(d, reload=n.lower() in reload or None, lag_seconds=args.wm_lag_seconds)) for n, (_, loader, *_) in made.items()}
            done, wrong = run_tables(spark, loads, int(config["runtime"].get("max_parallel_tables", 4)))
            results, errors = results + done, errors + wrong
    failed = {e["table"] for e in errors}
    side, hive = config["runtime"].get("final_parquet_mirror") or {}, config["runtime"].get("hive") or {}
    for n, (t, loader, landing, target, _) in made.items():
        if n not in failed and target is not None and target.exists() and side.get("enabled"):
            reg = side.get("hive_reg") or {}
            mirror(spark, target, f"{side['root'].rstrip('/')}/{t['schema']}/{t['table']}", args.load_date, side.get("partition_col", "load_date"), {"db": reg["db"], "name": t["table"], "use_msck": reg.get("use_msck")} if reg.get("enabled") else None)
        if n not in failed and t.get("mode", "full") == "full" and hive.get("enabled") and landing.storage.exists(landing.zones.final):
            register_external(spark, hive["db"], t["table"], landing.zones.final)
        if t.get("mode") == "scd1":
            landing.clean_slices(t["incremental_column"], float((config["runtime"].get("staging") or {}).get("ttl_hours", 72)))
    print(json.dumps({"results": results, "errors": errors}, default=str))
    return int(bool(errors))


def reconcile(args, config: dict) -> int:
    configuration.validate(config)
    spark = session(config)
    defaults = (config.get("reconciliation_defaults") or {}).get("checks", [])
    hive = config["runtime"].get("hive") or {}

    def target_of(table: dict, landing: Landing, target) -> DataFrame:
        """The merged table, or the registered one, or the final folder: the first that is there."""
        if target is not None and target.exists():
            return target.read()
        if hive.get("enabled") and spark.catalog.tableExists(f"{hive['db']}.{table['table']}"):
            return spark.table(f"{hive['db']}.{table['table']}")
        return spark.read.parquet(landing.zones.final)

    def checked(table: dict) -> list:
        checks = recon.resolve_checks(defaults, table.get("reconciliation"), args.checks.split(",") if args.checks else None)
        if not checks:
            return []
        loader, landing, target, _ = parts(spark, config, table, "recon", Bus())
        context = recon.CheckContext(loader.source.read_full, lambda: target_of(table, landing, target), tuple(table.get("primary_keys") or ()))
        return recon.run_checks(f"{table['schema']}.{table['table']}", context, checks)

    with ThreadPoolExecutor(max(1, args.max_parallel or 1)) as pool:
        results = [r for found in pool.map(checked, configuration.only_tables(config["tables"], args.only_tables)) for r in found]
    out = json.dumps({"summary": recon.summary(results), "results": [r.__dict__ for r in results]}, default=str)
    if args.output_json:
        with open(args.output_json, "w") as f:
            f.write(out)
    print(out)
    return recon.exit_code(results, args.fail_on_warn)


def watch(args) -> int:
    from pyspark.sql import functions as F

    from tidelake.operators.telemetry import failure_summary, progress_lines
    from tidelake.sources.files import log_events

    spark = SparkSession.builder.getOrCreate()
    if args.command == "failures":
        shown = failure_summary(log_events(spark, args.log_file, LOG).where("event = 'ingest.table.failure'"), ["error_type", "message"], "ts", "table").orderBy(F.col("failures").desc())
        (shown if args.show_tables else shown.drop("tables")).show(100, False)
        return 0
    since = None if args.once or args.from_start else datetime.now(UTC).isoformat()  # a tail shows what comes from now on
    while True:
        events = log_events(spark, args.log_file, LOG).withColumn("state", F.col("status"))
        progress_lines(events if since is None else events.where(F.col("ts") >= since)).orderBy("schema", "table").show(1000, False)
        if args.once:
            return 0
        time.sleep(args.interval)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidelake")
    commands = p.add_subparsers(dest="command", required=True)
    a = commands.add_parser("ingest")
    a.add_argument("--config", required=True)
    a.add_argument("--only-tables")
    a.add_argument("--load-date", default=date.today().isoformat())
    a.add_argument("--start-date")
    a.add_argument("--end-date")
    a.add_argument("--reload", nargs="?", const="*", default=None)
    a.add_argument("--wm-lag-seconds", type=int)
    a.add_argument("--heartbeat-seconds", type=float, default=30)
    a.add_argument("--notify-interval-seconds", type=float, default=300)
    a.add_argument("--dump-orchestration-plan", action="store_true")
    a.add_argument("--maintenance-mode", choices=("dry-run", "apply", "rebuild-from-raw"))
    r = commands.add_parser("recon")
    r.add_argument("--config", required=True)
    r.add_argument("--only-tables")
    r.add_argument("--checks")
    r.add_argument("--output-json")
    r.add_argument("--fail-on-warn", action="store_true")
    r.add_argument("--engine", choices=("spark",), default="spark")
    r.add_argument("--max-parallel", type=int)
    w = commands.add_parser("watch")
    w.add_argument("--log-file", required=True)
    w.add_argument("--interval", type=float, default=5)
    w.add_argument("--from-start", action="store_true")
    w.add_argument("--once", action="store_true")
    w = commands.add_parser("failures")
    w.add_argument("--log-file", required=True)
    w.add_argument("--show-tables", action="store_true")
    args = p.parse_args(argv)
    if args.command in ("watch", "failures"):
        return watch(args)
    with open(args.config) as f:
        config = json.load(f)
    return ingest(args, config) if args.command == "ingest" else reconcile(args, config)


if __name__ == "__main__":
    sys.exit(main())
