"""Validation of a job's configuration, before anything runs."""

from __future__ import annotations

TRANSFORMS = frozenset({"identity", "year", "years", "month", "months", "day", "days", "bucket", "truncate"})


class ConfigError(ValueError):
    pass


def need(condition, message: str) -> None:
    if not condition:
        raise ConfigError(message)


def spec_entries(entries, where: str) -> list[str]:
    """Partition entries {field, transform} as the texts that layouts use."""
    out = []
    need(isinstance(entries or [], list), f"{where}.spec must be a list")
    for e in entries or []:
        need(isinstance(e, dict) and isinstance(e.get("field"), str) and e["field"], f"{where}.spec entries need a field")
        name, _, number = str(e.get("transform", "identity")).lower().partition(":")
        need(name in TRANSFORMS, f"{where}.spec: unknown transform {name}")
        need(name not in ("bucket", "truncate") or number.isdigit(), f"{where}.spec: {name} needs a number")
        out.append(e["field"] if name == "identity" else f"{name}({number + ', ' if number else ''}{e['field']})")
    return out


def derived_entries(entries, where: str) -> list[tuple[str, str]]:
    need(isinstance(entries or [], list), f"{where}.derived_columns must be a list")
    for e in entries or []:
        need(isinstance(e, dict) and all(isinstance(e.get(k), str) and e[k] for k in ("name", "expr")), f"{where}.derived_columns entries need name and expr")
    return [(e["name"], e["expr"]) for e in entries or []]


def merge_filter(entry, where: str) -> str | None:
    text = entry.get("expr") if isinstance(entry, dict) else entry
    need(text is None and entry is None or isinstance(text, str), f"{where}.merge_filter must be text, or an object with expr")
    return text


def partition_settings(defaults: dict | None, own: dict | None, table_filter=None) -> dict:
    """Layout, derived columns and merge filter of a table: its own after, or in place of, the defaults."""
    d, t = defaults or {}, own or {}
    join = lambda a, b, mode: b if str(mode or "append").lower() == "replace" else a + [x for x in b if x not in a]
    return {
        "spec": join(spec_entries(d.get("spec"), "partition_defaults"), spec_entries(t.get("spec"), "partition"), t.get("spec_mode")),
        "derived": join(derived_entries(d.get("derived_columns"), "partition_defaults"), derived_entries(t.get("derived_columns"), "partition"), t.get("derived_mode")),
        "merge_filter": merge_filter(table_filter, "intermediate") or merge_filter(t.get("merge_filter"), "partition") or merge_filter(d.get("merge_filter"), "partition_defaults"),
    }


def validate(config: dict) -> dict:
    """Raise ``ConfigError`` for the first thing wrong; give the configuration back."""
    for key in ("jdbc", "runtime", "tables"):
        need(key in config, f"missing {key}")
    runtime = config["runtime"]
    for key in ("raw_root", "final_root", "timezone"):
        need(key in runtime, f"missing runtime.{key}")
    need(runtime.get("state_backend", "files") in ("files",), "state_backend must be files")
    from tidelake.orchestration import MODES

    schedule = runtime.get("orchestration") or {}
    need(isinstance(schedule, dict), "runtime.orchestration must be an object")
    mode = str(schedule.get("mode", "plain_cron")).lower()
    need(mode in MODES, f"no schedules for mode {mode}")
    if mode == "temporal":
        missing = [k for k in ("namespace", "task_queue", "workflow") if not (schedule.get("temporal") or {}).get(k)]
        need(not missing, f"runtime.orchestration.temporal lacks {', '.join(missing)}")
    partition_settings((runtime.get("intermediate") or {}).get("partition_defaults"), None)
    for t in config["tables"]:
        where = f"{t.get('schema')}.{t.get('table')}"
        need(t.get("schema") and (t.get("table") or t.get("query_sql")), "a table needs schema and table")
        need(t.get("mode", "full") in ("full", "scd1"), f"{where}: mode must be full or scd1")
        source_filter = t.get("source_filter")
        need(source_filter is None or isinstance(source_filter, str) or isinstance(source_filter, list | tuple) and all(isinstance(f, str) for f in source_filter), f"{where}: source_filter must be text or a list of texts")
        inter = t.get("intermediate") or {}
        need(isinstance(inter, dict), f"{where}: intermediate must be an object")
        part = inter.get("partition")
        need(part is None or isinstance(part, dict), f"{where}: partition must be an object")
        need(str((part or {}).get("spec_mode", "append")).lower() in ("append", "replace"), f"{where}: spec_mode must be append or replace")
        partition_settings(None, part, inter.get("merge_filter"))
        if t.get("mode") == "scd1":
            for key in ("incremental_column", "primary_keys", "initial_watermark"):
                need(t.get(key), f"{where}: scd1 needs {key}")
            need((runtime.get("staging") or {}).get("root"), f"{where}: scd1 needs runtime.staging.root")
    return config


def only_tables(tables: list[dict], wanted: str | None) -> list[dict]:
    """The tables named in a comma-separated list of schema.table, in any case; all without one."""
    if not wanted:
        return tables
    names = {w.strip().lower() for w in wanted.split(",")}
    return [t for t in tables if f"{t['schema']}.{t['table']}".lower() in names]
