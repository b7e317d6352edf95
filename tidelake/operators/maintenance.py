"""Table maintenance: merge what was staged but not landed, lay out anew, rebuild from raw history."""

from __future__ import annotations

from tidelake.functions.columns import with_derived
from tidelake.operators import upsert
from tidelake.operators.lake import Landing, VersionedTable
from tidelake.sources import files


def maintenance_plan(landing: Landing, table: VersionedTable, config: dict) -> dict:
    """What a run would do: pending slices, current and wanted layout."""
    wanted, current = config.get("spec"), (table.pointer or {}).get("spec", [])
    return {"pending": landing.pending_slices(config["incremental_column"]), "spec": wanted, "current_spec": current, "respec": wanted is not None and wanted != current, "merge_filter": config.get("merge_filter"), "derived": config.get("derived") or []}


def run_maintenance(landing: Landing, table: VersionedTable, config: dict, mode: str = "dry-run") -> dict:
    """``dry-run``, ``apply`` (merge pending slices, or lay the table out anew) or ``rebuild-from-raw``."""
    plan = maintenance_plan(landing, table, config)
    keys, order = config["primary_keys"], [config["incremental_column"], *config.get("order", [])]
    if mode == "dry-run":
        return {"status": "dry_run"} | plan
    if mode == "rebuild-from-raw":
        days = [n.removeprefix("load_date=") for n in landing.storage.names(landing.zones.raw_base) if n.startswith("load_date=")]
        if not days:
            return {"status": "no_data"}
        raw = with_derived(files.raw_chunks(landing.spark, landing.zones.raw_base, days), plan["derived"])
        table.spec = plan["spec"] if plan["spec"] is not None else table.partition_spec()
        made = table.publish(upsert.rebuild(raw, keys, order), keep=1 if config.get("keep_backup", True) else 0)
        return {"status": "rebuilt", "days": days} | made
    if plan["spec"] is not None:
        table.spec = plan["spec"]
    if plan["pending"]:
        source = with_derived(files.slices(landing.spark, plan["pending"]), plan["derived"])
        made = table.merge(source, keys, order, plan["merge_filter"], newer=config["incremental_column"])
        landing.mark_landed(plan["pending"])
        return {"status": "applied", "slices": len(plan["pending"])} | made
    if not table.exists():
        return {"status": "no_data"}
    if not plan["respec"] and not plan["derived"]:
        return {"status": "noop"}
    made = table.publish(with_derived(table.read(), plan["derived"]))
    return {"status": "repartitioned" if plan["respec"] else "rewritten"} | made


def run_all(jobs: list[tuple[str, Landing, VersionedTable, dict]], mode: str) -> list[dict]:
    """Table by table; one table's error doesn't stop the others."""
    out = []
    for name, landing, table, config in jobs:
        try:
            out.append({"table": name} | run_maintenance(landing, table, config, mode))
        except Exception as e:  # noqa: BLE001  isolated on purpose
            out.append({"table": name, "status": "error", "error": str(e).split("\n")[0]})
    return out
