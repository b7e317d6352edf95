"""Source-against-target checks: counts, grouped counts, key uniqueness.

Comparisons run in Spark; only statuses and at most ``SAMPLE`` differing rows
come to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

SAMPLE = 20


def filtered(df: DataFrame, predicate: str | None) -> DataFrame:
    return df.where(predicate) if predicate else df


def count_status(source: int, target: int, absolute: float = 0, percent: float | None = None) -> str:
    """``pass`` if the difference is within ``absolute`` and, if given, within ``percent`` of the source; both must hold."""
    diff = abs(source - target)
    if diff > absolute:
        return "fail"
    if percent is not None and source > 0 and diff / source * 100 > percent:
        return "fail"
    return "pass"


def plain_count(source: DataFrame, target: DataFrame, absolute: float = 0, percent: float | None = None) -> DataFrame:
    """One row: source_count, target_count, diff, percent_diff, status."""
    none = F.lit(0).cast("long")
    a, b = source.agg(F.count("*").alias("source_count"), none.alias("target_count")), target.agg(none.alias("source_count"), F.count("*").alias("target_count"))
    both = a.union(b).agg(F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count"))
    diff = F.abs(F.col("source_count") - F.col("target_count"))
    share = F.when(F.col("source_count") > 0, diff / F.col("source_count") * 100)
    bad = diff > F.lit(absolute)
    if percent is not None:
        bad = bad | F.coalesce(share > F.lit(percent), F.lit(False))
    return both.select("source_count", "target_count", diff.alias("diff"), F.round(share, 6).alias("percent_diff"), F.when(bad, "fail").otherwise("pass").alias("status"))


def group_count(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose counts differ: the keys, source_count, target_count, difference (target less source).  Null keys are a group."""
    names = [f"key_{i}" for i in range(len(keys))]
    count = lambda df, name: df.groupBy(*(F.expr(k).alias(n) for k, n in zip(keys, names))).agg(F.count("*").alias(name))
    a, b = count(source, "source_count").alias("a"), count(target, "target_count").alias("b")
    on = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    left, right = F.coalesce("source_count", F.lit(0)), F.coalesce("target_count", F.lit(0))
    joined = a.join(b, on, "full_outer").select(*(F.coalesce(F.col(f"a.{n}"), F.col(f"b.{n}")).alias(n) for n in names), left.alias("source_count"), right.alias("target_count"), (right - left).alias("difference"))
    return joined.where("difference <> 0")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def counted_sample(df: DataFrame, order: list[str]) -> tuple[int, list[dict]]:
    """How many rows there are, and the first of them, from one pass."""
    seen = Observation(f"sample-{uuid.uuid4().hex}")
    rows = df.observe(seen, F.count(F.lit(1)).alias("n")).orderBy(*order).limit(SAMPLE).collect()
    return seen.get.get("n", 0) if rows else 0, [r.asDict() for r in rows]


@dataclass(frozen=True)
class CheckContext:
    source: Callable[[], DataFrame]
    target: Callable[[], DataFrame]
    primary_keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class CheckResult:
    table: str
    check: str
    status: str
    details: dict = field(default_factory=dict)


CHECKS: dict[str, Callable[[CheckContext, dict], tuple[str, dict]]] = {}


def check(name: str):
    def add(f):
        CHECKS[name] = f
        return f

    return add


@check("plain_count")
def _plain_count(context: CheckContext, config: dict) -> tuple[str, dict]:
    thresholds = config.get("threshold") or {}
    row = plain_count(filtered(context.source(), config.get("filter")), filtered(context.target(), config.get("filter")), thresholds.get("absolute", 0), thresholds.get("percent")).first()
    return row["status"], row.asDict()


@check("group_count")
def _group_count(context: CheckContext, config: dict) -> tuple[str, dict]:
    keys = config.get("group_by") or []
    if not keys:
        raise ValueError("group_count needs group_by")
    found = group_count(filtered(context.source(), config.get("filter")), filtered(context.target(), config.get("filter")), keys)
    total, sample = counted_sample(found, [f"key_{i}" for i in range(len(keys))])
    return ("fail" if total else "pass"), {"differing_groups": total, "sample": sample}


@check("pk_uniqueness")
def _pk_uniqueness(context: CheckContext, config: dict) -> tuple[str, dict]:
    keys = list(config.get("primary_keys") or context.primary_keys)
    if not keys:
        return "skipped", {"reason": "no primary keys"}
    details, bad = {}, False
    for side, df in (("source", context.source()), ("target", context.target())):
        found = duplicate_keys(filtered(df, config.get("filter")), keys)
        total, details[f"{side}_sample"] = counted_sample(found, keys)
        details[f"{side}_duplicates"] = total
        bad |= total > 0
    return ("fail" if bad else "pass"), details


def resolve_checks(defaults: list[dict], own, only: list[str] | None = None) -> list[dict]:
    """A table's checks: the defaults, then its own (a list, or a dictionary with ``checks``); disabled ones and those not asked for are left out."""
    listed = own.get("checks", []) if isinstance(own, dict) else own or []
    wanted = {o.lower() for o in only} if only else None
    return [c for c in [*defaults, *listed] if c.get("enabled", True) and (wanted is None or {str(c.get("type", "")).lower(), str(c.get("name", "")).lower()} & wanted)]


def run_checks(table: str, context: CheckContext, checks: list[dict]) -> list[CheckResult]:
    """Each check's result; one that raises, or that nobody knows, is an error of its own."""
    out = []
    for config in checks:
        name = config.get("name") or config.get("type", "")
        try:
            if config.get("type") not in CHECKS:
                raise ValueError(f"unknown check {config.get('type')}")
            status, details = CHECKS[config["type"]](context, config)
        except Exception as e:  # noqa: BLE001  one check's failure is that check's result
            status, details = "error", {"error": str(e).split("\n")[0]}
        out.append(CheckResult(table, name, status, details))
    return out


def summary(results: list[CheckResult]) -> dict[str, int]:
    """How many results of each status; skipped ones count apart."""
    out = {"total": len(results)} | dict.fromkeys(("pass", "warn", "fail", "error", "skipped"), 0)
    for r in results:
        out[r.status] += 1
    return out


def exit_code(results: list[CheckResult], fail_on_warn: bool = False) -> int:
    return 2 if fail_on_warn and any(r.status in ("warn", "fail", "error") for r in results) else 0
