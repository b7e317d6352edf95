"""Slices of an incremental load: half-open ranges (lower, upper] of its column."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from tidelake.functions.columns import is_integer_watermark, whole


@dataclass(frozen=True)
class Slice:
    lower: str
    upper: str | None = None


@dataclass(frozen=True)
class LoadPlan:
    slices: tuple[Slice, ...] = ()
    upper: str | None = None
    estimate: int | None = None
    reason: str | None = None
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class SlicingPolicy:
    enabled: bool = True
    max_count: int = 10_000_000
    target_rows: int = 1_000_000
    max_slices: int = 24
    max_hours: float | None = None

    @classmethod
    def of(cls, config: dict | None) -> SlicingPolicy:
        c = config or {}
        return cls(c.get("enabled", True), int(c.get("max_count", cls.max_count)), int(c.get("target_rows_per_slice", cls.target_rows)), int(c.get("max_partitions", cls.max_slices)), c.get("max_duration_hours"))


def now_literal(kind: str | None, now: datetime) -> str | None:
    """The present as an upper bound; None where an integer column isn't a time."""
    kind = (kind or "timestamp").lower()
    if kind == "epoch_millis":
        return str(int(now.timestamp() * 1000))
    if kind in ("epoch", "epoch_seconds"):
        return str(int(now.timestamp()))
    return None if is_integer_watermark(kind) else now.strftime("%Y-%m-%d %H:%M:%S")


def cut(lower: str, upper: str, kind: str | None, parts: int) -> tuple[Slice, ...]:
    """``parts`` slices of equal width; the last ends at ``upper``.  Times are cut to whole seconds."""
    if is_integer_watermark(kind):
        lo, hi = whole(lower), whole(upper)
        step = max(1, (hi - lo) // parts)
        show, add = str, lambda i: lo + step * i
    else:
        lo, hi = datetime.fromisoformat(lower), datetime.fromisoformat(upper)
        step = max(1, int((hi - lo).total_seconds()) // parts)
        show, add = lambda t: t.strftime("%Y-%m-%d %H:%M:%S"), lambda i: lo + timedelta(seconds=step * i)
    inner = [add(i) for i in range(1, parts) if add(i) < hi]
    bounds = [lower, *map(show, inner), upper]
    return tuple(Slice(a, b) for a, b in zip(bounds, bounds[1:]))


def plan_slices(lower: str | None, kind: str | None, count: Callable[[str, str | None], int], now: datetime, policy: SlicingPolicy, column: str | None = "") -> LoadPlan:
    """One slice if few rows are waiting and their span is short, else enough of them for the policy's target."""
    if column is None or not lower:
        return LoadPlan(reason="incremental_not_supported")
    upper = now_literal(kind, now)
    rows = count(lower, upper)
    if upper is None or not policy.enabled:
        return LoadPlan((Slice(lower, upper),), upper, rows)
    long_span = False
    if policy.max_hours:
        span = (int(upper) - whole(lower)) / (1000 if kind == "epoch_millis" else 1) if is_integer_watermark(kind) else (datetime.fromisoformat(upper) - datetime.fromisoformat(lower)).total_seconds()
        long_span = span > 3600 * policy.max_hours and rows > policy.target_rows
    if rows <= policy.max_count and not long_span:
        return LoadPlan((Slice(lower, upper),), upper, rows)
    parts = min(policy.max_slices, max(2, math.ceil(rows / policy.target_rows)))
    return LoadPlan(cut(lower, upper, kind, parts), upper, rows, notes={"parts": parts})
