"""Events and who hears them."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from decimal import Decimal

CATEGORIES = ("state", "profile", "catalog", "plan", "tool", "debug", "ingest", "guardrail", "heartbeat", "notify", "log")


@dataclass(frozen=True)
class Event:
    category: str
    type: str
    payload: dict
    at: datetime = field(default_factory=lambda: datetime.now(UTC))


class Bus:
    """Hands each event to the subscribers of its category; one that fails doesn't keep it from the others."""

    def __init__(self):
        self.subscribers: list[tuple[frozenset, Callable[[Event], None]]] = []
        self.failures: list[tuple[Event, Exception]] = []

    def subscribe(self, hear: Callable[[Event], None], *categories: str) -> None:
        self.subscribers.append((frozenset(categories), hear))

    def publish(self, event: Event) -> None:
        for wanted, hear in self.subscribers:
            if not wanted or event.category in wanted:
                try:
                    hear(event)
                except Exception as e:  # noqa: BLE001
                    self.failures.append((event, e))


def plain(value):
    """A value as JSON has it: whole decimals as integers, times as UTC ISO text, bytes as hex, sets and tuples as lists."""
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime):
        return (value if value.tzinfo else value.replace(tzinfo=UTC)).isoformat()
    if isinstance(value, bytes | bytearray):
        return bytes(value).hex()
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, set | frozenset):
        return sorted((plain(v) for v in value), key=str)
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    return value if value is None or isinstance(value, str | int | float | bool) else str(value)


def log_line(event: Event, job: str, run_id: str) -> str:
    return json.dumps({"ts": event.at.isoformat(), "level": "INFO", "job": job, "event": event.type, "run_id": run_id, **plain(event.payload)}, sort_keys=True)


def state_subscriber(state, schema: str | None = None, table: str | None = None) -> Callable[[Event], None]:
    """Writes mark and watermark events to the state store; with a table, only that table's."""

    def hear(event: Event) -> None:
        p = dict(event.payload)
        if table is not None and (p.get("schema"), p.get("table")) != (schema, table):
            return
        if event.type == "state.mark":
            state.mark(p.pop("schema"), p.pop("table"), p.pop("load_date"), p.pop("mode"), p.pop("phase"), p.pop("status"), **p)
        elif event.type == "state.watermark":
            state.set_progress(p["schema"], p["table"], p["watermark"], p["last_loaded_date"])

    return hear


class Notifier:
    """Gathers events and hands them out as JSON lines every ``seconds`` (30 at least), and at the end of the block."""

    def __init__(self, send: Callable[[str], None], seconds: float = 300):
        self.send, self.seconds, self.over, self.held, self.lock = send, max(30.0, seconds), threading.Event(), [], threading.Lock()

    def hear(self, event: Event) -> None:
        with self.lock:
            self.held.append({"ts": event.at.isoformat(), "event": event.type, **plain(event.payload)})

    def flush(self) -> int:
        """How many events went out; they are held again, in order, if that fails."""
        with self.lock:
            now, self.held = self.held, []
        if now:
            try:
                self.send("\n".join(json.dumps(e, sort_keys=True) for e in now))
            except Exception:
                with self.lock:
                    self.held = now + self.held
                raise
        return len(now)

    def __enter__(self):
        self.thread = threading.Thread(target=self._run, daemon=True)
        self.thread.start()
        return self

    def _run(self) -> None:
        while not self.over.wait(self.seconds):
            try:
                self.flush()
            except Exception:  # noqa: BLE001  held; the next round sends it
                continue

    def __exit__(self, *_):
        self.over.set()
        self.thread.join()
        self.flush()


class Heartbeat:
    """A thread that publishes how many tables are running, every ``seconds`` (5 at least), until the block ends."""

    def __init__(self, bus: Bus, status: Callable[[], dict], seconds: float = 30):
        self.bus, self.status, self.seconds, self.over = bus, status, max(5.0, seconds), threading.Event()

    def __enter__(self):
        self.thread = threading.Thread(target=self._beat, daemon=True)
        self.thread.start()
        return self

    def _beat(self) -> None:
        began = time.time()
        while not self.over.wait(self.seconds):
            self.bus.publish(Event("heartbeat", "heartbeat.status", {"seconds": round(time.time() - began)} | self.status()))

    def __exit__(self, *_):
        self.over.set()
        self.thread.join()
