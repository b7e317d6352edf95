"""How a job is to be scheduled, as a document for whatever runs it.

Each kind of scheduler is a table: where a value goes in the document, which
settings of its section it may come from, and what it is without them.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Kind:
    section: str
    values: dict[str, tuple[str, ...]]
    defaults: dict[str, str] = field(default_factory=dict)


_METADATA = lambda *names: {f"metadata.{n}": (n,) for n in names}
KINDS = {
    "plain_cron": Kind("cron", {"schedule.expression": ("expression",), "schedule.timezone": ("timezone",), **_METADATA("log_file", "env")}, {"schedule.expression": "0 * * * *"}),
    "external_scheduler": Kind(
        "external",
        {"schedule.type": ("schedule_type",), "schedule.expression": ("expression", "cron"), "schedule.timezone": ("timezone",), "retries": ("retries",), "alerts": ("alerts",), **_METADATA("provider", "job_name", "dag_id", "pipeline_id", "notes")},
        {"schedule.type": "cron", "metadata.provider": "airflow"},
    ),
    "temporal": Kind(
        "temporal",
        {"schedule.type": (), "schedule.cron": ("schedule.cron",), "schedule.timezone": ("schedule.timezone", "timezone"), "schedule.catchup_window": ("schedule.catchup_window",), "retries": ("retry_policy",), "alerts": ("alerts",), "metadata.cron_schedule": ("schedule.cron",),
         **_METADATA("namespace", "task_queue", "workflow", "workflow_id", "start_to_close_timeout", "notes")},
        {"schedule.type": "temporal_schedule"},
    ),
}
#: Names of modes that a configuration may give.
MODES = {k: k for k in KINDS} | {"informatica": "external_scheduler", "airflow": "external_scheduler"}
COMMAND = ("python", "-m", "tidelake.cli", "ingest")


def setting(config: dict, path: str):
    """A nested setting by its dotted path; None where there is none."""
    for name in path.split("."):
        config = (config or {}).get(name)
    return config


def plan(config: dict, arguments: tuple[str, ...] = (), run_id: str = "") -> dict:
    """The schedule, command, retries and alerts of ``runtime.orchestration``."""
    runtime = config.get("runtime") or {}
    own = runtime.get("orchestration") or {}
    mode = MODES.get(str(own.get("mode", "plain_cron")).lower())
    if mode is None:
        raise ValueError(f"no schedules for mode {own['mode']}")
    kind = KINDS[mode]
    part = own.get(kind.section) or {}
    command = list(part.get("command") or (*COMMAND, *arguments))
    document: dict = {"mode": mode, "execution_command": command, "run_id": run_id, "schedule": {}, "metadata": {"mode_display": mode}}
    zone = own.get("timezone") or runtime.get("timezone", "UTC")
    for place, sources in kind.values.items():
        found = next((v for v in (setting(part, s) for s in sources) if v), kind.defaults.get(place, zone if place.endswith(".timezone") else None))
        if found:
            *above, name = place.split(".")
            (document[above[0]] if above else document)[name] = found
    if mode == "plain_cron":
        document["metadata"]["example_crontab"] = " ".join([document["schedule"]["expression"], *command])
    return document
