"""What must hold when a run breaks off, and that merges touch only what they must."""

import pytest
from pyspark.sql import functions as F

from tidelake.functions.columns import whole
from tidelake.operators import recon, upsert
from tidelake.operators.lake import Landing, VersionedTable, Zones, copy_with_names
from tidelake.plans.slicing import Slice, cut
from tidelake.sources.storage import Storage


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, Zones(f"{tmp_path}/raw", f"{tmp_path}/final", "s", "t"), f"{tmp_path}/staging")


def test_a_text_is_replaced_whole(spark, tmp_path):
    store, path = Storage(spark), f"{tmp_path}/p.json"
    store.write_text(path, "old")
    real = store._of

    class Broken:  # the write breaks off before the rename
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                raise OSError("broken")
            return Broken(self.fs.getRawFileSystem()) if name == "getRawFileSystem" else getattr(self.fs, name)

        def __call__(self):
            return self

    store._of = lambda p: (Broken(real(p)[0]), real(p)[1])
    with pytest.raises(OSError):
        store.write_text(path, "new")
    store._of = real
    assert store.read_text(path) == "old"
    store.write_text(path, "new")
    assert store.read_text(path) == "new"


def test_an_empty_refresh_keeps_the_day(spark, landing):
    assert landing.write_raw(spark.range(5), "2024-01-01")["rows"] == 5
    assert landing.write_raw(spark.range(0), "2024-01-01")["status"] == "skipped"
    assert spark.read.parquet(landing.zones.raw("2024-01-01")).count() == 5
    assert landing.write_raw(spark.range(7), "2024-01-01")["rows"] == 7
    assert spark.read.parquet(landing.zones.raw("2024-01-01")).count() == 7


def test_a_broken_finalize_loses_nothing(spark, landing, monkeypatch):
    store, final = landing.storage, landing.zones.final
    landing.write_raw(spark.range(5), "2024-01-01")
    landing.finalize("2024-01-01")
    landing.write_raw(spark.range(9), "2024-01-02")
    real = store.rename

    def second_fails(a, b):
        if b == final and not a.endswith("__old"):
            raise OSError("broken")
        real(a, b)

    monkeypatch.setattr(store, "rename", second_fails)
    with pytest.raises(OSError):
        landing.finalize("2024-01-02")
    assert spark.read.parquet(final).count() == 5
    monkeypatch.undo()
    store.rename(final, f"{final}__old")  # a crash between the two renames
    landing.finalize("2024-01-02")
    assert spark.read.parquet(final).count() == 9 and not store.exists(f"{final}__old")


def test_raw_appends_happen_once(spark, landing):
    parts = [Slice(str(i), str(i + 1)) for i in range(3)]
    for i, p in enumerate(parts):
        landing.stage_slice("id", p, spark.range(10 * i, 10 * i + 10))
    waiting = landing.pending_slices("id")
    for day in ("2024-01-01", "2024-01-02"):  # the second run comes a day later, and does all again
        for p in waiting:
            landing.append_raw(p, day)
    raw = spark.read.parquet(landing.zones.raw_base)
    assert raw.count() == raw.select("id").distinct().count() == 30 and raw.where("load_date = '2024-01-01'").count() == 30
    assert landing.latest_watermark("id", "integer") == "29" and landing.latest_watermark("odd", "integer") is None


def test_a_lost_pointer_is_an_error(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "a", "b")
    table.publish(spark.range(3))
    table.storage.delete(f"{table.path}/_CURRENT.json")
    with pytest.raises(FileNotFoundError):
        table.merge(spark.range(1), ["id"], ["id"])


def test_a_merge_rewrites_touched_folders_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "a", "b", spec=["p q", "bucket(2, id)"])
    base = spark.range(40).selectExpr("id", "concat('x y', id % 4) AS `p q`", "0 AS v")
    table.publish(base)
    before = set(table.pointer["folders"])
    change = spark.createDataFrame([(1, "x y1", 5), (100, "x y2", 6), (None, "x y3", 7), (5, "other%", 8)], "id long, `p q` string, v int")
    expected = sorted(map(str, upsert.merge_upsert(base, change, ["id"], order=["v"]).collect()))
    touched = set(table.holding(change, ["id"]))
    table.merge(change, ["id"], ["v"])
    assert 0 < len(touched) < len(before) and before - touched <= set(table.pointer["folders"]) and not touched & set(table.pointer["folders"])
    assert sorted(map(str, table.read().collect())) == expected
    table.roll_back()
    assert table.read().where("v > 0").count() == 0 and table.read().count() == 40


def test_merge_statement():
    found = upsert.merge_statement(["id", "v", "load_date"], "c.n.t", "src", ["id"], target_filter="t.v > 0", newer="v")
    assert found == "MERGE INTO c.n.t t USING src s ON t.`id` = s.`id` AND (t.v > 0) WHEN MATCHED AND (s.`v` >= t.`v` OR t.`v` IS NULL) THEN UPDATE SET t.`v` = s.`v` WHEN NOT MATCHED THEN INSERT (`id`, `v`, `load_date`) VALUES (s.`id`, s.`v`, s.`load_date`)"


def test_integers_beyond_doubles():
    assert whole("9007199254740993") == 9007199254740993 and whole("1e3") == 1000 and whole(7.9) == 7
    assert cut("9007199254740993", "9007199254741001", "integer", 2) == (Slice("9007199254740993", "9007199254740997"), Slice("9007199254740997", "9007199254741001"))


def test_tolerant_counts(spark):
    context = recon.CheckContext(lambda: spark.range(1000), lambda: spark.range(995))
    checks = [{"type": "plain_count", "threshold": {"percent": 1.0, "absolute": 1000}}, {"type": "plain_count"}, {"type": "group_count", "group_by": ["id % 7"]}]
    found = recon.run_checks("t", context, checks)
    assert [r.status for r in found] == ["pass", "fail", "fail"] and found[2].details["differing_groups"] == 5 == len(found[2].details["sample"])


def test_copy_with_names(spark):
    for t in ("named_a", "named_b"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    try:
        spark.range(4).select(F.col("id").alias("ID")).write.saveAsTable("named_a")
        assert copy_with_names(spark, "named_a", "named_b") == 4 and spark.table("named_b").columns == ["id"]
    finally:
        for t in ("named_a", "named_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_options_of_a_backfill_and_of_reloads():
    from tidelake import cli, config, orchestration
    from tidelake.operators.profile import types_match

    tables = [{"schema": "A", "table": "B"}, {"schema": "C", "table": "D"}]
    assert cli.to_reload(None, tables) == set() and cli.to_reload("*", tables) == {"a.b", "c.d"} == cli.to_reload("", tables) and cli.to_reload("a.B", tables) == {"a.b"}
    assert cli.days("2024-03-01", None, None) == ["2024-03-01"] and cli.days("x", "2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    with pytest.raises(config.ConfigError):
        cli.days("x", "2024-02-02", "2024-02-01")
    made = orchestration.plan({"runtime": {"orchestration": {"mode": "temporal", "temporal": {"namespace": "n", "task_queue": "q", "workflow": "w", "schedule": {"cron": "1 * * * *"}}}}}, ("--x",), "r")
    assert made["schedule"] == {"type": "temporal_schedule", "cron": "1 * * * *", "timezone": "UTC"} and made["metadata"]["cron_schedule"] == "1 * * * *" and made["execution_command"][-1] == "--x"
    assert orchestration.plan({"runtime": {"orchestration": {"mode": "airflow", "external": {"cron": "@daily", "retries": 2}}}})["schedule"]["expression"] == "@daily"
    for a, b, lenient, strict in (("NUMBER", "decimal(10,0)", True, True), ("NUMBER(5)", "string", False, False), ("VARCHAR2", "string", True, True), ("DATE", "timestamp", True, False), ("int", "bigint", True, False), ("SDO_GEOMETRY", "geometry", True, False)):
        assert (types_match(a, b), types_match(a, b, True)) == (lenient, strict), (a, b)


def test_marks_of_a_broken_run_come_back(spark, tmp_path):
    from tidelake.operators.state import StateStore
    from tidelake.sources.storage import Outbox

    store = lambda: StateStore(spark, f"{tmp_path}/state", "src", outbox=Outbox(Storage(spark), f"{tmp_path}/outbox"))
    broken = store()
    broken.mark("s", "t", "2024-01-01", "full", "raw", "success", rows_written=3)
    broken.set_progress("s", "t", "7", "2024-01-01")
    again = store()  # the first one never flushed
    assert again.day_status("s", "t", "2024-01-01")["raw"] and again.progress("s", "t") == ("7", "2024-01-01")
    broken.flush()  # and if it did after all, nothing counts twice
    assert again.events().count() == 1 and again.watermarks().count() == 1
    again.preload()
    assert again.day_status("s", "t", "2024-01-01", "full")["raw"] and again.progress("s", "t") == ("7", "2024-01-01")
    again.mark("s", "t", "2024-01-02", "full", "raw", "success")
    assert again.day_status("s", "t", "2024-01-02")["raw"]
