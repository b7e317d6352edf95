"""Catalog snapshots, what keeps them, and the parts of a load around them."""

import json

import pytest
from pyspark.sql import functions as F

from tidelake import events, metadata
from tidelake.operators import recon
from tidelake.operators.lake import VersionedTable, mirror
from tidelake.operators.state import StateStore
from tidelake.sources.storage import Storage


def asker(spark, asked):
    """Answers dictionary queries from hand-made rows, by the view's name."""
    key = "SCHEMA_NAME string, TABLE_NAME string, "
    views = {
        "all_tab_columns": spark.createDataFrame([("HR", "EMP", "NAME", 2, "VARCHAR2", 20, None, None, "Y"), ("HR", "EMP", "ID", 1, "NUMBER", 22, 10, 0, "N"), ("HR", "EMP", "LOST", None, "DATE", 7, None, None, "Y")], key + "NAME string, POSITION int, DATA_TYPE string, LENGTH int, PRECISION int, SCALE int, NULLABLE string"),
        "statistics": spark.createDataFrame([("HR", "EMP", "ID", 107, 0, 0.01, 4, "100", "206")], key + "NAME string, NUM_DISTINCT int, NUM_NULLS int, DENSITY double, AVG_LENGTH int, MIN_VALUE string, MAX_VALUE string"),
        "all_constraints": spark.createDataFrame([("HR", "EMP", "EMP_PK", "P"), ("HR", "EMP", "EMP_CK", "C")], key + "CONSTRAINT_NAME string, CONSTRAINT_TYPE string"),
        "all_cons_columns": spark.createDataFrame([("HR", "EMP", "EMP_PK", "NAME", 2), ("HR", "EMP", "EMP_PK", "ID", 1), ("HR", "EMP", "EMP_CK", "ID", None)], key + "CONSTRAINT_NAME string, NAME string, POSITION int"),
        "all_tables": spark.createDataFrame([("HR", "EMP", 107, "staff")], key + "NUM_ROWS int, COMMENT string"),
    }

    def ask(sql):
        asked.append(sql)
        if "version" in sql:
            raise ValueError("no right to read this")
        return views["statistics"] if "density" in sql else next(v for n, v in views.items() if n in sql)

    return ask


def test_snapshots(spark, tmp_path):
    asked = []
    ask = asker(spark, asked)
    store = metadata.SnapshotStore(Storage(spark), f"{tmp_path}/meta", ttl_hours=1)
    tables = [("HR", "EMP"), ("HR", "GONE")]
    assert metadata.capture(ask, metadata.ORACLE, store, "db", tables, connection="test", now=1000.0) == {"HR.EMP": "produced", "HR.GONE": "missing"}
    last = store.latest("db", "hr", "emp")
    assert [f["name"] for f in last.content["fields"]] == ["ID", "NAME", "LOST"] and last.types["ID"] == "NUMBER"
    assert last.content["fields"][0]["statistics"]["max_value"] == "206" and last.content["fields"][1]["statistics"] is None
    assert last.content["constraints"] == [{"type": "P", "name": "EMP_PK", "columns": ["ID", "NAME"]}] and last.content["num_rows"] == 107
    assert any("'HR'" in q and "'EMP', 'GONE'" in q for q in asked) and sum("version" in q for q in asked) == 2
    assert metadata.capture(ask, metadata.ORACLE, store, "db", tables[:1], connection="test", now=2000.0) == {"HR.EMP": "cached"}
    assert metadata.capture(ask, metadata.ORACLE, store, "db", tables[:1], ("statistics", "constraints", "tables", "columns"), "test", now=9000.0) == {"HR.EMP": "produced"}
    assert [s.version for s in store.history("db", "HR", "EMP")] == [2, 1] and sum("version" in q for q in asked) == 2
    assert store.latest("db", "HR", "EMP").content["constraints"] is None
    assert json.loads((tmp_path / "meta/db/index.json").read_text()) == {"hr.emp": 2}

    def broken(sql):
        raise ValueError("down\nlong story")

    assert metadata.capture(broken, metadata.ORACLE, store, "db", [("X", "Y")], connection="test") == {"X.Y": "error: down"}


def test_queries_by_version():
    d = metadata.Dictionary({"columns": "a"}, (), (("11.", "columns", "b"),))
    assert (d.query("columns", "11.2"), d.query("columns", "19.0"), d.query("columns"), d.query("tables")) == ("b", "a", "a", None)


def test_mirror_and_layout(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/lake", "a", "b", spec=["identity(part)"])
    rows = spark.range(2000).selectExpr("id", "if(id % 10 = 0, 'few', 'hot') AS part", "date'2024-01-01' + cast(id % 2 AS int) AS load_date")
    assert table.publish(rows)["rows"] == 2000
    assert sorted(table.read().columns) == ["id", "load_date", "part"] and table.read().select(F.sum("id")).first()[0] == 1999000
    assert mirror(spark, table, f"{tmp_path}/mirror", "2024-01-02")["rows"] == 1000
    assert mirror(spark, table, f"{tmp_path}/mirror", "2024-01-02")["status"] == "mirrored"
    assert mirror(spark, table, f"{tmp_path}/mirror", "2024-01-09")["status"] == "empty"
    assert spark.read.parquet(f"{tmp_path}/mirror/load_date=2024-01-02").columns == ["id", "part"]


def test_stores_flush_side_by_side(spark, tmp_path):
    stores = [StateStore(spark, f"{tmp_path}/state", "s", flush_every=100, flush_seconds=s) for s in (3600, 0)]
    for s in stores:
        s.mark("a", "b", "2024-01-01", "full", "raw", "success")
    assert [len(s.pending["events"]) for s in stores] == [1, 0]
    stores[0].flush()
    assert stores[1].events().count() == 2


def test_notifier():
    sent = []
    with events.Notifier(sent.append) as notifier:
        bus = events.Bus()
        bus.subscribe(notifier.hear)
        bus.publish(events.Event("a", "a.b", {"n": 1}))
        assert notifier.flush() == 1 and notifier.flush() == 0
        bus.publish(events.Event("a", "a.c", {"n": 2}))
    assert [json.loads(s)["n"] for s in sent] == [1, 2]
    failing = events.Notifier(lambda _: 1 / 0)
    failing.hear(events.Event("a", "a.d", {}))
    with pytest.raises(ZeroDivisionError):
        failing.flush()
    assert len(failing.held) == 1


def test_counts_of_empty_sides(spark):
    one, none = spark.range(3), spark.range(0)
    assert recon.plain_count(one, none).first().asDict() == {"source_count": 3, "target_count": 0, "diff": 3, "percent_diff": 100.0, "status": "fail"}
    assert recon.plain_count(none, none).first()["status"] == "pass"
