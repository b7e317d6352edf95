"""Relational queries against DuckDB, and loads end to end from a database."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelake import catalog, config, events, orchestration
from tidelake.functions.columns import before_watermark, parse_transform, plain_number
from tidelake.operators import maintenance, profile, recon, upsert
from tidelake.operators.lake import Landing, VersionedTable, Zones, external_table_ddl
from tidelake.operators.state import StateStore
from tidelake.pipeline import Loader, run_tables
from tidelake.plans.query_plan import OrderItem, QueryPlan, QueryResult, SelectItem
from tidelake.plans.slicing import Slice, SlicingPolicy, plan_slices
from tidelake.sources.jdbc import DIALECTS, JdbcTable, in_range
from tidelake.sources.storage import Outbox, Storage
from tidelake.streaming.increment import upsert_available

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    expected = con.sql(catalog.ORACLE[name])
    plain = lambda v: f"{v:.8g}" if isinstance(v, float) else str(v)
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    at = [expected.columns.index(c) for c in columns]
    assert sorted([plain(r[c]) for c in columns] for r in df.collect()) == sorted([plain(r[i]) for i in at] for r in expected.fetchall())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_edges(spark):
    target = spark.createDataFrame([(1, "a", "2024-01-01"), (None, "n", "2024-01-01"), (2, "b", "2024-01-01")], "k int, v string, load_date string")
    source = spark.createDataFrame([(1, "x", "2024-01-02", 5), (1, "y", "2024-01-02", None), (None, "m", "2024-01-02", 1), (3, "c", "2024-01-02", 1)], "k int, v string, load_date string, at int")
    once = upsert.merge_upsert(target, source, ["k"], order=["at"])
    assert rows(once.select("k", "v", "load_date")) == sorted([(1, "x", "2024-01-01"), (None, "n", "2024-01-01"), (None, "m", "2024-01-02"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02")], key=str)
    older = spark.createDataFrame([(1, "old", 4)], "k int, v string, at int")
    assert [r["v"] for r in upsert.merge_upsert(once.where("k = 1"), older, ["k"], newer="at").collect()] == ["x"]
    cold = upsert.merge_upsert(target, source.where("k = 1"), ["k"], order=["at"], target_filter="v <> 'a'")
    assert cold.where("k = 1").count() == 2
    assert upsert.duplicates_by_filter(target, source, ["k"], "v <> 'a'").count() == 1


def test_dedup_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i % 7, 1, str(i)) for i in range(200)], "k int, at int, v string")
    assert rows(upsert.dedup_latest(df.repartition(7), ["k"], ["at"])) == rows(upsert.dedup_latest(df.coalesce(1), ["k"], ["at"]))


def test_slices_and_plans(spark):
    now = datetime(2024, 1, 2)
    assert plan_slices(None, "timestamp", lambda a, b: 0, now, SlicingPolicy()).reason == "incremental_not_supported"
    made = plan_slices("2024-01-01 00:00:00", "timestamp", lambda a, b: 30, now, SlicingPolicy(max_count=10, target_rows=7))
    assert len(made.slices) == 5 and made.slices[0].lower == "2024-01-01 00:00:00" and made.slices[-1].upper == "2024-01-02 00:00:00"
    assert all(a.upper == b.lower for a, b in zip(made.slices, made.slices[1:]))
    millis = plan_slices("0", "epoch_millis", lambda a, b: 1, now, SlicingPolicy())
    assert millis.upper == str(int(now.timestamp() * 1000))
    assert plan_slices("5", "bigint", lambda a, b: 99, now, SlicingPolicy(max_count=1)).slices == (Slice("5", None),)
    df = spark.createDataFrame([(1,), (2,), (3,)], "c long")
    assert rows(in_range(df, "c", Slice("1", "2"), "bigint")) == [(2,)]
    plan = QueryPlan((SelectItem("a"), SelectItem("count(*)", "n")), "t", ("a > 1",), ("a",), ("count(*) > 1",), (OrderItem("n", True),), 5)
    assert plan.to_sql() == "SELECT a, count(*) AS n FROM t WHERE (a > 1) GROUP BY a HAVING (count(*) > 1) ORDER BY n DESC LIMIT 5"
    assert plan.to_sql(limit_style="top").startswith("SELECT TOP (5) a") and plan.to_sql(limit_style="fetch").endswith("FETCH FIRST 5 ROWS ONLY")
    assert QueryResult(({"CNT": 3},)).scalar("cnt") == 3
    with pytest.raises(ValueError):
        QueryResult(({"a": 1, "b": 2},)).scalar()


def test_small_functions():
    assert before_watermark("2024-01-01 00:00:05.123", 5, "timestamp") == "2024-01-01 00:00:00"
    assert before_watermark("3", 5, "epoch_seconds") == "0" and before_watermark("9000", 5, "epoch_millis") == "4000" and before_watermark("x", 0, None) == "x"
    assert parse_transform("bucket(8, c)") == ("bucket", "c", 8) and parse_transform("months(d)") == ("month", "d", None) and parse_transform("odd(c)")[0] == "identity"
    assert plain_number("1E+3") == "1000" and plain_number("x") == ""
    assert DIALECTS["oracle"].literal("2024-01-01 00:00:00", "timestamp") == "TO_TIMESTAMP('2024-01-01 00:00:00', 'YYYY-MM-DD HH24:MI:SS')"
    assert DIALECTS["mssql"].literal("2024-01-01 00:00:00", "timestamp") == "CONVERT(DATETIME2, '2024-01-01T00:00:00', 126)" and DIALECTS["mssql"].literal("7", "int") == "7"


def test_drift_and_guardrail(spark):
    schema = spark.createDataFrame([], "id decimal(10,0), name string").schema
    assert profile.schema_drift({"ID": "NUMBER", "NAME": "VARCHAR2"}, schema) == profile.Drift()
    with pytest.raises(profile.SchemaDriftError):
        profile.schema_drift({"ID": "NUMBER"}, schema, profile.DriftPolicy(allow_new=False))
    assert profile.schema_drift({"ID": "DATE"}, schema).mismatched[0][0] == "id"
    assert upsert.extend_missing(spark.createDataFrame([(1,)], "ID int"), {"id": "int", "NAME": "string"}).columns == ["ID", "NAME"]
    guard = profile.precision_guardrail([{"name": "A", "data_type": "NUMBER", "precision": 40}, {"name": "B", "data_type": "NUMBER", "precision": 9, "statistics": {"max_value": "1" * 39}}, {"name": "C", "data_type": "NUMBER"}])
    assert guard.status == "adjusted" and set(guard.casts) == {"A", "B"}
    assert profile.precision_guardrail([{"name": "C", "data_type": "NUMBER"}], open_action="fail").status == "fatal" and profile.precision_guardrail(None).status == "metadata_missing"
    assert profile.apply_guardrail(spark.createDataFrame([(1,)], "a int"), guard).schema["a"].dataType.simpleString() == "string"


def test_checks(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, g string")
    context = recon.CheckContext(lambda: a, lambda: a.where("k = 1"), ("k",))
    found = recon.run_checks("t", context, [{"type": "plain_count"}, {"type": "plain_count", "threshold": {"absolute": 1, "percent": 50}}, {"type": "group_count", "group_by": ["g"]}, {"type": "pk_uniqueness"}, {"type": "odd"}])
    assert [r.status for r in found] == ["fail", "pass", "fail", "fail", "error"]
    assert recon.summary(found)["fail"] == 3 and recon.exit_code(found, True) == 2 and recon.exit_code(found) == 0
    assert recon.count_status(0, 0, 0, 5) == "pass" and recon.count_status(10, 9, 0, 50) == "fail"
    assert recon.resolve_checks([{"type": "a"}], [{"type": "b", "enabled": False}, {"type": "c"}], ["c"]) == [{"type": "c"}]


@pytest.fixture(scope="module")
def derby(spark):
    connection = {"url": "jdbc:derby:memory:lake;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "dialect": "derby"}
    made = spark.range(1, 101).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 10).alias("EPOCH"), F.concat(F.lit("n"), "id").alias("NAME"))
    made.write.format("jdbc").options(url=connection["url"], driver=connection["driver"], dbtable="T1").mode("overwrite").save()
    return connection


def loader(spark, derby, root, mode, **more):
    c = {"schema": "APP", "table": "T1", "mode": mode, "primary_keys": ["ID"], "incremental_column": "EPOCH", "incr_col_type": "epoch_seconds", "initial_watermark": "0", "scd1_slicing": {"max_count": 10, "target_rows_per_slice": 30}} | more
    landing = Landing(spark, Zones(f"{root}/raw", f"{root}/final", "APP", "T1"), f"{root}/staging")
    made = Loader(spark, c, JdbcTable.of(spark, derby, c), landing, StateStore(spark, f"{root}/state", "s"), "run1", table=VersionedTable(spark, f"{root}/lake", "APP", "T1", ["bucket(4, ID)"]))
    return made


def test_database_reads(spark, derby):
    t = JdbcTable.of(spark, derby, {"schema": "APP", "table": "T1", "incremental_column": "EPOCH", "incr_col_type": "epoch_seconds", "source_filter": ["ID > 5", ""], "cols": "ID, EPOCH", "partition_read": {"partitionColumn": "ID", "lowerBound": 1, "upperBound": 100, "numPartitions": 3}})
    assert t.read_full().count() == 95 and t.read_full().rdd.getNumPartitions() == 3 and t.read_full().columns == ["ID", "EPOCH"]
    assert t.count_between("100", "200") == 10 and t.read_slice(Slice("100", "200")).count() == 10
    assert "PushedFilters" in t.read_slice(Slice("100"))._jdf.queryExecution().toString()
    assert t.execute(QueryPlan((SelectItem("COUNT(1)", "CNT"),), filters=("ID > 90",))).scalar("cnt") == 10


def test_full_refresh(spark, derby, tmp_path):
    made = loader(spark, derby, str(tmp_path), "full")
    first = made.run("2024-01-01")
    assert first["rows"] == 100 and first["finalized"] and spark.read.parquet(first["final"]).count() == 100
    assert made.run("2024-01-01")["reason"] == "finalized"
    assert made.run("2024-01-01", reload=True)["rows"] == 100
    none = loader(spark, derby, str(tmp_path), "full", source_filter="ID > 1000")
    assert none.run("2024-01-02")["skipped"] and spark.read.parquet(first["final"]).count() == 100


def test_increments_and_maintenance(spark, derby, tmp_path):
    made = loader(spark, derby, str(tmp_path), "scd1")
    now = datetime.fromtimestamp(500)
    first = made.run("2024-01-01", now=now)
    assert (first["rows"], first["wm"], first["staged_slices"]) == (50, "500", 2)
    assert made.run("2024-01-01", now=now)["rows"] == 0 and made.table.read().count() == 50
    second = made.run("2024-01-02", now=datetime.fromtimestamp(2000), lag_seconds=100)
    assert second["rows"] == 60 and second["wm"] == "1000"
    table = made.table.read()
    assert table.count() == 100 and table.where("load_date = DATE'2024-01-01'").count() == 50
    settings = {"primary_keys": ["ID"], "incremental_column": "EPOCH", "order": ["load_timestamp"]}
    assert maintenance.run_maintenance(made.landing, made.table, settings)["status"] == "dry_run"
    assert maintenance.run_maintenance(made.landing, made.table, settings, "apply")["status"] == "noop"
    late = spark.createDataFrame([(1, 5, "stale"), (200, 2000, "new")], "ID int, EPOCH long, NAME string").withColumns({"load_timestamp": F.current_timestamp(), "run_id": F.lit("x")})
    made.landing.stage_slice("EPOCH", Slice("a", "b"), late)
    assert maintenance.run_maintenance(made.landing, made.table, settings | {"spec": []}, "apply")["status"] == "applied"
    assert made.table.read().where("NAME = 'stale'").count() == 0 and made.table.read().count() == 101
    again = maintenance.run_all([("t", made.landing, made.table, settings)], "rebuild-from-raw")[0]
    assert again["status"] == "rebuilt" and made.table.read().count() == 100 and "load_date" in made.table.read().columns
    made.table.roll_back()
    assert made.table.read().count() == 101


def test_run_tables_isolates_errors(spark):
    results, errors = run_tables(spark, {"a": lambda: {"rows": spark.range(3).count()}, "b": lambda: 1 / 0})
    assert results == [{"rows": 3}] and errors[0]["table"] == "b"


def test_outbox_and_state(spark, tmp_path):
    box = Outbox(Storage(spark), f"{tmp_path}/out")
    box.put("events", [{"a": 1}, {"a": 2}])
    got = []
    assert box.replay("events", got.extend) == 2 and got == [{"a": 1}, {"a": 2}] and box.replay("events", got.extend) == 0
    state = StateStore(spark, f"{tmp_path}/state", "s")
    bus = events.Bus()
    bus.subscribe(events.state_subscriber(state), "state")
    for status in ("started", "success", "failed"):
        bus.publish(events.Event("state", "state.mark", {"schema": "a", "table": "b", "load_date": "2024-01-01", "mode": "full", "phase": "raw", "status": status, "rows_written": 4, "odd": 1}))
    bus.publish(events.Event("state", "state.watermark", {"schema": "a", "table": "b", "watermark": "7", "last_loaded_date": "2024-01-01"}))
    assert not bus.failures and state.day_status("a", "b", "2024-01-01")["raw"] and state.progress("a", "b") == ("7", "2024-01-01")
    assert state.events().first()["metadata_json"] == '{"odd":1}'


def test_stream(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/lake", "a", "b")
    for part in ([(1, 1)], [(1, 2), (2, 1)]):
        spark.createDataFrame(part, "k int, at int").write.mode("append").parquet(f"{tmp_path}/in")
        upsert_available(spark, f"{tmp_path}/in", "k int, at int", table, ["k"], ["at"], f"{tmp_path}/cp")
    assert rows(table.read()) == [(1, 2), (2, 1)]


def test_config_and_schedule(spark):
    good = {"jdbc": {}, "runtime": {"raw_root": "r", "final_root": "f", "timezone": "UTC"}, "tables": [{"schema": "a", "table": "b", "source_filter": ["x"]}]}
    assert config.validate(good) is good
    for bad in ({"tables": [{"schema": "a", "table": "b", "mode": "scd1"}]}, {"tables": [{"schema": "a", "table": "b", "intermediate": {"partition": {"spec": [{"field": "x", "transform": "bucket"}]}}}]}, {"runtime": {}}):
        with pytest.raises(config.ConfigError):
            config.validate(good | bad)
    made = config.partition_settings({"spec": [{"field": "d", "transform": "month"}]}, {"spec": [{"field": "k", "transform": "bucket:8"}], "derived_columns": [{"name": "m", "expr": "1"}]}, {"expr": "x > 1"})
    assert made == {"spec": ["month(d)", "bucket(8, k)"], "derived": [("m", "1")], "merge_filter": "x > 1"}
    assert orchestration.plan({"runtime": {"timezone": "Asia/Tokyo"}})["schedule"] == {"expression": "0 * * * *", "timezone": "Asia/Tokyo"}
    with pytest.raises(ValueError):
        orchestration.plan({"runtime": {"orchestration": {"mode": "odd"}}})
    assert external_table_ddl("d", "t", spark.createDataFrame([], "a array<int>, b decimal(5,2), load_date date").schema, "/x", "load_date") == "CREATE EXTERNAL TABLE IF NOT EXISTS `d`.`t` (`a` STRING, `b` DECIMAL(5,2)) PARTITIONED BY (`load_date` STRING) STORED AS PARQUET LOCATION '/x'"
