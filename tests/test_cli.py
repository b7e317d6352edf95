"""The command line from end to end, on an in-memory database."""

import json

import pytest
from pyspark.sql import functions as F

from tidelake import cli
from tidelake.operators.profile import Guardrail, precision_guardrail
from tidelake.sources.jdbc import DIALECTS, JdbcTable

FIELD = """SELECT 'APP' AS "schema_name", 'T2' AS "table_name", '{0}' AS "name", {1} AS "position", '{2}' AS "data_type", 4 AS "length", CAST({3} AS INTEGER) AS "precision", 0 AS "scale", 'Y' AS "nullable" FROM sysibm.sysdummy1 WHERE 'APP' = {{schema}} AND 'T2' IN ({{tables}})"""


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("cli"))
    db = {"url": "jdbc:derby:memory:cli;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "dialect": "derby"}
    made = spark.range(1, 101).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 10).alias("EPOCH"), F.concat(F.lit("n"), "id").alias("NAME"))
    made.write.format("jdbc").options(url=db["url"], driver=db["driver"], dbtable="T2").mode("overwrite").save()
    keyed = {"schema": "APP", "table": "T2", "mode": "scd1", "primary_keys": ["ID"], "incremental_column": "EPOCH", "incr_col_type": "epoch_seconds", "initial_watermark": "0"}
    fields = (("ID", 1, "INTEGER", "NULL"), ("EPOCH", 2, "BIGINT", "19"), ("NAME", 3, "VARCHAR", "NULL"))
    config = {
        "jdbc": db,
        "runtime": {
            "raw_root": f"{root}/raw", "final_root": f"{root}/final", "timezone": "UTC", "staging": {"root": f"{root}/staging"}, "state_root": f"{root}/state", "notify_path": f"{root}/notes",
            "intermediate": {"enabled": True, "warehouse": f"{root}/lake"}, "final_parquet_mirror": {"enabled": True, "root": f"{root}/mirror"},
            "metadata": {"enabled": True, "cache_path": f"{root}/meta", "queries": {"columns": " UNION ALL ".join(FIELD.format(*f) for f in fields)}, "guardrails": {"fallback": [20, 0]}},
        },
        "reconciliation_defaults": {"checks": [{"type": "plain_count"}, {"type": "pk_uniqueness"}]}, "tables": [keyed],
    }
    full = config | {"tables": [{"schema": "APP", "table": "T2"}], "runtime": config["runtime"] | {"intermediate": {}, "raw_root": f"{root}/raw_full"}}
    paths = []
    for name, c in (("scd1", config), ("full", full)):
        paths.append(f"{root}/{name}.json")
        with open(paths[-1], "w") as f:
            json.dump(c, f)
    return root, paths


def test_increment(spark, setup, capsys):
    root, (scd1, _) = setup
    assert cli.main(["ingest", "--config", scd1, "--load-date", "2024-01-01"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert json.loads(out[-1])["results"][0]["rows"] == 100
    told = {e["event"]: e for e in map(json.loads, out[:-1])}
    assert told["metadata.capture"]["tables"] == {"APP.T2": "produced"} and told["guardrail.precision"]["status"] == "adjusted"
    mirrored = spark.read.parquet(f"{root}/mirror/APP/T2")
    assert mirrored.count() == 100 and dict(mirrored.dtypes)["ID"] == "decimal(20,0)"
    assert spark.read.json(f"{root}/notes").where("event = 'ingest.table.success'").count() == 1
    assert cli.main(["recon", "--config", scd1, "--output-json", f"{root}/found.json", "--fail-on-warn"]) == 0
    with open(f"{root}/found.json") as f:
        assert json.load(f)["summary"]["pass"] == 2
    capsys.readouterr()
    assert cli.main(["ingest", "--config", scd1, "--maintenance-mode", "apply"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])[0]["status"] == "noop"


def test_full_and_log(spark, setup, capsys):
    root, (_, full) = setup
    assert cli.main(["ingest", "--config", full, "--load-date", "2024-01-01", "--only-tables", "app.t2"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert json.loads(lines[-1])["results"][0]["finalized"] and spark.read.parquet(f"{root}/final/T2").count() == 100
    with open(f"{root}/log.jsonl", "w") as f:
        f.write("\n".join([*lines[:-1], "not json"]))
    assert cli.main(["watch", "--log-file", f"{root}/log.jsonl", "--once"]) == 0 and "success" in capsys.readouterr().out
    assert cli.main(["failures", "--log-file", f"{root}/log.jsonl"]) == 0
    assert cli.main(["ingest", "--config", full, "--dump-orchestration-plan"]) == 0


def test_guarded_reads(spark, setup):
    _, (scd1, _) = setup
    with open(scd1) as f:
        t = JdbcTable.of(spark, json.load(f)["jdbc"], {"schema": "APP", "table": "T2", "source_filter": "ID > 90"})
    cast = t.guarded(Guardrail("adjusted", {"id": (12, 2)})).read_full()
    assert dict(cast.dtypes)["ID"] == "decimal(12,2)" and cast.count() == 10
    with pytest.raises(ValueError, match="precision 40"):
        t.guarded(precision_guardrail([{"name": "ID", "data_type": "NUMBER", "precision": 40}], action="fail")).read_full()
    assert DIALECTS["oracle"].as_text("X") == "CAST(X AS VARCHAR2(4000))"
