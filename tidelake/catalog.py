"""All relational queries by name, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.columns import partition_value, watermark_value, with_derived
from tidelake.operators import profile, recon, state, telemetry, upsert
from tidelake.plans.query_plan import OrderItem, QueryPlan, SelectItem, sql_over
from tidelake.plans.slicing import Slice, cut
from tidelake.sources.files import raw_increment
from tidelake.sources.jdbc import in_range

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (tables, ...) under its name; ``tables`` reads a table by name."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_full_projection(t, spark):
    return QueryPlan(tuple(map(SelectItem, ("o_orderkey", "o_custkey", "o_totalprice")))).to_dataframe(t("orders"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE (o_orderstatus <> 'F') AND (o_totalprice > 1000)")
def source_filter_and(t, spark):
    plan = QueryPlan(tuple(map(SelectItem, ("o_orderkey", "o_orderstatus", "o_totalprice"))))
    return plan.with_filter("o_orderstatus <> 'F'").with_filter("").with_filter("o_totalprice > 1000").to_dataframe(t("orders"))


FROM_TS, TO_TS = "2024-01-05 00:00:00", "2024-01-20 12:00:00"


@query(f"SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '{FROM_TS}' AND ts <= TIMESTAMP '{TO_TS}'")
def slice_timestamp_range(t, spark):
    return in_range(t("events"), "ts", Slice(FROM_TS, TO_TS), "timestamp").select("event_id", "ts", "user_id", "event_type", "value")


def _epochs(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("epoch_s"))


@query("WITH e AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s FROM events) SELECT event_id, epoch_s FROM e WHERE epoch_s > 1704500000 AND epoch_s <= 1705500000")
def slice_epoch_range(t, spark):
    return in_range(_epochs(t("events")), "epoch_s", Slice("1704500000", "1705500000"), "epoch_seconds")


@query(f"SELECT COUNT(*) AS cnt FROM events WHERE ts > TIMESTAMP '{FROM_TS}'")
def count_probe(t, spark):
    return in_range(t("events"), "ts", Slice(FROM_TS), "timestamp").agg(F.count("*").alias("cnt"))


PARTS = cut("2024-01-01 00:00:00", "2024-02-01 00:00:00", "timestamp", 7)
_CASES = " ".join(f"WHEN ts > TIMESTAMP '{s.lower}' AND ts <= TIMESTAMP '{s.upper}' THEN {i}" for i, s in enumerate(PARTS))


@query(f"SELECT slice, COUNT(*) AS n FROM (SELECT CASE {_CASES} END AS slice FROM events) WHERE slice IS NOT NULL GROUP BY slice")
def adaptive_slices_counts(t, spark):
    which = F.lit(None).cast("int")
    for i, s in enumerate(PARTS):
        bound = lambda v: F.lit(v).cast("timestamp_ntz")
        which = F.when((F.col("ts") > bound(s.lower)) & (F.col("ts") <= bound(s.upper)), i).otherwise(which)
    return t("events").select(which.alias("slice")).where("slice IS NOT NULL").groupBy("slice").agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS custkey, COUNT(*) AS n, CAST(round(SUM(o_totalprice), 2) AS DOUBLE) AS total FROM orders WHERE (o_orderstatus <> 'F') GROUP BY o_custkey HAVING (COUNT(*) > 3) ORDER BY n DESC, custkey LIMIT 50")
def query_plan_group_having_order_limit(t, spark):
    plan = QueryPlan((SelectItem("o_custkey", "custkey"), SelectItem("count(*)", "n"), SelectItem("round(sum(o_totalprice), 2)", "total")), None, ("o_orderstatus <> 'F'",), ("o_custkey",), ("count(*) > 3",), (OrderItem("n", True), OrderItem("custkey")), 50)
    return plan.to_dataframe(t("orders"))


@query("SELECT l_orderkey, l_linenumber, o_custkey, l_quantity FROM lineitem, orders WHERE l_orderkey = o_orderkey AND o_orderstatus = 'O'")
def query_sql_join(t, spark):
    text = "SELECT l_orderkey, l_linenumber, o_custkey, l_quantity FROM {lineitem}, {orders} WHERE l_orderkey = o_orderkey AND o_orderstatus = 'O'"
    return sql_over(spark, text, lineitem=t("lineitem"), orders=t("orders"))


@query("SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, strftime(ts, '%Y-%m') || '-' || event_type AS month_type FROM events")
def derived_columns(t, spark):
    made = with_derived(t("events"), [("month_start", "cast(date_trunc('month', ts) as timestamp_ntz)"), ("month_type", "date_format(month_start, 'yyyy-MM') || '-' || event_type")])
    return made.select("event_id", "month_start", "month_type")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, strftime(o_orderdate, '%Y-%m') AS m, CAST(o_orderdate AS DATE) AS d, left(o_orderpriority, 3) AS p FROM orders")
def partition_transforms(t, spark):
    return t("orders").select("o_orderkey", partition_value("years(o_orderdate)").alias("y"), partition_value("month(o_orderdate)").alias("m"), partition_value("days(o_orderdate)").alias("d"), partition_value("truncate(3, o_orderpriority)").alias("p"))


@query("SELECT o_custkey, COUNT(*) AS n, CAST(1 AS BIGINT) AS buckets, true AS within FROM orders GROUP BY o_custkey")
def partition_bucket(t, spark):
    """A key's rows all go to one bucket, and buckets are 0 to 15."""
    bucket = partition_value("bucket(16, o_custkey)")
    return t("orders").withColumn("b", bucket).groupBy("o_custkey").agg(F.count("*").alias("n"), F.countDistinct("b").alias("buckets"), F.min(F.col("b").between(0, 15)).alias("within"))


@query("SELECT event_id, ts, user_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r FROM events) WHERE r = 1")
def dedup_latest(t, spark):
    return upsert.dedup_latest(t("events").select("event_id", "ts", "user_id", "event_type"), ["user_id"], ["ts"], ["event_id"])


def _customers(t):
    """A target with a load date, and an increment: every third customer changed, and new ones."""
    c = t("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    target = c.where("c_custkey % 5 <> 0").withColumn("load_date", F.to_date(F.lit("2024-01-01")))
    source = c.where("c_custkey % 3 = 0").select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment").withColumn("load_date", F.to_date(F.lit("2024-01-02")))
    return target, source


_MERGE = """WITH t AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, DATE '2024-01-01' AS load_date FROM customer WHERE c_custkey % 5 <> 0),
s AS (SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal, c_mktsegment, DATE '2024-01-02' AS load_date FROM customer WHERE c_custkey % 3 = 0)
"""


@query(_MERGE + """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment, coalesce(t.load_date, s.load_date) AS load_date FROM t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def merge_upsert(t, spark):
    target, source = _customers(t)
    return upsert.merge_upsert(target, source, ["c_custkey"])


@query(_MERGE + """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment, coalesce(t.load_date, s.load_date) AS load_date
FROM (SELECT * FROM t WHERE c_mktsegment <> 'BUILDING') t FULL JOIN s ON t.c_custkey = s.c_custkey
UNION ALL SELECT * FROM t WHERE c_mktsegment = 'BUILDING'""")
def merge_upsert_target_filter(t, spark):
    target, source = _customers(t)
    return upsert.merge_upsert(target, source, ["c_custkey"], target_filter="c_mktsegment <> 'BUILDING'")


@query(_MERGE + """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NULL THEN t.c_name END AS c_name,
coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment,
coalesce(t.load_date, s.load_date) AS load_date, CASE WHEN s.c_custkey IS NOT NULL THEN 7 END AS grade FROM t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def merge_schema_evolution(t, spark):
    target, source = _customers(t)
    return upsert.merge_upsert(target, source.drop("c_name").withColumns({"grade": F.lit(7), "empty": F.lit(None)}), ["c_custkey"])


@query("SELECT CAST(max(ts) AS VARCHAR) AS watermark, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_loaded_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND ts > TIMESTAMP '2024-01-10 06:00:00'")
def raw_increment_watermark(t, spark):
    raw = t("events").withColumn("load_date", F.to_date("ts"))
    return upsert.new_watermark(raw_increment(raw, "ts", "timestamp", "2024-01-10 06:00:00", "2024-01-10"), "ts", "timestamp")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 3600 SECOND")
def lag_reread(t, spark):
    from tidelake.functions.columns import before_watermark

    return in_range(t("events"), "ts", Slice(before_watermark("2024-01-20 00:00:00", 3600, "timestamp")), "timestamp").select("event_id", "ts")


@query("SELECT event_id, CAST(ts AS DATE) AS load_date, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def mirror_for_date(t, spark):
    return upsert.mirror_for_date(t("events").select("event_id", F.to_date("ts").alias("load_date"), "value"), "2024-01-15")


@query("SELECT DISTINCT user_id, event_type FROM (SELECT user_id, event_type FROM events UNION ALL SELECT user_id, event_type FROM events)")
def rebuild_distinct(t, spark):
    e = t("events").select("user_id", "event_type")
    return upsert.rebuild(e.unionByName(e), [], [])


@query("SELECT event_id, user_id, event_type, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_progress(t, spark):
    return state.latest_progress(t("events").select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], "event_id")


_STATUS = "CASE event_id % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'started' ELSE 'skipped' END"


@query(f"""SELECT user_id, event_type, status, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
ORDER BY CASE status WHEN 'success' THEN 3 WHEN 'failed' THEN 2 WHEN 'started' THEN 1 ELSE 0 END DESC, ts DESC NULLS LAST, event_id DESC) AS r
FROM (SELECT *, {_STATUS} AS status FROM events) WHERE status <> 'skipped') WHERE r = 1""")
def best_status_per_phase(t, spark):
    rows = t("events").select("user_id", "event_type", F.expr(_STATUS).alias("status"), "ts", "event_id")
    return state.best_status(rows, ["user_id", "event_type"], tiebreak=("event_id",)).select("user_id", "event_type", "status", "event_id")


@query("SELECT user_id, max(event_id) AS watermark, arg_max(event_type, event_id) AS last_loaded_date FROM events GROUP BY user_id")
def progress_fallback_agg(t, spark):
    return state.progress_fallback(t("events").select("user_id", F.col("event_id").alias("watermark"), F.col("event_type").alias("last_loaded_date")), ["user_id"])


@query("""SELECT a AS source_count, b AS target_count, abs(a - b) AS diff, round(abs(a - b) / a * 100, 6) AS percent_diff,
CASE WHEN abs(a - b) > 5000 OR abs(a - b) / a * 100 > 10 THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT (SELECT COUNT(*) FROM orders) AS a, (SELECT COUNT(*) FROM orders WHERE o_orderkey % 7 <> 0) AS b)""")
def recon_plain_count(t, spark):
    return recon.plain_count(t("orders"), t("orders").where("o_orderkey % 7 <> 0"), 5000, 10)


@query("""WITH a AS (SELECT nullif(o_orderstatus, 'P') AS key_0, year(o_orderdate) AS key_1, COUNT(*) AS n FROM orders GROUP BY ALL),
b AS (SELECT nullif(o_orderstatus, 'P') AS key_0, year(o_orderdate) AS key_1, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' OR o_orderkey % 11 <> 0 GROUP BY ALL)
SELECT coalesce(a.key_0, b.key_0) AS key_0, CAST(coalesce(a.key_1, b.key_1) AS INTEGER) AS key_1, coalesce(a.n, 0) AS source_count, coalesce(b.n, 0) AS target_count,
coalesce(b.n, 0) - coalesce(a.n, 0) AS difference
FROM a FULL JOIN b ON a.key_0 IS NOT DISTINCT FROM b.key_0 AND a.key_1 IS NOT DISTINCT FROM b.key_1 WHERE coalesce(b.n, 0) <> coalesce(a.n, 0)""")
def recon_group_count(t, spark):
    return recon.group_count(t("orders"), t("orders").where("o_orderstatus = 'F' OR o_orderkey % 11 <> 0"), ["nullif(o_orderstatus, 'P')", "year(o_orderdate)"])


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def recon_pk_uniqueness(t, spark):
    return recon.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


def _profile_sql(table: str, columns: list[str]) -> str:
    one = "SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, COUNT(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, round(avg(length(CAST({c} AS VARCHAR))), 4) AS avg_length, CAST(max(length(regexp_replace(CAST({c} AS VARCHAR), '[^0-9]', '', 'g'))) AS BIGINT) AS max_digits FROM {t}"
    return " UNION ALL ".join(one.format(c=c, t=table) for c in columns)


@query(_profile_sql("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]))
def column_profile(t, spark):
    return profile.column_profile(t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


@query("""SELECT o_orderkey, digits, CASE WHEN digits > 4 THEN CAST(o_custkey AS VARCHAR) END AS as_text FROM
(SELECT o_orderkey, o_custkey, CAST(length(regexp_replace(CAST(o_custkey AS VARCHAR), '[^0-9]', '', 'g')) AS INTEGER) AS digits FROM orders)""")
def numeric_digit_guardrail(t, spark):
    from tidelake.functions.columns import digit_count

    digits = digit_count(F.col("o_custkey"))
    return t("orders").select("o_orderkey", digits.alias("digits"), F.when(digits > 4, F.col("o_custkey").cast("string")).alias("as_text"))


@query("""WITH e(name, type) AS (VALUES ('id', 'bigint'), ('name', 'string'), ('old', 'date')), o(name, type) AS (VALUES ('id', 'int'), ('name', 'string'), ('fresh', 'double'))
SELECT coalesce(e.name, o.name) AS name, CASE WHEN e.name IS NULL THEN 'new' WHEN o.name IS NULL THEN 'missing' ELSE 'type_mismatch' END AS status, e.type AS expected_type, o.type AS observed_type
FROM e FULL JOIN o ON e.name = o.name WHERE e.type IS DISTINCT FROM o.type""")
def schema_drift(t, spark):
    made = lambda rows: spark.createDataFrame(rows, "name string, type string")
    return profile.drift_rows(made([("ID", "bigint"), ("NAME", "string"), ("OLD", "date")]), made([("id", "int"), ("name", "string"), ("fresh", "double")]))


@query("""SELECT 'lineitem' AS table_name, l_returnflag || l_linestatus AS constraint_name, 'P' AS constraint_type, string_agg(CAST(l_shipmonth AS VARCHAR), ',' ORDER BY l_shipmonth) AS columns
FROM (SELECT DISTINCT l_returnflag, l_linestatus, month(l_shipdate) AS l_shipmonth FROM lineitem) GROUP BY l_returnflag, l_linestatus""")
def constraint_fold(t, spark):
    rows = t("lineitem").select(F.lit("lineitem").alias("table_name"), F.concat("l_returnflag", "l_linestatus").alias("constraint_name"), F.lit("P").alias("constraint_type"), F.month("l_shipdate").cast("string").alias("column_name"), F.month("l_shipdate").alias("position")).distinct()
    return profile.fold_constraints(rows)


@query("""SELECT schema_name, table_name, string_agg(name || ':' || data_type || ':' || coalesce(nulls, '-'), ',' ORDER BY position NULLS LAST, name) AS fields, any_value(keys) AS keys FROM
(SELECT n_regionkey AS r, 'S' || n_regionkey AS schema_name, 'T' || n_nationkey % 2 AS table_name, n_name AS name, nullif(n_nationkey % 7, 3) AS position, CASE WHEN n_nationkey % 3 = 0 THEN 'NUMBER' ELSE 'VARCHAR2' END AS data_type,
 CASE WHEN n_nationkey % 4 = 0 THEN CAST(n_nationkey AS VARCHAR) END AS nulls,
 string_agg(n_name, '+') FILTER (n_nationkey % 5 < 3) OVER (PARTITION BY n_regionkey, n_nationkey % 2 ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keys FROM nation)
GROUP BY schema_name, table_name""")
def catalog_snapshot(t, spark):
    from tidelake import metadata

    key = [F.concat(F.lit("S"), "n_regionkey").alias("schema_name"), F.concat(F.lit("T"), F.col("n_nationkey") % 2).alias("table_name")]
    n, name = t("nation"), F.col("n_name").alias("name")
    none = F.lit(None).cast("string")
    columns = n.select(*key, name, F.expr("nullif(n_nationkey % 7, 3)").alias("position"), F.expr("if(n_nationkey % 3 = 0, 'NUMBER', 'VARCHAR2')").alias("data_type"), *(none.alias(c) for c in ("length", "precision", "scale", "nullable")))
    statistics = n.where("n_nationkey % 4 = 0").select(*key, name, F.col("n_nationkey").alias("num_nulls"), *(none.alias(c) for c in ("num_distinct", "density", "avg_length", "min_value", "max_value")))
    parts = n.where("n_nationkey % 5 < 3").select(*key, F.lit("PK").alias("constraint_name"), name, F.col("n_nationkey").alias("position"))
    constraints = parts.select("schema_name", "table_name", "constraint_name", F.lit("P").alias("constraint_type")).distinct()
    made = metadata.catalog_snapshot({"columns": columns, "statistics": statistics, "constraints": constraints, "constraint_columns": parts})
    field = lambda f: F.concat_ws(":", f["name"], f["data_type"], F.coalesce(f["statistics"]["num_nulls"], F.lit("-")))
    return made.select("schema_name", "table_name", F.array_join(F.transform("fields", field), ",").alias("fields"), F.array_join(F.get("constraints", F.lit(0))["columns"], "+").alias("keys"))


@query("SELECT event_type, COUNT(*) AS failures, min(ts) AS first_seen, string_agg(DISTINCT CAST(user_id % 10 AS VARCHAR), ',' ORDER BY CAST(user_id % 10 AS VARCHAR)) AS tables FROM events WHERE value < 10 GROUP BY event_type")
def failure_summary(t, spark):
    return telemetry.failure_summary(t("events").where("value < 10").withColumn("shard", F.col("user_id") % 10), ["event_type"], "ts", "shard")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_status, COUNT(*) AS events FROM events GROUP BY user_id")
def progress_latest_status(t, spark):
    return telemetry.latest_status(t("events"), ["user_id"], "event_type", ["ts", "event_id"])


@query()
def progress_totals(t, spark):
    rows = t("events").select(F.expr(_STATUS).alias("status"), F.col("event_id").alias("rows"))
    return telemetry.totals(rows)


ORACLE["progress_totals"] = f"SELECT count(*) FILTER (status = 'success') AS completed, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'failed') AS failed, CAST(sum(event_id) AS BIGINT) AS rows FROM (SELECT {_STATUS} AS status, event_id FROM events)"


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(length(props) AS INTEGER) AS json_chars FROM events")
def metadata_json_split(t, spark):
    return t("events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").alias("json_chars"))


@query("SELECT user_id, CAST(max(epoch_us(ts) // 1000) AS VARCHAR) AS watermark FROM events GROUP BY user_id")
def epoch_watermarks(t, spark):
    millis = t("events").select("user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return millis.groupBy("user_id").agg(F.max(watermark_value("ms", "epoch_millis")).cast("string").alias("watermark"))
