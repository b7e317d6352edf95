"""Column profiles, constraint folding, schema drift and the numeric precision guardrail."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType, StructType

from tidelake.functions.columns import digit_count, plain_number

PROFILE_COLUMNS = ("column_name", "rows", "nulls", "distinct_values", "min_value", "max_value", "avg_length", "max_digits")


def column_profile(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """One row for each column: rows, nulls, distinct values, extremes and average length of its text, most digits.

    All columns come from one pass.  Exact distinct counts expand each row once a column; at scale
    ``approximate`` keeps a sketch instead.  Extremes of numbers compare as numbers.
    """
    columns = columns or df.columns
    distinct = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.count_distinct(c))
    aggregates = [F.count("*").alias("_rows")]
    for i, c in enumerate(columns):
        text = F.col(c).cast("string")
        aggregates += [
            F.count(c).alias(f"_n{i}"), distinct(F.col(c)).alias(f"_d{i}"), F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}"),
            F.round(F.avg(F.length(text)), 4).alias(f"_len{i}"), F.max(digit_count(F.col(c))).cast("long").alias(f"_dig{i}"),
        ]
    row = df.agg(*aggregates)
    each = [
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"), F.col(f"_d{i}").alias("distinct_values"), F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"), F.col(f"_len{i}").alias("avg_length"), F.col(f"_dig{i}").alias("max_digits"))
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*each)).alias("p")).select("p.*")


def fold_constraints(rows: DataFrame) -> DataFrame:
    """One row for each constraint from (table_name, constraint_name, constraint_type, column_name, position), columns in order."""
    ordered = F.sort_array(F.collect_list(F.struct("position", "column_name")))
    return rows.groupBy("table_name", "constraint_name", "constraint_type").agg(F.array_join(F.transform(ordered, lambda s: s["column_name"]), ",").alias("columns"))


#: Families of type names, databases' and Spark's.
FAMILIES = {
    "number": "number numeric decimal dec float double real binary_float binary_double int integer bigint smallint tinyint long short byte",
    "text": "char nchar varchar varchar2 nvarchar nvarchar2 clob nclob text ntext string",
    "time": "date datetime datetime2 smalldatetime timestamp timestamp_ntz timestamp_ltz", "binary": "blob raw binary varbinary image", "truth": "boolean bool bit",
}
FAMILY_OF = {name: family for family, names in FAMILIES.items() for name in names.split()}
#: Bits of whole numbers.
WIDTH = {"tinyint": 8, "byte": 8, "smallint": 16, "short": 16, "int": 32, "integer": 32, "bigint": 64, "long": 64}


def types_match(expected: str | None, observed: str | None, strict: bool = False) -> bool:
    """Do two type names belong together?  A missing one goes with all.

    Types of one family do; ``strict`` keeps dates from timestamps and whole numbers of
    different width apart.  A name of no family goes only with itself, or, unless ``strict``, with one that it is part of.
    """
    if not expected or not observed:
        return True
    names = [t.strip().lower() for t in (expected, observed)]
    if names[0] == names[1]:
        return True
    bases = [re.match(r"[a-z0-9_]*", n)[0] for n in names]
    families = {FAMILY_OF.get(b) for b in bases}
    if None in families:
        return not strict and (names[0] in names[1] or names[1] in names[0])
    if strict and (len({WIDTH.get(b) for b in bases}) > 1 or len({b in ("date", "smalldate") for b in bases}) > 1):
        return False
    return len(families) == 1


@dataclass(frozen=True)
class DriftPolicy:
    require_snapshot: bool = False
    allow_new: bool = True
    allow_missing: bool = True
    allow_type_mismatch: bool = True
    warn_only: bool = False
    ignored: tuple[str, ...] = ("load_timestamp", "run_id")

    @classmethod
    def of(cls, config: dict | None) -> DriftPolicy:
        c = config or {}
        pick = lambda *names, default: next((c[n] for n in names if n in c), default)
        ignored = pick("ignored_columns", "ignoredColumns", default=cls.ignored)
        return cls(
            bool(pick("require_snapshot", "requireSnapshot", default=False)), bool(pick("allow_new_columns", "allowNewColumns", default=True)), bool(pick("allow_missing_columns", "allowMissingColumns", default=True)),
            bool(pick("allow_type_mismatch", "allowTypeMismatch", default=True)), bool(pick("warn_only", "warnOnly", default=False)), (ignored,) if isinstance(ignored, str) else tuple(ignored),
        )


class SchemaDriftError(ValueError):
    pass


@dataclass(frozen=True)
class Drift:
    new: tuple[str, ...] = ()
    missing: tuple[str, ...] = ()
    mismatched: tuple[tuple[str, str, str], ...] = ()

    def violations(self, policy: DriftPolicy) -> list[str]:
        found = []
        if self.new and not policy.allow_new:
            found.append(f"new columns {list(self.new)}")
        if self.missing and not policy.allow_missing:
            found.append(f"missing columns {list(self.missing)}")
        if self.mismatched and not policy.allow_type_mismatch:
            found.append(f"changed types {list(self.mismatched)}")
        return found


def schema_drift(snapshot: dict[str, str], schema: StructType, policy: DriftPolicy = DriftPolicy()) -> Drift:
    """New, missing and changed columns of a schema against a snapshot (name to type); names in any case.

    Raises ``SchemaDriftError`` where the policy forbids what was found.
    """
    ignored = {c.lower() for c in policy.ignored}
    expected = {n.lower(): t for n, t in snapshot.items() if n.lower() not in ignored}
    observed = {f.name.lower(): f.dataType.simpleString() for f in schema.fields if f.name.lower() not in ignored}
    drift = Drift(
        tuple(sorted(observed.keys() - expected.keys())), tuple(sorted(expected.keys() - observed.keys())),
        tuple(sorted((n, expected[n], observed[n]) for n in expected.keys() & observed.keys() if not types_match(expected[n], observed[n]))),
    )
    if (why := drift.violations(policy)) and not policy.warn_only:
        raise SchemaDriftError("; ".join(why))
    return drift


def drift_rows(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """(name, status, expected_type, observed_type) of columns that differ, from two (name, type) frames."""
    a = expected.select(F.lower("name").alias("name"), F.col("type").alias("expected_type"))
    b = observed.select(F.lower("name").alias("name"), F.col("type").alias("observed_type"))
    status = F.when(F.col("expected_type").isNull(), "new").when(F.col("observed_type").isNull(), "missing").when(F.lower("expected_type") != F.lower("observed_type"), "type_mismatch")
    return a.join(b, "name", "full_outer").withColumn("status", status).where("status IS NOT NULL").select("name", "status", "expected_type", "observed_type")


NUMBER_TYPES = frozenset({"NUMBER", "NUMERIC", "DECIMAL", "FLOAT", "INTEGER", "INT", "BIGINT", "SMALLINT", "DOUBLE"})


@dataclass(frozen=True)
class Guardrail:
    status: str
    casts: dict[str, tuple] = field(default_factory=dict)
    issues: tuple[dict, ...] = ()


def observed_digits(statistics: dict | None) -> int | None:
    """Most digits among a column's known extremes and lengths."""
    s = statistics or {}
    found = [sum(ch.isdigit() for ch in plain_number(s[k])) for k in ("min_value", "max_value") if s.get(k) is not None]
    found += [int(s[k]) for k in ("min_digits", "max_digits") if s.get(k) is not None]
    return max(found, default=None)


def precision_guardrail(fields: list[dict] | None, max_precision: int | None = None, action: str = "downcast", open_action: str | None = None, fallback: tuple[int, int] | None = None) -> Guardrail:
    """Which numeric columns to read as text because their declared or observed digits pass the limit.

    ``fields``: dictionaries of name, data_type, precision, scale, statistics.  ``action`` and, for
    undeclared precision, ``open_action``: ``fail`` makes such a column fatal.  With ``fallback``
    (precision, scale) an undeclared precision is read as that decimal.
    """
    if fields is None:
        return Guardrail("metadata_missing")
    if not isinstance(fields, list):
        return Guardrail("metadata_unusable")
    limit = max_precision or 38
    refuse = {"declared": (action or "downcast").lower() == "fail"}
    refuse["open"] = (open_action or action or "downcast").lower() == "fail"
    casts, issues = {}, []
    for f in fields:
        name, precision = f.get("name"), f.get("precision")
        if not name or str(f.get("data_type") or "").upper() not in NUMBER_TYPES:
            continue
        digits = {"declared precision": precision, "observed digits": observed_digits(f.get("statistics"))}
        over = [f"{what} {n} of at most {limit}" for what, n in digits.items() if n is not None and int(n) > limit]
        if over:
            issues.append({"column": name, "reason": "; ".join(over), "action": "fail" if refuse["declared"] else "cast_to_string"})
        elif precision is None and (refuse["open"] or fallback):
            issues.append({"column": name, "reason": "no declared precision", "action": "fail" if refuse["open"] else "cast_to_decimal"})
    for i in issues:
        if i["action"] != "fail":
            casts[i["column"]] = () if i["action"] == "cast_to_string" else tuple(fallback)
    fatal = any(i["action"] == "fail" for i in issues)
    return Guardrail("fatal" if fatal else "adjusted" if issues else "ok", casts, tuple(issues))


def apply_guardrail(df: DataFrame, guard: Guardrail) -> DataFrame:
    if guard.status == "fatal":
        raise ValueError("; ".join(f"{i['column']}: {i['reason']}" for i in guard.issues if i["action"] == "fail"))
    casts = {k.lower(): v for k, v in guard.casts.items()}
    return df.select(*(F.col(c) if c.lower() not in casts else F.col(c).cast("string").alias(c) if not casts[c.lower()] else F.col(c).cast(DecimalType(*casts[c.lower()])).alias(c) for c in df.columns))


def snapshot_of(df: DataFrame, profile: bool = False) -> list[dict]:
    """Catalog fields of a frame: name, type, precision, scale, nullability, position, and statistics if asked."""
    stats = {r["column_name"]: r.asDict() for r in column_profile(df, approximate=True).collect()} if profile and df.columns else {}
    out = []
    for i, f in enumerate(df.schema.fields):
        t = f.dataType
        kind = "NUMBER" if isinstance(t, NumericType) else t.simpleString().upper()
        digits = {"byte": 3, "short": 5, "integer": 10, "long": 19}.get(t.typeName())
        out.append({"name": f.name, "data_type": kind, "precision": t.precision if isinstance(t, DecimalType) else digits, "scale": t.scale if isinstance(t, DecimalType) else 0 if digits else None, "nullable": f.nullable, "position": i + 1, "statistics": stats.get(f.name)})
    return out


def join_statistics(fields: DataFrame, statistics: DataFrame) -> DataFrame:
    """Catalog fields with their statistics where there are any, ordered by position and name, nulls last."""
    return fields.join(statistics, "name", "left").orderBy(F.col("position").asc_nulls_last(), "name")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def describe_tables(spark: SparkSession, tables: list[str]) -> DataFrame:
    """(table_name, name, type) of catalog tables."""
    rows = [(t, f.name, f.dataType.simpleString()) for t in tables for f in spark.table(t).schema.fields]
    return spark.createDataFrame(rows, "table_name string, name string, type string")
