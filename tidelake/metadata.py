"""Catalog snapshots: a database's dictionary as nested rows, one for each table, kept as versions that age.

Joins and folds run in Spark over dictionary frames of fixed column names (below); the
driver sees one row for each configured table.  A database is described by the queries
that give those frames, so another database is another ``Dictionary``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.events import plain
from tidelake.functions.names import text_literal
from tidelake.sources.storage import Storage

TABLE_KEY = ("schema_name", "table_name")
#: What each section's frame must hold beside the table's key.
SECTIONS = {
    "columns": ("name", "position", "data_type", "length", "precision", "scale", "nullable"),
    "statistics": ("name", "num_distinct", "num_nulls", "density", "avg_length", "min_value", "max_value"),
    "constraints": ("constraint_name", "constraint_type"),
    "constraint_columns": ("constraint_name", "name", "position"),
    "tables": ("num_rows", "comment"),
}
NEEDED = ("columns",)
KEPT_CONSTRAINTS = ("P", "R", "U")


@dataclass(frozen=True)
class Dictionary:
    """The queries of a database's dictionary; ``{schema}`` and ``{tables}`` stand for literals.

    ``probes``: queries for the database's version, asked in order until one answers.  ``by_version``:
    (version prefix, section, query) that take the place of a section's query.
    """

    queries: dict[str, str]
    probes: tuple[str, ...] = ()
    by_version: tuple[tuple[str, str, str], ...] = ()

    def query(self, section: str, version: str | None = None) -> str | None:
        found = self.queries.get(section)
        for prefix, name, query in self.by_version:
            if name == section and version and version.startswith(prefix):
                found = query
        return found


ORACLE = Dictionary(
    {
        "columns": "SELECT owner AS schema_name, table_name, column_name AS name, column_id AS position, data_type, data_length AS length, data_precision AS precision, data_scale AS scale, nullable FROM all_tab_columns WHERE owner = {schema} AND table_name IN ({tables})",
        "statistics": "SELECT owner AS schema_name, table_name, column_name AS name, num_distinct, num_nulls, density, avg_col_len AS avg_length, CASE WHEN data_type = 'NUMBER' THEN TO_CHAR(UTL_RAW.CAST_TO_NUMBER(low_value)) END AS min_value, CASE WHEN data_type = 'NUMBER' THEN TO_CHAR(UTL_RAW.CAST_TO_NUMBER(high_value)) END AS max_value FROM all_tab_columns WHERE owner = {schema} AND table_name IN ({tables})",
        "constraints": "SELECT owner AS schema_name, table_name, constraint_name, constraint_type FROM all_constraints WHERE owner = {schema} AND table_name IN ({tables})",
        "constraint_columns": "SELECT owner AS schema_name, table_name, constraint_name, column_name AS name, position FROM all_cons_columns WHERE owner = {schema} AND table_name IN ({tables})",
        "tables": "SELECT t.owner AS schema_name, t.table_name, t.num_rows, c.comments AS \"COMMENT\" FROM all_tables t LEFT JOIN all_tab_comments c ON c.owner = t.owner AND c.table_name = t.table_name WHERE t.owner = {schema} AND t.table_name IN ({tables})",
    },
    ("SELECT version FROM product_component_version WHERE ROWNUM = 1", "SELECT version FROM v$instance"),
)
MSSQL = Dictionary(
    {
        "columns": "SELECT table_schema AS schema_name, table_name, column_name AS name, ordinal_position AS position, data_type, character_maximum_length AS length, numeric_precision AS precision, numeric_scale AS scale, is_nullable AS nullable FROM information_schema.columns WHERE table_schema = {schema} AND table_name IN ({tables})",
        "constraints": "SELECT table_schema AS schema_name, table_name, constraint_name, CASE constraint_type WHEN 'PRIMARY KEY' THEN 'P' WHEN 'UNIQUE' THEN 'U' WHEN 'FOREIGN KEY' THEN 'R' ELSE 'C' END AS constraint_type FROM information_schema.table_constraints WHERE table_schema = {schema} AND table_name IN ({tables})",
        "constraint_columns": "SELECT table_schema AS schema_name, table_name, constraint_name, column_name AS name, ordinal_position AS position FROM information_schema.key_column_usage WHERE table_schema = {schema} AND table_name IN ({tables})",
    },
    ("SELECT CAST(SERVERPROPERTY('ProductVersion') AS VARCHAR(64)) AS version",),
)
DICTIONARIES = {"oracle": ORACLE, "mssql": MSSQL}

#: Versions by connection, so that a process asks each database once.
_versions: dict[str, str | None] = {}


def version_of(ask: Callable[[str], DataFrame], dictionary: Dictionary, connection: str = "") -> str | None:
    """The first answer among the probes; None if none answers."""
    if connection not in _versions:
        _versions[connection] = None
        for probe in dictionary.probes:
            try:
                row = ask(probe).first()
            except Exception:  # noqa: BLE001  no right to read that view: the next one
                continue
            if row is not None and row[0] is not None:
                _versions[connection] = str(row[0])
                break
    return _versions[connection]


def jdbc_asker(spark: SparkSession, options: dict[str, str]) -> Callable[[str], DataFrame]:
    return lambda sql: spark.read.format("jdbc").options(**options).option("query", sql).load()


def read_sections(ask: Callable[[str], DataFrame], dictionary: Dictionary, schema: str, tables: Iterable[str], skip: tuple[str, ...] = (), version: str | None = None) -> dict[str, DataFrame]:
    """The dictionary's frames for some tables, without the sections to skip (columns are always there)."""
    listed = ", ".join(text_literal(t) for t in tables)
    found = {}
    for section in SECTIONS:
        query = dictionary.query(section, version)
        if query and (section in NEEDED or section not in skip):
            df = ask(query.replace("{schema}", text_literal(schema)).replace("{tables}", listed))
            # databases pad fixed-width text
            found[section] = df.select(*((F.rtrim(c) if t == "string" else F.col(c)).alias(c.lower()) for c, t in df.dtypes))
    return found


def catalog_snapshot(sections: dict[str, DataFrame]) -> DataFrame:
    """(schema_name, table_name, fields, constraints, num_rows, comment), a row for each table that has columns.

    Fields are ordered by position, nulls last, then name, and carry their statistics where there are
    any; constraints are primary, foreign and unique keys with their columns in order.
    """
    columns, key = sections["columns"], list(TABLE_KEY)
    stat_names = [c for c in SECTIONS["statistics"] if c != "name"]
    if (statistics := sections.get("statistics")) is not None:
        per = statistics.groupBy(*key, "name").agg(F.first(F.struct(*(F.col(c).cast("string").alias(c) for c in stat_names))).alias("statistics"))
        columns = columns.join(per, [*key, "name"], "left")
    else:
        columns = columns.withColumn("statistics", F.lit(None).cast("struct<" + ",".join(f"{c}:string" for c in stat_names) + ">"))
    one = F.struct(F.col("position").isNull().alias("_last"), F.col("position").cast("int").alias("position"), F.col("name"), *(F.col(c).cast("string" if c in ("data_type", "nullable") else "int").alias(c) for c in SECTIONS["columns"] if c not in ("name", "position")), F.col("statistics"))
    fields = F.transform(F.sort_array(F.collect_list(one)), lambda f: f.dropFields("_last"))
    out = columns.groupBy(*key).agg(fields.alias("fields"))
    if "constraints" in sections and "constraint_columns" in sections:
        kept = sections["constraints"].where(F.col("constraint_type").isin(*KEPT_CONSTRAINTS)).select(*key, "constraint_name", "constraint_type")
        parts = sections["constraint_columns"].select(*key, "constraint_name", "name", F.col("position").cast("int").alias("position"))
        each = kept.join(parts, [*key, "constraint_name"]).groupBy(*key, "constraint_name", "constraint_type").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "name"))), lambda p: p["name"]).alias("columns"))
        all_ = each.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col("constraint_type").alias("type"), F.col("constraint_name").alias("name"), "columns"))).alias("constraints"))
        out = out.join(all_, key, "left")
    else:
        out = out.withColumn("constraints", F.lit(None).cast("array<struct<type:string,name:string,columns:array<string>>>"))
    if "tables" in sections:
        return out.join(sections["tables"].select(*key, F.col("num_rows").cast("long").alias("num_rows"), F.col("comment").cast("string").alias("comment")), key, "left")
    return out.withColumns({"num_rows": F.lit(None).cast("long"), "comment": F.lit(None).cast("string")})


@dataclass(frozen=True)
class Snapshot:
    source: str
    schema: str
    table: str
    version: int
    at: float
    content: dict = field(default_factory=dict)

    @property
    def types(self) -> dict[str, str]:
        """Name to type, as the drift check takes it."""
        return {f["name"]: f["data_type"] for f in self.content.get("fields") or []}


class SnapshotStore:
    """Versions of snapshots as JSON files under ``root/source/schema/table``, and an index of the newest ones."""

    def __init__(self, storage: Storage, root: str, ttl_hours: float = 24):
        self.storage, self.root, self.ttl = storage, root.rstrip("/"), 3600 * ttl_hours

    def _folder(self, source: str, schema: str, table: str) -> str:
        return "/".join([self.root, source, schema.lower(), table.lower()])

    def _versions(self, folder: str) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.storage.names(folder) if n.startswith("v") and n.endswith(".json"))

    def put(self, source: str, schema: str, table: str, content: dict, now: float | None = None) -> Snapshot:
        folder = self._folder(source, schema, table)
        version = max(self._versions(folder), default=0) + 1
        made = Snapshot(source, schema, table, version, now or time.time(), plain(content))
        self.storage.write_json(f"{folder}/v{version:06d}.json", made.__dict__)
        return made

    def history(self, source: str, schema: str, table: str) -> list[Snapshot]:
        """All versions, the newest first."""
        folder = self._folder(source, schema, table)
        return [Snapshot(**self.storage.read_json(f"{folder}/v{v:06d}.json")) for v in reversed(self._versions(folder))]

    def latest(self, source: str, schema: str, table: str) -> Snapshot | None:
        folder = self._folder(source, schema, table)
        found = self._versions(folder)
        return Snapshot(**self.storage.read_json(f"{folder}/v{found[-1]:06d}.json")) if found else None

    def fresh(self, source: str, schema: str, table: str, now: float | None = None) -> bool:
        last = self.latest(source, schema, table)
        return last is not None and (now or time.time()) - last.at < self.ttl

    def write_index(self, source: str) -> dict:
        """The newest version of every table of a source, written as one file that takes the old one's place."""
        index = {}
        for schema in self.storage.names(f"{self.root}/{source}"):
            for table in self.storage.names(f"{self.root}/{source}/{schema}") if not schema.endswith(".json") else ():
                found = self._versions(f"{self.root}/{source}/{schema}/{table}")
                index |= {f"{schema}.{table}": found[-1]} if found else {}
        self.storage.write_json(f"{self.root}/{source}/index.json", index)
        return index


def capture(ask: Callable[[str], DataFrame], dictionary: Dictionary, store: SnapshotStore, source: str, tables: Iterable[tuple[str, str]], skip: tuple[str, ...] = (), connection: str = "", now: float | None = None) -> dict[str, str]:
    """Snapshots of those (schema, table) whose last one has aged; each table's status: cached, produced, missing or error."""
    status, wanted = {}, {}
    for schema, table in tables:
        if store.fresh(source, schema, table, now):
            status[f"{schema}.{table}"] = "cached"
        else:
            wanted.setdefault(schema, []).append(table)
    version = version_of(ask, dictionary, connection) if wanted else None
    for schema, names in wanted.items():
        try:
            rows = catalog_snapshot(read_sections(ask, dictionary, schema, names, skip, version)).collect()  # one for each asked table
        except Exception as e:  # noqa: BLE001  one schema's error doesn't stop the others
            status |= {f"{schema}.{t}": f"error: {str(e).splitlines()[0]}" for t in names}
            continue
        found = {r["table_name"].lower(): r.asDict(recursive=True) for r in rows}
        for table in names:
            if table.lower() in found:
                store.put(source, schema, table, found[table.lower()], now)
            status[f"{schema}.{table}"] = "produced" if table.lower() in found else "missing"
    if wanted:
        store.write_index(source)
    return status
