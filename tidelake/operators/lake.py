"""The lake: raw and final zones, staged slices, versioned tables, publication.

A table is a folder of versions and a pointer file; a writer makes a new version
and then moves the pointer, so readers never see half a table and a path is
never overwritten while it is read.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.functions.columns import parse_transform, partition_name, partition_value, watermark_value
from tidelake.functions.names import qualified, table_identifier
from tidelake.operators import upsert
from tidelake.plans.slicing import Slice
from tidelake.sources import files
from tidelake.sources.storage import Storage


@dataclass(frozen=True)
class Zones:
    """Where a source table's files go."""

    raw_root: str
    final_root: str
    schema: str
    table: str
    append_schema: bool = False

    def _under(self, root: str) -> str:
        return "/".join([root.rstrip("/"), *([self.schema] if self.append_schema else []), self.table])

    @property
    def raw_base(self) -> str:
        return self._under(self.raw_root)

    def raw(self, load_date: str) -> str:
        return f"{self.raw_base}/load_date={load_date}"

    @property
    def final(self) -> str:
        return self._under(self.final_root)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", format_: str = "parquet", compression: str = "snappy", watermark: str | None = None) -> dict:
    """Write once, and learn the row count (and the watermark column's greatest value) from the same job."""
    seen = Observation(f"write-{uuid.uuid4().hex}")
    wanted = [F.count(F.lit(1)).alias("rows"), *([F.max(watermark).cast("string").alias("watermark")] if watermark else [])]
    df.observe(seen, *wanted).write.mode(mode).format(format_).option("compression", compression).save(path)
    return {"rows": 0} | {k: v for k, v in seen.get.items() if k == "watermark" or v is not None}


class Landing:
    """Raw writes, staged slices and final publication of one source table."""

    def __init__(self, spark: SparkSession, zones: Zones, staging_root: str | None = None, format_: str = "parquet", compression: str = "snappy"):
        self.spark, self.zones, self.staging_root = spark, zones, (staging_root or "").rstrip("/")
        self.storage, self.format, self.compression = Storage(spark), format_, compression

    def write_raw(self, df: DataFrame, load_date: str) -> dict:
        """Put rows in place of a day's raw folder; an empty frame leaves the folder as it is, writes metrics and reports ``skipped``."""
        path = self.zones.raw(load_date)
        beside = f"{self.zones.raw_base}/_incoming-{uuid.uuid4().hex}"
        found = write_counted(df, beside, format_=self.format, compression=self.compression)
        if found["rows"]:
            self.storage.swap(beside, path)
        else:
            self.storage.delete(beside)
        self.storage.write_json(f"{self.zones.raw_base}/_METRICS-{load_date}.json", found)
        return {"status": "written" if found["rows"] else "skipped", "location": path} | found

    def append_raw(self, staged: str, load_date: str) -> str:
        """Add one staged slice's rows to a day's raw folder; a second time changes nothing, even after a crash on another day.

        The day is noted in the slice first, and the files bear the slice's name, so those of a broken run are replaced.
        """
        day = (self.storage.read_json(f"{staged}/_RAW.json") or {}).get("load_date") or load_date
        self.storage.write_json(f"{staged}/_RAW.json", {"load_date": day})
        name, target = staged.rsplit("/", 1)[-1], self.zones.raw(day)
        beside = f"{self.zones.raw_base}/_incoming-{name}"
        self.storage.delete(beside)
        files.slices(self.spark, [staged], self.format).write.format(self.format).option("compression", self.compression).save(beside)
        for old in self.storage.names(target):
            if old.startswith(f"{name}-"):
                self.storage.delete(f"{target}/{old}")
        for part in self.storage.names(beside):
            if part.startswith("part-"):
                self.storage.rename(f"{beside}/{part}", f"{target}/{name}-{part}")
        self.storage.delete(beside)
        return day

    def finalize(self, load_date: str) -> str:
        """Copy a day's raw rows to the final folder; the old one stands aside until the new one is in place."""
        final, fresh = self.zones.final, f"{self.zones.final}__new"
        self.storage.recover(final)
        self.storage.delete(fresh)
        self.spark.read.format(self.format).load(self.zones.raw(load_date)).write.format(self.format).option("compression", self.compression).save(fresh)
        self.storage.swap(fresh, final)
        return final

    def latest_watermark(self, column: str, kind: str | None) -> str | None:
        """The greatest value of a column over all raw days; None where there are none, or no such column."""
        if not self.storage.exists(self.zones.raw_base):
            return None
        raw = files.raw_base(self.spark, self.zones.raw_base, self.format)
        return files.scalar(raw.agg(F.max(watermark_value(column, kind)).cast("string"))) if column in raw.columns else None

    # staged slices

    def slices_dir(self, column: str) -> str:
        z = self.zones
        return f"{self.staging_root}/{z.schema}/{z.table}/inc={column}/slices"

    def slice_path(self, column: str, part: Slice) -> str:
        return f"{self.slices_dir(column)}/{hashlib.sha1(f'{part.lower}|{part.upper}'.encode()).hexdigest()[:16]}"

    def stage_slice(self, column: str, part: Slice, df: DataFrame) -> dict:
        """Write one slice once: a slice that is staged or landed already is not read again."""
        path = self.slice_path(column, part)
        if self.storage.exists(f"{path}/_STAGED"):
            return {"status": "skipped", "path": path}
        found = write_counted(df, path, format_=self.format, compression=self.compression)
        self.storage.write_json(f"{path}/_RANGE.json", {"lower": part.lower, "upper": part.upper, **found})
        self.storage.write_text(f"{path}/_STAGED", "")
        return {"status": "staged", "path": path} | found

    def pending_slices(self, column: str) -> list[str]:
        base = self.slices_dir(column)
        paths = [f"{base}/{n}" for n in self.storage.names(base)]
        return [p for p in paths if self.storage.exists(f"{p}/_STAGED") and not self.storage.exists(f"{p}/_LANDED")]

    def mark_landed(self, paths: list[str]) -> None:
        for p in paths:
            self.storage.write_text(f"{p}/_LANDED", "")

    def clean_slices(self, column: str, ttl_hours: float = 72, now: float | None = None) -> list[str]:
        """Delete landed slices that are older; the paths that went."""
        base, gone, now = self.slices_dir(column), [], now or time.time()
        for name in self.storage.names(base):
            mark = f"{base}/{name}/_LANDED"
            if self.storage.exists(mark) and now - self.storage.modified(mark) > 3600 * ttl_hours:
                self.storage.delete(f"{base}/{name}")
                gone.append(f"{base}/{name}")
        return gone


class VersionedTable:
    """A keyed table of parquet folders with a pointer to the current ones.

    A version adds its own folders (one for each partition); the pointer lists all that
    the table consists of, so a merge rewrites only those that hold matched keys.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, table: str, spec: list[str] | None = None):
        self.spark, self.storage = spark, Storage(spark)
        self.path = f"{root.rstrip('/')}/{table_identifier(schema, table)}"
        self.spec = spec

    @property
    def pointer(self) -> dict | None:
        found = self.storage.read_json(f"{self.path}/_CURRENT.json")
        if found is None and any(n.startswith("v-") for n in self.storage.names(self.path)):
            raise FileNotFoundError(f"{self.path} has versions, but no pointer to the current one")
        return found

    def exists(self) -> bool:
        return self.pointer is not None

    def partition_spec(self) -> list[str]:
        return self.spec if self.spec is not None else (self.pointer or {}).get("spec", [])

    def read(self, folders: list[str] | None = None) -> DataFrame:
        """The current rows, or those of some of the table's folders."""
        p = self.pointer
        if p is None:
            raise FileNotFoundError(self.path)
        schema = StructType.fromJson(p["schema"])
        where = [f"{self.path}/{f}" for f in (p["folders"] if folders is None else folders)]
        return self.spark.read.schema(schema).parquet(*where) if where else self.spark.createDataFrame([], schema)

    def _leaves(self, folder: str) -> list[str]:
        """Folders of files under one of the table's folders."""
        names = self.storage.names(f"{self.path}/{folder}")
        inner = [n for n in names if "=" in n and not n.startswith(".")]
        return [x for n in inner for x in self._leaves(f"{folder}/{n}")] or ([folder] if any(n.startswith("part-") for n in names) else [])

    def publish(self, df: DataFrame, keep: int = 1, beside: list[str] | None = None) -> dict:
        """A new version from ``df`` and, if given, the folders ``beside`` it; then the pointer moves, and all but ``keep`` older versions go."""
        before, spec = self.pointer, self.partition_spec()
        version, columns = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:6]}", df.columns
        made = {partition_name(s): partition_value(s) for s in spec}
        names = [n if n not in columns else f"_p_{n}" for n in made]
        laid = df.withColumns(dict(zip(names, made.values()))) if made else df
        if names:
            laid = laid.hint("rebalance", *(f"`{n}`" for n in names))  # a partition's rows meet, but AQE splits one that is too large for a task
        seen = Observation(f"publish-{version}")
        writer = laid.observe(seen, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(*names) if names else writer).parquet(f"{self.path}/{version}")
        found = {"version": version, "spec": spec, "columns": columns, "schema": df.schema.jsonValue(), "folders": [*(beside or []), *self._leaves(version)], "written": seen.get.get("rows", 0)}
        older = [{k: v for k, v in b.items() if k != "older"} for b in ([before, *before.get("older", [])] if before else [])][:keep]
        self.storage.write_json(f"{self.path}/_CURRENT.json", found | {"older": older})
        used = {f for v in (found, *older) for f in v["folders"]}
        for name in self.storage.names(self.path):
            if name.startswith("v-") and name != version and not any(f.split("/")[0] == name for f in used):
                self.storage.delete(f"{self.path}/{name}")
        return found | {"rows": found["written"]}

    def holding(self, source: DataFrame, keys: list[str]) -> list[str]:
        """The table's folders that hold a key of ``source``; only the keys are read."""
        named = self.read().select(*keys, F.col("_metadata.file_path").alias("_file"))
        found = named.join(source.select(*keys), keys, "left_semi").select(F.regexp_extract("_file", r"/(v-[0-9]+-[0-9a-f]+(?:/[^/]+)*)/[^/]+$", 1).alias("f")).distinct()
        return [unquote(r["f"]) for r in found.collect()]  # bounded by the table's folders

    def merge(self, source: DataFrame, keys: list[str], order: list[str], target_filter: str | None = None, newer: str | None = None) -> dict:
        """Upsert a deduplicated source; a table that isn't there yet is made from it.

        Folders without a matched key stay as they are, and new rows go beside them.
        """
        if not self.exists():
            return self.publish(upsert.dedup_latest(source, keys, order))
        touched = set(self.holding(source, keys))
        merged = upsert.merge_upsert(self.read(sorted(touched)), source, keys, target_filter=target_filter, order=order, newer=newer)
        return self.publish(merged, beside=[f for f in self.pointer["folders"] if f not in touched])

    def roll_back(self) -> None:
        """Back to the version before, if it is still there."""
        p = self.pointer
        if not p or not p.get("older"):
            raise FileNotFoundError("no version to go back to")
        before, *older = p["older"]
        self.storage.write_json(f"{self.path}/_CURRENT.json", before | {"older": older})


class CatalogTable:
    """A table of a catalog whose format has ``MERGE``; it is made from the first increment, with its partitions."""

    def __init__(self, spark: SparkSession, name: str, format_: str, spec: list[str] | None = None):
        self.spark, self.name, self.format, self.spec = spark, name, format_, spec or []

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def partition_spec(self) -> list[str]:
        return self.spec

    def ensure(self, df: DataFrame) -> None:
        """Namespace and table, if they aren't there."""
        if "." in self.name:
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {'.'.join(qualified(p) for p in self.name.split('.')[:-1])}")
        if not self.exists():
            writer = df.limit(0).writeTo(self.name).using(self.format)
            (writer.partitionedBy(*(F.expr(s) if "(" not in s else catalog_transform(s) for s in self.spec)) if self.spec else writer).create()

    def merge(self, source: DataFrame, keys: list[str], order: list[str], target_filter: str | None = None, newer: str | None = None) -> dict:
        latest = upsert.dedup_latest(source, keys, order)
        self.ensure(latest)
        upsert.merge_into(latest, self.name, keys, target_filter=target_filter, newer=newer)
        return {"table": self.name}


def catalog_transform(spec: str):
    """A partition transform as catalogs have it."""
    name, column, number = parse_transform(spec)
    of = {"year": F.partitioning.years, "month": F.partitioning.months, "day": F.partitioning.days}
    if name.rstrip("s") in of:
        return of[name.rstrip("s")](column)
    return F.partitioning.bucket(number, column) if name == "bucket" else F.expr(spec)


def set_up_catalog(spark: SparkSession, name: str, settings: dict[str, str]) -> None:
    """Name a catalog's implementation and options in the session; what is set already stays."""
    for key, value in {"": settings.get("implementation"), **{f".{k}": v for k, v in settings.items() if k != "implementation"}}.items():
        if value is not None and spark.conf.get(f"spark.sql.catalog.{name}{key}", None) is None:
            spark.conf.set(f"spark.sql.catalog.{name}{key}", value)


def mirror(spark: SparkSession, table: VersionedTable, root: str, day: str, column: str = "load_date", hive: dict | None = None) -> dict:
    """Write a table's rows of one day as a plain parquet partition, and register it if ``hive`` (db, name, use_msck) says so."""
    path = f"{root.rstrip('/')}/{column}={day}"
    found = write_counted(upsert.mirror_for_date(table.read(), day, column).drop(column), path)
    if hive and found["rows"]:
        register_external(spark, hive["db"], hive["name"], root, column)
        add_partition(spark, hive["db"], hive["name"], column, day, path, bool(hive.get("use_msck")))
    return {"status": "mirrored" if found["rows"] else "empty", "location": path} | found


# Hive registration

HIVE = {"byte": "TINYINT", "short": "SMALLINT", "integer": "INT", "long": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "binary": "BINARY", "boolean": "BOOLEAN", "string": "STRING", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def hive_type(data_type) -> str:
    """Nested and unknown types are registered as text."""
    name = data_type.typeName()
    return f"DECIMAL({data_type.precision},{data_type.scale})" if name == "decimal" else HIVE.get(name, "STRING")


def external_table_ddl(db: str, name: str, df_schema, location: str, partition: str | None = None) -> str:
    columns = ", ".join(f"{qualified(f.name)} {hive_type(f.dataType)}" for f in df_schema.fields if f.name != partition)
    by = f" PARTITIONED BY ({qualified(partition)} STRING)" if partition else ""
    return f"CREATE EXTERNAL TABLE IF NOT EXISTS {qualified(db, name)} ({columns}){by} STORED AS PARQUET LOCATION '{location}'"


def register_external(spark: SparkSession, db: str, name: str, location: str, partition: str | None = None) -> None:
    """Register a folder once; afterwards only refresh what the catalog knows."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(db)}")
    if not spark.catalog.tableExists(f"{db}.{name}"):
        spark.sql(external_table_ddl(db, name, spark.read.parquet(location).schema, location, partition))
    else:
        spark.catalog.refreshTable(f"{db}.{name}")


def add_partition(spark: SparkSession, db: str, name: str, column: str, value: str, location: str, use_msck: bool = False) -> None:
    if use_msck:
        spark.catalog.recoverPartitions(f"{db}.{name}")
    else:
        spark.sql(f"ALTER TABLE {qualified(db, name)} ADD IF NOT EXISTS PARTITION ({qualified(column)}='{value}') LOCATION '{location}'")


def set_location(spark: SparkSession, db: str, name: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {qualified(db, name)} SET LOCATION '{location}'")


def create_external_if_absent(spark: SparkSession, db: str, name: str, location: str, schema: StructType, partition: str | None = None) -> bool:
    """Register an empty external table of a known schema before its folder has files; False if it is there already."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(db)}")
    if spark.catalog.tableExists(f"{db}.{name}"):
        return False
    spark.sql(external_table_ddl(db, name, schema, location, partition))
    return True


def write_dataset(df: DataFrame, path: str, format_: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    df.write.format(format_).mode(mode).options(**options).save(path)


def copy_with_names(spark: SparkSession, source: str, target: str, rename=str.lower) -> int:
    """Copy a table to one whose columns have other (by default lower-case) names; how many rows.  Names that would meet are an error."""
    df = spark.table(source)
    names = [rename(c) for c in df.columns]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"columns of {source} would have equal names")
    seen = Observation(f"copy-{uuid.uuid4().hex}")
    df.toDF(*names).observe(seen, F.count(F.lit(1)).alias("rows")).write.format("parquet").mode("errorifexists").saveAsTable(target)
    return seen.get.get("rows", 0)
