"""The lake's files: raw zone, slices, JSON lines, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.functions.columns import watermark_literal, watermark_value


def read(spark: SparkSession, format_: str = "parquet", path=None, schema: StructType | str | None = None, **options) -> DataFrame:
    """Any source that Spark knows by name."""
    reader = spark.read.format(format_).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def scalar(df: DataFrame):
    """First column of the first row; None of an empty frame."""
    row = df.first()
    return None if row is None else row[0]


def raw_base(spark: SparkSession, base: str, format_: str = "parquet") -> DataFrame:
    """A raw table with its ``load_date`` partitions."""
    return spark.read.format(format_).option("basePath", base).load(base)


def raw_chunks(spark: SparkSession, base: str, days: list[str], format_: str = "parquet") -> DataFrame:
    """Only the named days' partitions, ``load_date`` kept."""
    return spark.read.format(format_).option("basePath", base).load([f"{base}/load_date={d}" for d in days])


def slices(spark: SparkSession, paths: list[str], format_: str = "parquet") -> DataFrame:
    """Staged slices as one relation; a column that only some have is null in the others."""
    return spark.read.format(format_).option("mergeSchema", "true").load(paths)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def log_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Telemetry from JSON log lines; lines that don't parse are skipped."""
    parsed = spark.read.text(path).select(F.from_json("value", schema).alias("e"), "value")
    return parsed.where(F.col("e").isNotNull() & F.get_json_object("value", "$").isNotNull()).select("e.*")


def xml_records(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """Records of an XML parameter file."""
    return read(spark, "xml", path, schema, rowTag=row_tag)


def raw_increment(raw: DataFrame, column: str, kind: str | None, watermark: str, last_load_date: str) -> DataFrame:
    """Raw rows of ``last_load_date`` or later past the watermark; none if the column is missing.  The first condition prunes partitions."""
    if column not in raw.columns:
        return raw.limit(0)
    return raw.where(F.col("load_date") >= F.to_date(F.lit(last_load_date))).where(watermark_value(column, kind) > watermark_literal(watermark, kind))
