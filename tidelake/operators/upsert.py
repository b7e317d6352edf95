"""Keyed upserts: latest row per key, column alignment, merge, schema evolution, watermarks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from tidelake.functions.columns import watermark_value


def dedup_latest(df: DataFrame, keys: list[str], order: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """One row for each key: the greatest by ``order``, nulls last.

    Ties go to the greatest ``tiebreak`` columns, then to the greatest hash of the row, so the
    choice doesn't depend on partitioning.  Ranking stops at one row a key before the shuffle.
    """
    rank = [F.col(c).desc_nulls_last() for c in [*order, *(tiebreak or [])]]
    whole = F.xxhash64(*(F.col(c) if not str(t).startswith("map") else F.to_json(c) for c, t in df.dtypes))
    w = Window.partitionBy(*keys).orderBy(*rank, whole.desc())
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def align(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` in the target's column order, what the target lacks after that, what the source lacks as typed nulls.

    New columns of no type (all null) are left out.
    """
    have = {f.name: f for f in source.schema.fields}
    out = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    known = set(target.columns)
    out += [F.col(f.name) for f in source.schema.fields if f.name not in known and not isinstance(f.dataType, NullType)]
    return source.select(*out)


def evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` with typed nulls for the source's new columns; columns of no type are left out."""
    known = set(target.columns)
    return target.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema.fields if f.name not in known and not isinstance(f.dataType, NullType)))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], frozen: tuple[str, ...] = ("load_date",), target_filter: str | Column | None = None, order: list[str] | None = None, keep_missing: bool = False, newer: str | None = None) -> DataFrame:
    """The target after an upsert of ``source``.

    Matched rows take the source's values except for keys and ``frozen`` columns; others are
    inserted; a null key never matches.  With ``target_filter`` only target rows that pass it can
    match: the others stay as they are, and a source row with such a key is inserted beside it.
    ``order``: the source is deduplicated by it first.  ``keep_missing``: columns that the source
    lacks keep the target's values.  ``newer``: a match updates only if the source's value isn't older.
    """
    given = set(source.columns)
    if order is not None:
        source = dedup_latest(source, keys, order)
    target = evolve(target, source)
    source = align(source, target)
    hot, cold = target, None
    if target_filter is not None:
        passes = F.coalesce(F.expr(target_filter) if isinstance(target_filter, str) else target_filter, F.lit(False))
        hot, cold = target.where(passes), target.where(~passes)
    t, s = hot.withColumn("_in_target", F.lit(True)).alias("t"), source.withColumn("_in_source", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    there, here = F.col("t._in_target").isNotNull(), F.col("s._in_source").isNotNull()
    update = here & there
    if newer is not None:
        update = update & F.coalesce(F.col(f"s.{newer}") >= F.col(f"t.{newer}"), F.col(f"t.{newer}").isNull())

    def value(c: str) -> Column:
        stays = c in keys or c in frozen or (keep_missing and c not in given)
        taken = F.col(f"t.{c}") if stays else F.when(update, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        return F.when(there, taken).otherwise(F.col(f"s.{c}")).alias(c)

    merged = joined.select(*(value(c) for c in target.columns))
    return merged if cold is None else merged.unionByName(cold)


def duplicates_by_filter(target: DataFrame, source: DataFrame, keys: list[str], target_filter: str) -> DataFrame:
    """Source keys that a filtered merge inserts although the target has them outside the filter."""
    cold = target.where(~F.coalesce(F.expr(target_filter), F.lit(False))).select(*keys)
    return source.select(*keys).join(cold, keys, "left_semi").distinct()


def merge_statement(columns: list[str], table: str, view: str, keys: list[str], frozen: tuple[str, ...] = ("load_date",), target_filter: str | None = None, newer: str | None = None) -> str:
    """The same upsert as a ``MERGE`` of a view into a table."""
    q = lambda side, c: f"{side}.`{c}`"
    on = " AND ".join([f"{q('t', k)} = {q('s', k)}" for k in keys] + ([f"({target_filter})"] if target_filter else []))
    fresh = f" AND ({q('s', newer)} >= {q('t', newer)} OR {q('t', newer)} IS NULL)" if newer else ""
    updates = ", ".join(f"{q('t', c)} = {q('s', c)}" for c in columns if c not in keys and c not in frozen)
    matched = f" WHEN MATCHED{fresh} THEN UPDATE SET {updates}" if updates else ""
    names = ", ".join(f"`{c}`" for c in columns)
    return f"MERGE INTO {table} t USING {view} s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(q('s', c) for c in columns)})"


def merge_into(source: DataFrame, table: str, keys: list[str], frozen: tuple[str, ...] = ("load_date",), target_filter: str | None = None, newer: str | None = None) -> None:
    """The same upsert by ``MERGE``, for table formats that have it."""
    view = f"_merge_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        source.sparkSession.sql(merge_statement(source.columns, table, view, keys, frozen, target_filter, newer))
    finally:
        source.sparkSession.catalog.dropTempView(view)


def new_watermark(df: DataFrame, column: str, kind: str | None) -> DataFrame:
    """(watermark, last_loaded_date) as texts; nulls where there is no row, so the caller keeps its old ones."""
    highest = F.max(watermark_value(column, kind))
    text = highest.cast("string")
    return df.agg(text.alias("watermark"), F.max("load_date").cast("string").alias("last_loaded_date"))


def rebuild(raw: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A table from its raw history: the latest row of each key, or distinct rows without keys."""
    return dedup_latest(raw, keys, order) if keys else raw.dropDuplicates()


def mirror_for_date(target: DataFrame, day: str, column: str = "load_date") -> DataFrame:
    return target.where(F.col(column) == F.to_date(F.lit(day)))


def extend_missing(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Typed nulls for fields (name to Spark type) that the frame lacks in any case."""
    have = {c.lower() for c in df.columns}
    return df.select("*", *(F.lit(None).cast(t).alias(n) for n, t in fields.items() if n.lower() not in have))
