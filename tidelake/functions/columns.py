"""Ingest columns, derived columns, partition transforms, numeric texts, watermark arithmetic."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGER_WATERMARKS = frozenset({"epoch", "epoch_seconds", "epoch_millis", "int", "integer", "bigint", "long", "numeric", "decimal"})


def is_integer_watermark(kind: str | None) -> bool:
    return (kind or "timestamp").lower() in INTEGER_WATERMARKS


def with_ingest_columns(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({"load_timestamp": F.current_timestamp(), "run_id": F.lit(run_id)})


def with_derived(df: DataFrame, derived) -> DataFrame:
    """Columns from (name, SQL expression) in order; later ones see earlier ones, and a name may be redefined."""
    for name, expression in derived.items() if isinstance(derived, dict) else derived:
        df = df.withColumn(name, F.expr(expression))
    return df


def parse_transform(spec: str) -> tuple[str, str, int | None]:
    """(transform, column, argument) of ``column``, ``month(c)``, ``bucket(16, c)`` or ``bucket:16:c``-like texts; unknown ones are identity."""
    call = re.fullmatch(r"\s*(\w+)\s*\(\s*(.*?)\s*\)\s*", spec)
    if not call:
        return "identity", spec.strip(), None
    name, parts = call[1].lower(), [p.strip() for p in call[2].split(",")]
    number = next((int(p) for p in parts if p.isdigit()), None)
    column = next(p for p in parts if not p.isdigit())
    name = name.removesuffix("s") if name in ("years", "months", "days") else name
    if name not in ("year", "month", "day", "bucket", "truncate"):
        return "identity", column, None
    return name, column, {"bucket": 16, "truncate": 10}.get(name) if number is None else number


def partition_value(spec: str) -> Column:
    """The value by which a partition transform groups rows, as a plain column for file layouts."""
    name, column, n = parse_transform(spec)
    c = F.col(column)
    if name == "year":
        return F.year(c)
    if name == "month":
        return F.date_format(c, "yyyy-MM")
    if name == "day":
        return F.to_date(c)
    if name == "bucket":
        return F.pmod(F.hash(c), F.lit(n))
    if name == "truncate":
        return F.left(c.cast("string"), F.lit(n))
    return c


def partition_name(spec: str) -> str:
    name, column, _ = parse_transform(spec)
    return column if name == "identity" else f"{column}_{name}"


def digit_count(value: Column) -> Column:
    """Decimal digits of a number's plain text."""
    return F.length(F.regexp_replace(value.cast("string"), "[^0-9]", ""))


def plain_number(value) -> str:
    """Python number or numeric text as plain digits, without exponent."""
    from decimal import Decimal, InvalidOperation

    try:
        return format(Decimal(str(value).strip()), "f")
    except InvalidOperation:
        return ""


def whole(value) -> int:
    """A stored integer, or numeric text, exactly; a fraction is cut off."""
    from decimal import Decimal

    return int(Decimal(str(value).strip()))


def before_watermark(watermark: str, seconds: int, kind: str | None) -> str:
    """A watermark ``seconds`` earlier; integers don't go below zero, and no seconds change nothing."""
    if not seconds:
        return watermark
    if is_integer_watermark(kind):
        return str(max(0, whole(watermark) - seconds * (1000 if kind == "epoch_millis" else 1)))
    return (datetime.fromisoformat(watermark[:19].replace("T", " ")) - timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def watermark_literal(value: str, kind: str | None) -> Column:
    """A stored watermark as a typed literal."""
    return F.lit(whole(value)).cast("long") if is_integer_watermark(kind) else F.lit(value).cast("timestamp_ntz")


def watermark_value(column: str, kind: str | None) -> Column:
    """A source column as its watermark type; values that don't convert are null."""
    c = F.col(column)
    return c.try_cast("long") if is_integer_watermark(kind) else c.try_cast("timestamp_ntz")
