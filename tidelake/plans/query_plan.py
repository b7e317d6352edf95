"""A small logical query: projection, filters, grouping, having, order and limit.

``to_dataframe`` states it with DataFrame operations, so Catalyst prunes columns
and pushes filters into whatever source is below; ``to_sql`` renders it for a
source database.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SelectItem:
    expression: str
    alias: str | None = None

    def column(self):
        return F.expr(self.expression).alias(self.alias) if self.alias else F.expr(self.expression)

    def sql(self) -> str:
        return f"{self.expression} AS {self.alias}" if self.alias else self.expression


@dataclass(frozen=True)
class OrderItem:
    expression: str
    descending: bool = False

    def column(self):
        e = F.expr(self.expression)
        return e.desc() if self.descending else e.asc()

    def sql(self) -> str:
        return self.expression + (" DESC" if self.descending else "")


@dataclass(frozen=True)
class QueryPlan:
    selects: tuple[SelectItem, ...] = ()
    source: str | None = None
    filters: tuple[str, ...] = ()
    group_by: tuple[str, ...] = ()
    having: tuple[str, ...] = ()
    order_by: tuple[OrderItem, ...] = ()
    limit: int | None = None

    def with_filter(self, predicate: str | None) -> QueryPlan:
        """One conjunct more; an empty one changes nothing."""
        return replace(self, filters=(*self.filters, predicate)) if predicate else self

    def to_dataframe(self, source: DataFrame) -> DataFrame:
        df = source
        for predicate in self.filters:
            df = df.where(predicate)
        if self.group_by or self.having:
            # aggregates of HAVING that aren't selected go along under hidden names
            keys = [F.expr(g) for g in self.group_by]
            names = {s.expression: s for s in self.selects}
            aggregates = [s.column() for s in self.selects if s.expression not in self.group_by]
            hidden = [F.expr(h).alias(f"_having_{i}") for i, h in enumerate(self.having)]
            marked = [F.expr(g).alias(f"_group_{i}") for i, g in enumerate(self.group_by)]
            if not aggregates and not hidden:
                df = df.select(*marked).distinct()
            else:
                df = df.select("*", *marked).groupBy(*(f"_group_{i}" for i in range(len(keys)))).agg(*aggregates, *hidden)
            for i in range(len(hidden)):
                df = df.where(F.col(f"_having_{i}"))
            out = []
            for s in self.selects:
                if s.expression in self.group_by:
                    out.append(F.col(f"_group_{self.group_by.index(s.expression)}").alias(s.alias or s.expression))
                else:
                    out.append(F.col(s.alias) if s.alias else F.col(df.columns[len(keys) + [x for x in names if x not in self.group_by].index(s.expression)]))
            df = df.select(*out)
        elif self.selects:
            if self.order_by:  # an order may use columns that aren't selected
                return self._limited(df.orderBy(*(o.column() for o in self._unaliased()))).select(*(s.column() for s in self.selects))
            df = df.select(*(s.column() for s in self.selects))
        if self.order_by:
            df = df.orderBy(*(o.column() for o in self.order_by))
        return self._limited(df)

    def _unaliased(self):
        alias = {s.alias: s.expression for s in self.selects if s.alias}
        return tuple(replace(o, expression=alias.get(o.expression, o.expression)) for o in self.order_by)

    def _limited(self, df: DataFrame) -> DataFrame:
        return df if self.limit is None else df.limit(self.limit)

    def to_sql(self, default_source: str | None = None, limit_style: str = "limit") -> str:
        """SQL text; ``limit_style``: ``limit``, ``fetch`` (ANSI, needs no keyword before) or ``top``."""
        source = self.source or default_source
        if not source:
            raise ValueError("a plan without a source")
        top = f"TOP ({self.limit}) " if self.limit is not None and limit_style == "top" else ""
        text = f"SELECT {top}{', '.join(s.sql() for s in self.selects) or '*'} FROM {source}"
        if self.filters:
            text += " WHERE " + " AND ".join(f"({f})" for f in self.filters)
        if self.group_by:
            text += " GROUP BY " + ", ".join(self.group_by)
        if self.having:
            text += " HAVING " + " AND ".join(f"({h})" for h in self.having)
        if self.order_by:
            text += " ORDER BY " + ", ".join(o.sql() for o in self.order_by)
        if self.limit is not None and limit_style != "top":
            text += f" LIMIT {self.limit}" if limit_style == "limit" else f" FETCH FIRST {self.limit} ROWS ONLY"
        return text


@dataclass(frozen=True)
class QueryResult:
    """Rows of a plan that are few by nature (a count, a sample)."""

    rows: tuple[dict, ...] = field(default_factory=tuple)

    @classmethod
    def of(cls, df: DataFrame) -> QueryResult:
        return cls(tuple(r.asDict(recursive=True) for r in df.collect()))

    def scalar(self, alias: str | None = None):
        """The first row's value of ``alias`` (any case), or of its only column; None if there is no row."""
        for row in self.rows[:1]:
            named = [k for k in row if alias is None or k.lower() == alias.lower()]
            chosen = [alias] if alias in named else named
            if len(chosen) != 1:
                raise (ValueError if alias is None else KeyError)(f"{alias or 'one column'} of {list(row)}")
            return row[chosen[0]]
        return None


def sql_over(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A user's query over frames, which it names in braces."""
    return spark.sql(text, **frames)
