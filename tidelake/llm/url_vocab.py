"""URL filtering with a weighted vocabulary and host rules.

An Aho-Corasick automaton finds every vocabulary term in a URL in one pass; a
hit counts only if the characters beside it are no letters or digits.  One
strict term, or soft terms whose distinct weights reach ``LEAST``, block the
URL.  A host rule, where one fits, decides instead.

The automaton and the rules are parameters of fixed, small size that travel with
the task.  Defined results: a null URL, or one without ``://``, has an empty host
and path, no rule, and the vocabulary judges what text there is; repeated rows
each get a verdict; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import spread, table

STRICT = ("adult", "casino", "porn", "spam", "viagra", "xxx")
SOFT = {"ads": 1.0, "bet": 1.0, "bets": 1.0, "bonus": 1.0, "cheap": 1.0, "deal": 0.5, "farm": 0.5, "free": 1.0, "pill": 1.0, "pills": 1.0, "poker": 1.0, "track": 1.0, "tracker": 1.0, "win": 1.0}
LEAST = 2.0
#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def automaton(strict=STRICT, soft=SOFT):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term in strict:
        found.add_word(term, (term, None))
    for term, weight in soft.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def hits(found, url: str) -> tuple[list[str], list[str], float]:
    """Distinct strict terms, distinct soft terms, and the soft terms' weight."""
    low = url.lower()
    strict, soft = set(), {}
    for end, (term, weight) in found.iter(low):
        start = end + 1 - len(term)
        if (start and low[start - 1].isalnum()) or (end + 1 < len(low) and low[end + 1].isalnum()):
            continue
        if weight is None:
            strict.add(term)
        else:
            soft[term] = weight
    return sorted(strict), sorted(soft), float(sum(soft.values()))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", strict=STRICT, soft=SOFT, least: float = LEAST, rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, strict, soft, weight) of every URL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(strict, soft)
        for batch in batches:
            rows = [hits(found, u or "") for u in batch.column(1).to_pylist()]
            columns = [pa.array([",".join(r[0]) for r in rows], pa.string()), pa.array([",".join(r[1]) for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "url", "strict", "soft", "weight"])

    source = spread(pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url")))
    scored = source.mapInArrow(run, "id long, url string, strict string, soft string, weight double")
    parts = scored.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("strict") != "") | (F.col("weight") >= least), "block").otherwise("allow")
    return parts.select("id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "strict", "soft", "weight")


def op5_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    return judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def _sql() -> str:
    terms = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    found = lambda words: f"list_filter({terms(words)}, lambda t: regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}])' || t || '($|[^\\p{{L}}\\p{{N}}])'))"
    fits = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v) for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))]
    case = lambda k, other: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + f" ELSE {other} END"
    weights = "map(" + terms(SOFT) + ", [" + ", ".join(f"{w}::DOUBLE" for w in SOFT.values()) + "])"
    return f"""
WITH p AS (
  SELECT page_id, lower(coalesce(url, '')) AS u,
    translate(regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
s AS (SELECT *, list_sort({found(sorted(STRICT))}) AS hard, list_sort({found(sorted(SOFT))}) AS mild FROM p),
w AS (SELECT *, coalesce(list_sum(list_transform(mild, lambda t: {weights}[t])), 0)::DOUBLE AS weight FROM s)
SELECT page_id, host, path, {case(1, "NULL")} AS rule,
  {case(2, f"CASE WHEN len(hard) > 0 OR weight >= {LEAST} THEN 'block' ELSE 'allow' END")} AS verdict,
  array_to_string(hard, ',') AS strict, array_to_string(mild, ',') AS soft, weight
FROM w"""


ORACLE = _sql()
