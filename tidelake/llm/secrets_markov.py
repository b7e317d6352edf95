"""Secrets: fixed patterns, and a Markov test that tells random strings from identifiers.

Two first-order Markov models over the characters of tokens are trained from
labelled samples, one for random strings and one for ordinary identifiers.  A
long token is a secret if the log-likelihood ratio of its transitions is above
``THRESHOLD`` a transition.  Training and scoring are DataFrame functions; what
reaches the driver is a count for each label and pair of characters, at most
2 x 67 x 67 rows.

Defined results: null text is empty and has no spans; each base kind's matches
are leftmost and don't overlap within the kind; a random token inside a base
span isn't listed again; repeated rows each get their spans; an empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import table
from tidelake.llm.spans import apart, count_of, listed, spans

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']? *+[:=] *+["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']? *+[:=] *+["']?"""
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
BASE = ("assign", "access", "hex")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: In hundredths of a nat for each transition.
THRESHOLD = 40
#: Labelled samples of each kind that the default training set holds.
SAMPLES = 4000
#: Ordinary identifiers are made of these words, in the usual spellings.
WORDS = (
    "account action active address array base batch block buffer build cache call channel check client code column config "
    "context count create cursor data date default delete device document element entry error event field file filter find "
    "format frame function group handle header height index input instance item key label language length level line link "
    "list load local lock manager map match message method model module name network node number object offset option order "
    "output owner package page parent parser path pattern player point position process product project property query queue "
    "range read record region report request resource response result return row scale schema score search select server "
    "service session size source stage start state status store stream string style system table target task template test "
    "text thread time title tree type update user value vector version view width window worker write"
).split()


def default_samples(spark: SparkSession, n: int = SAMPLES) -> DataFrame:
    """(label, text): ``n`` random strings (1: hexadecimal, base64, letters and digits) and ``n`` identifiers (0), from a rule."""
    ids = spark.range(n)
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = F.when(F.col("id") % 3 == 0, F.left(digest, F.lit(40))).when(F.col("id") % 3 == 1, F.base64(F.unhex(digest)))
    random = random.otherwise(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", ""))
    words = F.array(*map(F.lit, WORDS))
    word = lambda salt: F.get(words, F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(len(WORDS))).cast("int"))
    parts = F.array(*map(word, range(4)))
    snake, style = F.array_join(parts, "_"), F.col("id") % 6
    camel = F.concat(word(0), F.array_join(F.transform(F.slice(parts, 2, 3), F.initcap), ""))
    plain = F.when(style == 0, snake).when(style == 1, camel).when(style == 2, F.upper(snake)).when(style == 3, F.array_join(parts, "-"))
    plain = plain.when(style == 4, F.array_join(parts, "/")).otherwise(F.array_join(parts, ""))
    return ids.select(F.lit(1).alias("label"), random.alias("text")).union(ids.select(F.lit(0), plain))


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratios, in hundredths of a nat, of each transition: index 67 * first + second.

    Transitions outside the alphabet don't count; every transition starts with a count of one.
    """
    chars = F.split(F.coalesce("text", F.lit("")), "")
    pairs = F.arrays_zip(F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0))).alias("a"), F.slice(chars, F.lit(2), F.size(chars)).alias("b"))
    each = samples.select("label", F.explode(pairs).alias("p")).select("label", F.instr(F.lit(ALPHABET), F.col("p.a")).alias("a"), F.instr(F.lit(ALPHABET), F.col("p.b")).alias("b"))
    size = len(ALPHABET)
    counts = [[1] * (size * size) for _ in range(2)]
    for r in each.where("a > 0 and b > 0").groupBy("label", "a", "b").count().collect():  # bounded: 2 x 67 x 67
        counts[r["label"]][(r["a"] - 1) * size + r["b"] - 1] += r["count"]
    out = []
    for i in range(size * size):
        row = i // size * size
        ratio = [counts[label][i] / sum(counts[label][row : row + size]) for label in (0, 1)]
        out.append(round(100 * math.log(ratio[1] / ratio[0])))
    return out


def likelihood_ratio(value: Column, model: list[int]) -> Column:
    """Hundredths of a nat a transition."""
    table_ = F.array(*map(F.lit, model))
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    size = len(ALPHABET)

    def total(all_: Column) -> Column:
        steps = F.zip_with(F.slice(all_, F.lit(1), F.size(all_) - 1), F.slice(all_, F.lit(2), F.size(all_) - 1), lambda a, b: F.get(table_, a * size + b))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x) / F.greatest(F.size(all_) - 1, F.lit(1))

    return F.get(F.transform(F.array(places), total), 0)


def with_spans(docs: DataFrame, model: list[int], text_col: str = "text", into: str = "_secret") -> DataFrame:
    """``docs`` with ``{into}_base`` and ``{into}_more``: spans of the fixed patterns, and random tokens outside them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    long_enough = lambda s: F.length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= 6
    found = docs.withColumns({
        f"{into}_assign": F.filter(spans(text, ASSIGN, "assign", 0, text.rlike("[:=]") & text.rlike("(?i:passw|secret|token|api_?key)")), long_enough),
        f"{into}_access": spans(text, ACCESS, "access", 1, text.contains("AKIA")),
        f"{into}_hex": spans(text, HEX, "hex", 2, text.rlike("[0-9a-f]{24}")),
        f"{into}_token": spans(text, TOKEN, "random", 3, text.rlike("[A-Za-z0-9+/_=-]{20}")),
    })
    base = F.array_sort(F.concat(*(F.col(f"{into}_{k}") for k in BASE)))
    found = found.withColumn(f"{into}_base", base)
    random = F.filter(apart(F.col(f"{into}_token"), F.col(f"{into}_base")), lambda s: likelihood_ratio(s["value"], model) > THRESHOLD)
    return found.withColumn(f"{into}_more", random).drop(*(f"{into}_{k}" for k in (*BASE, "token")))


def op4_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    model = train(default_samples(spark))
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), model).withColumn("_all", F.array_sort(F.concat("_secret_base", "_secret_more")))
    base = F.col("_secret_base")
    return found.select("doc_id", *(count_of(base, k).alias(f"n_{k}") for k in BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_all")).alias("spans"))
