"""Document fingerprints by winnowing, with DataFrame functions only.

A text's units are its lower-cased words.  Rolling hashes of ``K`` consecutive
words are taken, each window of ``WINDOW`` hashes keeps its smallest one, the
rightmost of equal ones, and each kept hash keeps its position (of its first
word).  Any run of ``WINDOW + K - 1`` words that two texts share gives them a
common fingerprint.

The rolling hash is a polynomial modulo a prime over word hashes; the windows'
minima come from doubling steps, so the cost a word is the logarithm of the
window.  A kept hash is packed with its position's complement in one integer,
which makes the least value the rightmost of equal hashes.

Defined results: null text is empty; a text without words has no fingerprint,
and one of fewer than ``K`` words has the hash of all its words; one of fewer
than a window's hashes has their least.  Two texts without fingerprints are
alike (1.0).  Null ids come first; rows of one id follow each other in the order of
their texts' hashes.  An empty table gives no rows; columns besides the id and the text aren't read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import materialize, table

K = 5
WINDOW = 16
PRIME = 2147483647
BASE = 1000003
SHIFT = 1 << 31
#: Keys in a range when successors are looked for, about, as long as there are no more than about so many ranges.
ROWS, GROUPS = 64, 1 << 16


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _roll(hashes: Column, combine, shift: int) -> Column:
    """combine(x[i], x[i + shift]) for all i where both are there."""
    return _bound(hashes, lambda h: F.zip_with(F.slice(h, F.lit(1), F.greatest(F.size(h) - shift, F.lit(0))), F.slice(h, F.lit(1 + shift), F.greatest(F.size(h) - shift, F.lit(0))), combine))


def kgram_hashes(text: Column, k: int = K) -> Column:
    """Rolling hashes of all runs of k words, each below ``PRIME``."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    h = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME).cast("long")))

    def grams(single: Column) -> Column:
        n = F.greatest(F.size(single) - (k - 1), F.lit(0))
        rolled = F.slice(single, F.lit(1), n)
        for i in range(1, k):
            rolled = F.zip_with(rolled, F.slice(single, F.lit(1 + i), n), lambda a, b: (a * BASE + b) % PRIME)
        short = F.aggregate(single, F.lit(0).cast("long"), lambda a, b: (a * BASE + b) % PRIME)
        return F.when(F.size(single) >= k, rolled).when(F.size(single) > 0, F.array(short)).otherwise(F.array().cast("array<bigint>"))

    return _bound(h, grams)


def winnow(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Kept hashes of a text as integers hash * 2**31 + (2**31 - 1 - position), in order of position."""
    least = lambda a, b: F.least(a, b)
    packed = F.transform(kgram_hashes(text, k), lambda h, i: h * SHIFT + (SHIFT - 1 - i))

    def kept(all_: Column) -> Column:
        low, width = all_, 1
        while width * 2 <= window:
            low, width = _roll(low, least, width), width * 2
        if width < window:
            low = _roll(low, least, window - width)
        short = F.array(F.array_min(all_))
        return F.when(F.size(all_) >= window, F.array_distinct(low)).when(F.size(all_) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return _bound(packed, kept)


def listed(kept: Column) -> Column:
    """hash@position of each kept hash, comma-joined."""
    one = lambda x: F.concat_ws("@", F.lower(F.hex(F.shiftright(x, 31))), (F.lit(SHIFT - 1) - x % SHIFT).cast("string"))
    return F.array_join(F.transform(kept, one), ",")


def hashes(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 31)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def order_of(row: Column, text: Column) -> Column:
    """What rows are ordered by: null ids first, then ids, then hashes of the texts."""
    return F.struct(row.isNotNull().alias("there"), row.cast("long").alias("id"), F.xxhash64(text).alias("hash"))


def place(bounds: Column, key: Column) -> Column:
    """How many of the sorted ``bounds`` aren't above ``key``, by halving."""

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        above = F.get(bounds, middle) > key
        halved = F.when(above, F.struct(at["low"].alias("low"), middle.alias("high"))).otherwise(F.struct((middle + 1).alias("low"), at["high"].alias("high")))
        return F.when(at["low"] < at["high"], halved).otherwise(at).cast("struct<low:int,high:int>")

    first = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high")).cast("struct<low:int,high:int>")
    return F.aggregate(F.sequence(F.lit(0), F.lit(math.ceil(math.log2(2 * GROUPS + 2)))), first, step, lambda at: at["low"])


def with_successor(docs: DataFrame, made=None, id_col: str = "doc_id", text_col: str = "text", groups: int = GROUPS, rows: int = ROWS) -> DataFrame:
    """(own, next): structs of id, text and ``made`` (a function of the text) of every row and of the row with the next id (after the last: the first).

    The order is cut into ranges at some of its keys, about one in ``rows`` and about ``groups`` at most, so ranges stay small
    however ids are spread; texts go out once, by range, and each range's end gets the first row of the next.  Rows alike in id and
    text can't be cut apart, so where they are many they go as one and are multiplied again.
    """
    row_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(order_of(row_id, text).alias("key"), text.alias("text"))
    keys = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")), "keys")
    each = max(rows, keys.count() // groups)
    # a key is a cut if its hash says so, and the first of all is one, so no range is empty
    cuts = keys.where(F.pmod(F.xxhash64("key.id", "key.hash"), F.lit(each)) == 0).select("key").union(keys.agg(F.min("key").alias("key")))
    bounds = materialize(cuts.agg(F.array_sort(F.collect_set("key")).alias("bounds")), "bounds")  # one row of about ``groups`` keys
    last = bounds.select(F.size("bounds")).first()[0]
    placed = keyed.withColumn("bounds", bounds.scalar()).withColumn("range", place(F.col("bounds"), F.col("key")))

    heads = placed.where(F.get("bounds", F.col("range") - 1) == F.col("key")).groupBy("key", "range", "text").agg(F.lit(1))
    before = F.when(F.col("range") == 1, F.lit(last)).otherwise(F.col("range") - 1)
    payload = F.struct("id", "text", *([made(F.col("text")).alias("made")] if made else []))
    heads = heads.select(before.alias("range"), "text", F.col("key.id").alias("id")).select("range", payload.alias("head"))

    once = placed.select("key", "text", "range", F.lit(1).cast("long").alias("copies"))
    copied = F.broadcast(keys.where(F.col("n") > each * 8).select("key"))  # at most one in 8 * ``each`` rows
    if not copied.isEmpty():
        alike = placed.join(copied, "key", "left_semi").groupBy("key", "text", "range").agg(F.count("*").alias("copies"))
        once = once.join(copied, "key", "left_anti").union(alike.select(once.columns))
    own = once.repartition("range").select("key", "range", "copies", "text", F.col("key.id").alias("id")).select("key", "range", "copies", payload.alias("own"))
    found = own.withColumn("next", F.lead("own").over(Window.partitionBy("range").orderBy("key"))).join(heads, "range", "left")
    copies = F.array_repeat(F.col("own"), (F.col("copies") - 1).cast("int"))
    return found.select("own", F.explode(F.concat(copies, F.array(F.coalesce("next", "head")))).alias("next"))


def fingerprint_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    found = with_successor(docs, winnow).select(F.col("own.id").alias("doc_id"), F.col("own.text").alias("text"), F.col("next.text").alias("next_text"), F.col("own.made").alias("kept"), F.col("next.made").alias("next_kept"))
    found = found.withColumn("edited", edited).select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "kept", "next_kept", winnow(F.col("edited")).alias("edited_kept"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", listed(F.col("kept")).alias("fingerprint"), listed(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(hashes(F.col("kept")), hashes(F.col("edited_kept"))).alias("near_edited"), likeness(hashes(F.col("kept")), hashes(F.col("next_kept"))).alias("near_next"),
    )


def op7_winnow_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of all documents."""
    return fingerprint_with_edits(table(spark, sf_dir, "documents"))
