"""Texts whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

SimHash comes first: fingerprints of the grams are linked through BK-trees
(``simhash_bk``), which finds most near copies.  At this similarity fingerprints
may differ in more bits than any sharded search of 64 bits can follow, so an exact
join of sets by prefixes finds the rest.  In any common order of grams,
two similar sets share at least min(``shared`` of each) grams among the first
``head`` of each.  One step takes the order of hashes, and keeps a text if
enough of its first grams are in another text; few are left.  The next orders
what is left by frequency, rarest first, so that common passages come last, and
pairs texts that share one of their first grams and are in different components:
first each with the nearest one, then all that is left.  The first gives at most
one pair for each text and gram, and unites large groups, so that the last has little to do.  Pairs whose parity bits
differ too much can't be similar and don't go on.  Every other pair is confirmed by the similarity of its sets before it links.

Defined results: case and white space don't count; null text is empty; a text of
fewer words than a gram is one gram.  Grams and texts stand for themselves by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import materialize, spread
from tidelake.llm.simhash_bk import PAIRS, ROWS, SEED, connected, links_within, majority, whole_keys

SHINGLE = 5
SIMILARITY = 0.8
#: Columns of a set's parity bits: each of 512 tells whether an odd number of grams has it.
BITS = [f"bits{i}" for i in range(8)]


def least(n: int, similarity: float) -> int:
    """The size of the smallest set that is similar to one of ``n``, and the least overlap."""
    return math.ceil(similarity * n - 1e-9)


def shared(n: int, similarity: float) -> int:
    return max(1, (n - least(n, similarity)) // 2)


def head(n: int, similarity: float) -> int:
    return n - least(n, similarity) + shared(n, similarity)


def grams(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a normal text."""
    import xxhash

    hash_of = xxhash.xxh64_intdigest
    ends = list(accumulate((len(w) + 1 for w in text.split(b" ")), initial=-1))
    if len(ends) <= size + 1:
        return np.array([hash_of(text, SEED)], dtype=np.uint64).view(np.int64)
    found = np.fromiter((hash_of(text[a + 1 : b], SEED) for a, b in zip(ends, ends[size:])), dtype=np.uint64, count=len(ends) - size)
    return np.unique(found.view(np.int64))


def parity(found: np.ndarray) -> np.ndarray:
    """Two sets' bits differ in at most as many places as the sets do."""
    odd = np.bincount(found & 511, minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def normal(text_col: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"\s+", " "))


def node(text_col: str) -> Column:
    """What stands for a text."""
    return F.xxhash64(normal(text_col))


def groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of a sorted key."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return start, np.diff(np.r_[start, len(key)])


def _in_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, node, n) sorted by gram and node to (gram, node, n, texts) of grams in two texts or more."""
    for gram, text, n in whole_keys(batches):
        new = np.r_[True, (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])]
        gram, text, n = gram[new], text[new], n[new]
        _, size = groups(gram)
        size = np.repeat(size, size)
        many = size > 1
        yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (gram, text, n, size.astype(np.int64))], ["gram", "node", "n", "texts"])


def in_others(entries: DataFrame) -> DataFrame:
    return entries.repartition("gram").sortWithinPartitions("gram", "node").mapInArrow(_in_others, "gram long, node long, n int, texts long")


def entries_of(sets: Iterator[tuple[int, np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
    """(gram, node, n) of each set's grams."""
    held, size = [], 0

    def batch():
        lengths = [len(g) for _, g, _ in held]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([g for _, g, _ in held])), pa.array(np.repeat(np.array([t for t, _, _ in held], np.int64), lengths)), pa.array(np.repeat(np.array([n for _, _, n in held], np.int32), lengths))], ["gram", "node", "n"])

    for one in sets:
        held.append(one)
        size += len(one[1])
        if size >= ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) whose sets are similar."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    of = lambda k: sets.select(F.col("node").alias(k), F.col("grams").alias(f"grams_{k}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a long, b long")


def components(docs: DataFrame, text_col: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of every text that is linked to one with a smaller ``node``, its component's smallest."""

    def first_grams(batches):
        def sets():
            for batch in batches:
                for t, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    g = grams(text.as_py(), size)
                    yield t, g[: head(len(g), similarity)], shared(least(len(g), similarity), similarity)

        return entries_of(sets())

    def whole_sets(batches):
        for batch in batches:
            found = [grams(text.as_py(), size) for text in batch.column(1)]
            bits = np.array([parity(g) for g in found], np.int64).reshape(-1, len(BITS))
            fps = np.array([majority(g.view(np.uint64)) for g in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g.tobytes() for g in found], pa.binary()), pa.array(fps), *map(pa.array, bits.T)], ["node", "grams", "fp", *BITS])

    def every_gram(batches):
        return entries_of((t, g, len(g)) for batch in batches for t, g in zip(batch.column(0).to_pylist(), (np.frombuffer(x.as_py(), np.int64) for x in batch.column(1))))

    def rarest(batches):
        for text, _, gram, n in whole_keys(batches):
            start, many = groups(text)
            first = [head(k, similarity) - shared(k, similarity) + 1 - (k - m) for k, m in zip(n[start].tolist(), many.tolist())]
            keep = np.arange(len(text)) - np.repeat(start, many) < np.repeat(np.array(first, np.int64), many)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (gram, text, n)], ["gram", "node", "n"])

    def pairs_of(batches, step):
        """Pairs of texts of different components that share a gram: each with the nearest one, or all."""
        for gram, text, n, root, *bits in whole_keys(batches):
            bits = np.stack(bits, axis=1).view(np.uint64)
            a, b = [], []
            for s, many in zip(*groups(gram)):
                t, k, r, p = (x[s : s + many] for x in (text, n.astype(np.int64), root, bits))
                if many < 2 or (r == r[0]).all():
                    continue
                roots, count = np.unique(r, return_counts=True)
                main = r == roots[count.argmax()]  # pairs within the largest component needn't be looked at
                asked = np.flatnonzero(~main)
                for i in np.array_split(asked, -(-len(asked) * many // PAIRS)):
                    apart = np.zeros((len(i), many), np.int64)
                    for w in range(p.shape[1]):
                        apart += np.bitwise_count(p[i, w][:, None] ^ p[:, w])
                    ki = k[i][:, None]
                    near = (np.minimum(k, ki) >= similarity * np.maximum(k, ki) - 1e-9) & (apart <= (k + ki) * (1 - similarity) / (1 + similarity) + 1e-9) & (r != r[i][:, None])
                    if step == "nearest":
                        best = np.where(near, apart, 1 << 20).argmin(axis=1)
                        near &= np.arange(many) == best[:, None]
                    else:
                        near &= main | (np.arange(many) > i[:, None])
                    x, y = np.nonzero(near)
                    a.append(t[i[x]])
                    b.append(t[y])
            if a:
                found = np.unique(np.sort(np.stack([np.concatenate(a), np.concatenate(b)]), axis=0), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    texts = docs.select(node(text_col).alias("node"), normal(text_col).cast("binary").alias("normal"))
    common = in_others(spread(texts).mapInArrow(first_grams, "gram long, node long, n int"))
    candidates = common.groupBy("node").agg(F.count("*").alias("found"), F.first("n").alias("n")).where("found >= n").select("node")
    one_each = texts.groupBy("node").agg(F.first("normal").alias("normal"))
    sets = materialize(one_each.join(candidates, "node", "left_semi").mapInArrow(whole_sets, ", ".join(["node long, grams binary, fp long", *(f"{b} long" for b in BITS)])), "grams")
    ordered = in_others(sets.select("node", "grams").mapInArrow(every_gram, "gram long, node long, n int")).select("node", "texts", "gram", "n").repartition("node").sortWithinPartitions("node", "texts", "gram")
    entries = materialize(ordered.mapInArrow(rarest, "gram long, node long, n int").join(sets.drop("grams", "fp"), "node"), "entries")

    def roots_with(found, pairs):
        return connected(found.unionByName(materialize(similar_pairs(pairs, sets, similarity), "similar")))

    found = connected(materialize(similar_pairs(links_within(sets.select("fp", "node")), sets, similarity), "similar"))
    for step in ("nearest", "rest"):
        roots = found.select(F.col("a").alias("node"), F.col("b").alias("root"))
        rooted = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        by_gram = rooted.select("gram", "node", "n", "root", *BITS).repartition("gram").sortWithinPartitions("gram", "node")
        found = roots_with(found, by_gram.mapInArrow(lambda batches, step=step: pairs_of(batches, step), "a long, b long").distinct())
    return found.select(F.col("a").alias("node"), F.col("b").alias("root"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, one row of each near-duplicate component: the smallest id (nulls last), then text hash."""
    docs_of = docs.withColumn("_node", node("text"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    best = docs_of.groupBy("_node").agg(F.min(F.struct(*(c.alias(k) for k, c in zip("abc", order)))).alias("best"))
    found = components(docs).withColumnRenamed("node", "_node")
    kept = best.join(found, "_node", "left").groupBy(F.coalesce("root", "_node")).agg(F.min_by("_node", F.struct("best", "_node")).alias("_node")).select("_node")
    first = docs_of.withColumn("_row", F.row_number().over(Window.partitionBy("_node").orderBy(*order))).where("_row = 1")
    return first.join(kept, "_node", "left_semi").select(docs.columns)
