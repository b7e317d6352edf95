"""Near-duplicate detection: SimHash fingerprints linked through BK-trees.

A fingerprint's links are all fingerprints within ``RADIUS`` differing bits.
The search is sharded without loss: 64 bits fall into six bands, and two
fingerprints that differ in at most four bits agree on two whole bands at
least, so they meet in one of the 15 shards of a band pair.  Each shard is a
BK-tree (children keyed by their integer Hamming distance to the parent) that
is shipped to the task of its key; a search follows only the edges within the
radius.  Copies count once: a shard holds distinct fingerprints.  A shard gives
back a star of links per local component, never all pairs, and the stars are
joined by alternating large-star and small-star steps.  Large shards are dealt
out by further bits, and rows of large components are never brought together.

Defined results: null text is empty; a text without words has fingerprint zero,
linked like any other; repeated rows share a fingerprint; an empty table gives
an empty result; columns besides the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import HOT_KEYS, discard, lookup, materialize, spread, table, written

RADIUS = 4
SHINGLE = 4
SEED = 42
#: (shift, width) of the bands of a fingerprint.
BANDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Shards above this many fingerprints are searched one component at a time.
LARGE = 1024
#: Pairs that a step of the search may hold, and sorted rows that are worked on at once, about.
PAIRS, ROWS = 2_000_000, 100_000
#: Shards above about this many fingerprints are dealt out further; one fingerprint in so many tells which.
SPLIT, SAMPLED = 1 << 16, 64


def majority(hashes: np.ndarray) -> int:
    """The fingerprint whose bits more than half of the unsigned 64-bit hashes have."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text, unsigned."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined, hash_of = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = np.array([hash_of(joined, SEED)], dtype="<u8")
    else:
        ends = list(accumulate((len(w) + 1 for w in words), initial=-1))
        hashes = np.fromiter((hash_of(joined[a + 1 : b], SEED) for a, b in zip(ends, ends[size:])), dtype="<u8", count=len(words) - size + 1)
    return majority(hashes)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): each document's fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or b"") for t in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["id", "fp"])

    texts = spread(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")))
    return texts.mapInArrow(run, "id long, fp long")


class BKForest:
    """BK-trees over shards, built and searched level by level in numpy.

    ``shard`` names each value's tree; values of a tree are distinct.  The first
    value of a shard is its root.
    """

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        n = len(values)
        self.values = values
        first = np.r_[True, shard[1:] != shard[:-1]] if n else np.zeros(0, bool)
        self.root = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
        self.parent = np.full(n, -1)
        self.edge = np.zeros(n, dtype=np.int16)
        left = np.flatnonzero(~first)
        at = self.root[left]
        while len(left):
            d = np.bitwise_count(values[left] ^ values[at]).astype(np.int64)
            key = at * 65 + d
            order = np.argsort(key, kind="stable")
            left, at, d, key = left[order], at[order], d[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]
            child = left[new]
            self.parent[child], self.edge[child] = at[new], d[new]
            at = np.repeat(child, np.diff(np.r_[np.flatnonzero(new), len(left)]))
            left, at = left[~new], at[~new]
        by_parent = np.argsort(self.parent, kind="stable")
        self.children = by_parent[np.searchsorted(self.parent[by_parent], 0) :]
        kin = self.parent[self.children]
        self.start = np.searchsorted(kin, np.arange(n))
        self.count = np.searchsorted(kin, np.arange(n), side="right") - self.start

    def search(self, asked: np.ndarray, radius: int, alive: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all values within the radius of those at ``asked``, in their own trees.

        With ``alive`` (a count per subtree) branches with none left are skipped.
        """
        q, node, hits = asked, self.root[asked], []
        while len(q):
            d = np.bitwise_count(self.values[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            hits.append((q[near], node[near]))
            count = self.count[node]
            many = np.repeat(np.arange(len(q)), count)
            offset = np.arange(len(many)) - np.repeat(np.cumsum(count) - count, count)
            kid = self.children[self.start[node[many]] + offset]
            keep = np.abs(self.edge[kid] - d[many]) <= radius
            if alive is not None:
                keep &= alive[kid] > 0
            q, node = q[many[keep]], kid[keep]
        if not hits:
            return asked[:0], asked[:0]
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the components of a and b; every label ends as its component's smallest index."""
    while True:
        la, lb = labels[a], labels[b]
        low = np.minimum(la, lb)
        if (la == lb).all():
            return
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _large_shard(values: np.ndarray, radius: int) -> np.ndarray:
    """Labels of one large shard: members that a component already has are taken out of the search."""
    n = len(values)
    tree = BKForest(values, np.zeros(n, dtype=np.int64))
    alive = np.ones(n, dtype=np.int64)
    depth_order = [np.array([0])]
    while len(level := depth_order[-1]):
        count = tree.count[level]
        many = np.repeat(level, count)
        depth_order.append(tree.children[tree.start[many] + np.arange(len(many)) - np.repeat(np.cumsum(count) - count, count)])
    for level in depth_order[:0:-1]:
        np.add.at(alive, tree.parent[level], alive[level])
    there, labels = np.ones(n, dtype=bool), np.arange(n)

    def take(nodes: np.ndarray, label: int) -> None:
        labels[nodes], there[nodes] = label, False
        while len(nodes):
            np.subtract.at(alive, nodes, 1)
            nodes = tree.parent[nodes]
            nodes = nodes[nodes >= 0]

    for seed in range(n):
        if not there[seed]:
            continue
        take(np.array([seed]), seed)
        front = np.array([seed])
        while len(front):
            asked, front = front[:256], front[256:]
            _, node = tree.search(asked, radius, alive)
            node = np.unique(node[there[node]])
            if len(node):
                take(node, seed)
                front = np.r_[front, node]
    return labels


def shard_labels(keys: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For sorted keys, each row's component within its shard: the index of its first member."""
    n = len(keys)
    labels = np.arange(n)
    if not n:
        return labels
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, n])
    for s, size in zip(starts[sizes > LARGE], sizes[sizes > LARGE]):
        labels[s : s + size] = s + _large_shard(values[s : s + size], radius)
    small = np.repeat((sizes > 1) & (sizes <= LARGE), sizes)
    at = np.flatnonzero(small)
    if len(at):
        size_of = np.repeat(sizes, sizes)[at]
        block = np.cumsum(size_of) // PAIRS
        tree = BKForest(values[at], np.repeat(starts, sizes)[at])
        local = np.arange(len(at))
        for b in np.unique(block):
            q, node = tree.search(np.flatnonzero(block == b), radius)
            other = node < q
            _merge(local, q[other], node[other])
        labels[at] = at[local]
    return labels


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first, cut between its values, about ``ROWS`` rows at once."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        if sum(len(h[0]) for h in held) < ROWS * (1 + len(held[0][0]) // ROWS):
            continue
        rows = [np.concatenate(c) for c in zip(*held)]
        held = [rows]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        if cut:
            yield [c[:cut] for c in rows]
            held = [[c[cut:] for c in rows]]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) or (key, fp, node), sorted, to links (a, b) of fingerprints or of nodes, b the first of its component in a shard."""
    for key, fp, *more in whole_keys(batches):
        node = more[0] if more else fp
        new = np.r_[True, (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])][: len(key)]
        first = np.flatnonzero(new)
        root = shard_labels(key[first], fp[first].view(np.uint64))
        other = node[first[root[np.cumsum(new) - 1]]] if len(first) else node
        far = other != node
        yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(other[far])], ["a", "b"])


def shard_keys(fp):
    """The 15 shard keys of a fingerprint column."""
    part = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in BANDS]
    keys = []
    for i in range(len(BANDS)):
        for j in range(i):
            keys.append(F.lit((i * 8 + j) << 24).cast("long").bitwiseOR(F.shiftleft(part[i], BANDS[j][1])).bitwiseOR(part[j]))
    return F.array(*keys)


def rest_bits(fp, pair):
    """The 42 to 44 bits of a fingerprint outside the two bands of a pair (8 * i + j)."""
    def without(i: int, j: int):
        out, at = F.lit(0).cast("long"), 0
        for k, (s, w) in enumerate(BANDS):
            if k not in (i, j):
                out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)), at))
                at += w
        return out

    found = F.lit(0).cast("long")
    for i in range(len(BANDS)):
        for j in range(i):
            found = F.when(pair == i * 8 + j, without(i, j)).otherwise(found)
    return found


def links_within(fps: DataFrame, split: int = SPLIT, sampled: int = SAMPLED) -> DataFrame:
    """Star links (a, b), a != b, of the distinct fingerprints in column ``fp``, or of the rows' ``node`` if ``fps`` has one.

    A shard of more than about ``split`` fingerprints is dealt out by five parts of
    its other bits: two fingerprints within four bits agree on one part at least.
    Which shards are large is told by one fingerprint in ``sampled``; that changes where links are found, not which.
    """
    columns = ["fp", *(["node"] if "node" in fps.columns else [])]
    entries = fps.select(F.explode(shard_keys(F.col("fp"))).alias("key"), *columns)
    few = entries.where(F.pmod(F.xxhash64("fp"), F.lit(sampled)) == 0).groupBy("key").count()
    large = max(split // sampled, 15 * fps.count() // sampled // HOT_KEYS, 1)  # so that at most HOT_KEYS shards are
    hot = materialize(few.where(F.col("count") > large).select("key"), "shards")
    if hot.count():
        rest = rest_bits(F.col("fp"), F.shiftright("key", 24))
        part = lambda k: F.xxhash64("key", F.lit(k), F.shiftrightunsigned(F.col("rest"), 9 * k).bitwiseAND(F.lit(511)))
        parts = entries.join(F.broadcast(hot), "key", "left_semi").withColumn("rest", rest).select(F.explode(F.array(*map(part, range(RADIUS + 1)))).alias("key"), *columns)
        entries = entries.join(F.broadcast(hot), "key", "left_anti").union(parts)
    return entries.repartition("key").sortWithinPartitions("key", *columns).mapInArrow(_stars, "a long, b long").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(a, b): b is the smallest member of a's component, for every a that isn't smallest itself.

    ``links`` are pairs (a, b) of long integers.  Neighbours of a star's centre are never brought together in one task.
    """
    spark = links.sparkSession
    pairs, path = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    least = lambda df: df.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
    before = mark(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(both).withColumn("low", F.least("a", "low"))
        large = lookup(both, low, "a", 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        low = least(large)
        small = lookup(large, low, "a", 2 * before[0]).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", "low")).distinct()
        (pairs, new), old = written(small, "links"), path
        discard(spark, old)
        path, after = new, mark(pairs)
        if after == before:
            break
        before = after
    return pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): each row's fingerprint and the smallest id reachable through links."""
    fps = materialize(with_fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "distinct")
    found = connected(links_within(distinct.select("fp")))
    rooted = distinct.join(found.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "first_id", F.col("n").alias("rows"), F.coalesce("b", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    by_fp = lookup(rooted, smallest, "root", distinct.count()).select("fp", "component_id", F.col("rows").alias("n"))
    return lookup(fps, by_fp, "fp", fps.count()).select("id", "fp", "component_id")


def op2_simhash_bk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
