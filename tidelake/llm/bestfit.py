"""Packing token sequences into bins by best-fit decreasing.

Lengths are whole numbers up to the bin size, so the plan needs a count for each
length only: pieces go in by falling length, each into the tightest open bin
that holds it, which a segment tree over remaining capacities finds in
logarithmic time; pieces of one length go in as runs, with the same outcome as
one by one.  The plan is a list of runs (length, ranks from..to, first bin,
pieces a bin, offset).  Its size depends on the bin size, not on the input.
Ranks come from counts by (length, salt), so no length is sorted in one task.

Defined results: null text is empty, that is, the separator only; a document
longer than a bin is cut into whole bins and a rest; ties go by salt, id, piece
and a hash of the token ids; ids are binary, little-endian 32-bit integers; repeated rows are packed each; an empty table gives no rows; other
columns aren't read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import materialize, spread, table, worker_state

MODEL = "word_bpe_49k.json"
CAPACITY = 2048
SEPARATOR = 0
#: Pieces of one length that a task ranks, about.
RANKED = 1 << 20
#: Strings that each of a worker's caches may hold, and the longest of them.
CACHE, LONGEST = 300_000, 64
#: Plan runs that may be broadcast.
PLAN_ROWS = 200_000
#: Bytes of ids that go out at once, about.
BATCH = 8 << 20


class CapacityTree:
    """A segment tree over remaining capacities 0..size that tells which have open bins."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = [False] * (2 * self.leaves)

    def set(self, capacity: int, open_: bool) -> None:
        at = self.leaves + capacity
        self.some[at] = open_
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least capacity of ``need`` or more that has an open bin."""
        at = self.leaves + need
        if self.some[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.some[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, first bin, pieces a bin, offset) of best-fit decreasing over counts of lengths."""
    tree, open_, runs, bins = CapacityTree(capacity), {}, [], 0
    for length in sorted(counts, reverse=True):
        rank, count = 0, counts[length]
        while rank < count:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                room, first, n = capacity, bins, -(-(count - rank) // each)
                bins += n
            else:
                first, n = open_[room].pop()
                if not open_[room]:
                    tree.set(room, False)
                each = room // length
            full = min(n, (count - rank) // each)
            took = min(full * each, count - rank)
            rest = 0
            if full < n and rank + took < count:
                rest = count - rank - took  # fewer than a bin's share are left
            runs.append((length, rank, rank + took + rest, first, each, capacity - room))
            for left, start, many in ((room - each * length, first, full), (room - rest * length, first + full, 1 if rest else 0), (room, first + full + (1 if rest else 0), n - full - (1 if rest else 0))):
                if many > 0 and left > 0:
                    open_.setdefault(left, []).append((start, many))
                    tree.set(left, True)
            rank += took + rest
    return runs


#: The last code point that the word pattern knows; texts with one beyond it, lower-cased, go to the tokenizer whole.
LAST = 0x24F


def _word_pattern() -> tuple[re.Pattern, re.Pattern]:
    """The vocabulary's word pattern for characters up to ``LAST``, and what makes a text go to the tokenizer whole.

    Python's ``split`` takes U+001C..U+001F for white space, and the vocabulary doesn't.
    """
    def class_of(kinds: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(LAST + 1) if unicodedata.category(chr(c))[0] in kinds)

    letters, numbers, space = class_of("L"), class_of("N"), "\t\n\x0b\x0c\r \x85\xa0"
    words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
    return words, re.compile(f"[^\x00-\x1b\x20-{chr(LAST)}]")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is visible, else the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class Known(dict):
    """Ids of strings; those that aren't there are encoded, and kept within bounds."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        found = self.encode(text)
        if len(text) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[text] = found
        return found


class WordEncoder:
    """Token ids of texts through bounded caches of space-separated strings and of words; equal to the tokenizer's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern, self.odd = _word_pattern()
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.words = Known(self.word)
        self.strings = Known(lambda s: b"".join(map(self.words.__getitem__, self.pattern.findall(s))))

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def word(self, text: str) -> bytes:
        """Ids of one match of the word pattern, by the merges alone."""
        named = text if text.isascii() and text.isprintable() else "".join([self.letters[b] for b in text.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(named)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        low = text.lower()
        if self.odd.search(low) or not (text.isascii() or unicodedata.is_normalized("NFC", text)) or any(s in text for s in self.special):
            return self.whole(text)
        return b"".join(map(self.strings.__getitem__, low.split()))


def vocabulary_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids): each document's ids and the separator, cut at the bin size."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or vocabulary_path()
        state = worker_state()
        encoder = state.get(("words", where)) or state.setdefault(("words", where), WordEncoder(where))
        for batch in batches:
            rows, held = [], 0
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = encoder.encode(value.as_py() or "") + SEPARATOR.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((i, piece, at // 4, len(part) // 4, part))
                    held += len(part)
                    if held >= BATCH:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)

    source = spread(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))
    return source.mapInArrow(run, "id long, piece int, start long, length long, ids binary")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces``, with a ``hash`` of the row that breaks ties, and with ``sequence_id`` and ``offset``; their ``length`` is 1 to ``capacity``.  They are read twice."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    salts = max(64, -(-max(counts.values()) // RANKED))
    salted = pieces.withColumn("_salt", F.pmod("hash", F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("length", "_salt").orderBy("id", "piece", "hash")
    ranked = salted.withColumn("_own", F.row_number().over(own) - 1).join(firsts, ["length", "_salt"]).withColumn("_rank", F.col("_first") + F.col("_own"))
    runs = spark.createDataFrame(plan(counts, capacity), "length long, _from long, _to long, _bin long, _each long, _base long")
    found = ranked.join(F.broadcast(runs) if runs.count() <= PLAN_ROWS else runs, "length").where("_rank >= _from AND _rank < _to")
    place = F.col("_rank") - F.col("_from")
    return found.select(*pieces.columns, (F.col("_bin") + F.floor(place / F.col("_each"))).cast("long").alias("sequence_id"), (F.col("_base") + place % F.col("_each") * F.col("length")).cast("long").alias("offset"))


def packed(docs: DataFrame, capacity: int = CAPACITY, payload: Column | None = None) -> DataFrame:
    """Every document's pieces, packed, with their token ids, or with ``payload`` computed of ``ids`` before anything is shuffled."""
    pieces = token_pieces(docs, capacity=capacity).withColumn("hash", F.xxhash64("id", "piece", "ids"))
    wanted = F.col("ids") if payload is None else payload
    pieces = materialize(pieces.select("id", "piece", "start", "length", wanted, "hash"), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", "doc_id").drop("hash")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): packed pieces put together, each sequence's token ids in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda ids, part: F.concat(ids, part["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))


def op10_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences; a checksum stands for each piece's ids."""
    found = packed(table(spark, sf_dir, "documents"), payload=F.crc32("ids").alias("ids_crc32"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's product: every document's pieces with their token ids and their places in sequences.

    Rows without an id or a text are packed like others; an empty table gives no rows.
    """
    return packed(docs)
