"""Encoding and decoding with a piece vocabulary: the N best segmentations of a text.

A text's lattice has an edge for every vocabulary piece between two of its
positions, and an edge of byte pieces for a character that is no piece.  Forward
Viterbi scores of all positions are exact estimates of what remains, so a
backward A-star search from the end pops complete segmentations best first.

No piece has a line end, a tab, or a space after another character, so the lattice falls apart at the
words.  Words' best segmentations and the loss of their second best are found
in lockstep for all new words of a batch and kept in a bounded cache.  Of the N
best texts, only words with one of the N - 1 smallest losses can differ from
their best, so the A-star search runs on those words, and their N best are combined.
Scores are integers (thousandths of a nat) from the
pieces' ranks by Zipf's law, so sums don't depend on their order.

Defined results: null text is empty and has no pieces; decoding gives the text
back exactly, white space included; ties go to the choice found first, which is
fixed; repeated rows give equal results; an empty table gives no rows; columns
besides the id and the text aren't read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidelake.llm.common import spread, table, worker_state

MODEL = "piece_bpe_32k.model"
N_BEST = 4
#: Words that a worker's cache may hold, and the longest of them.
CACHE, LONGEST = 400_000, 64
#: Score of one byte piece, and what each piece costs besides its rank's logarithm.
BYTE_SCORE, EACH = -14_000, 3_000
#: Of the polynomial hash by which many words' pieces are found at once.
MULTIPLIER = 0x9E3779B97F4A7C15
NEVER, NO_SECOND = -(1 << 60), 1 << 60
#: Low bits of a hash by which most texts that are no piece are told.
LOW = (1 << 18) - 1
#: Characters of texts that are worked on at once, about; and bytes of ids that are decoded at once.
CHARACTERS, BATCH = 1_000_000, 8 << 20
SEGMENTS = "id long, text string, scores array<long>, ids array<binary>"
#: Words, and single line ends and tabs: no piece has such a character, or a space after another one.
CHUNK = re.compile(r" *[^ \t\n]+|[\t\n]| +")


class Lattice:
    """A vocabulary with scores, and the search over it."""

    def __init__(self, pieces: dict[str, tuple[int, int]], byte_ids: list[int], n: int = N_BEST):
        """``pieces``: text to (id, score), spaces as spaces; ``byte_ids``: the id of each byte value."""
        self.pieces, self.byte_ids, self.n = pieces, byte_ids, n
        self.longest = max(map(len, pieces), default=1)
        if any(re.search(r"[\t\n]|[^ ] ", t) for t in pieces):
            raise ValueError("a piece goes over a word's end")
        self.bytes_of: dict[int, bytes] = {i: t.encode() for t, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.forget()
        self.listed: dict[str, list] = {}
        by_length: dict[int, list] = {}
        for text, (id_, score) in pieces.items():
            by_length.setdefault(len(text), []).append((self._hash(text), score, id_, text))
        #: for each length: sorted hashes, scores, ids and characters of its pieces, and which low hash bits occur
        self.by_length = {}
        for size, rows in by_length.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            codes = np.frombuffer("".join(r[3] for r in rows).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, size)
            there = np.zeros(LOW + 1, dtype=bool)
            there[hashes & np.uint64(LOW)] = True
            self.by_length[size] = (hashes, np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), codes, there)
        hashes = [r[0] for rows in by_length.values() for r in rows]
        self.lockstep_works = len(set(hashes)) == len(hashes)
        # all ids' bytes in one array, for decoding many ids at once
        top = max(self.bytes_of, default=0) + 1
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(top)) or b" ", np.uint8)
        self.piece_size = np.array([len(self.bytes_of.get(i, b"")) for i in range(top)], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size

    def forget(self) -> None:
        """Empty the cache of words: where each word's ids lie in one array, its score, and its loss."""
        self.index: dict[str, int] = {}
        self.ids, self.used = np.zeros(4096, "<u4"), 0
        self.start, self.size, self.score, self.loss = (np.zeros(1024, np.int64) for _ in range(4))

    def _add(self, words: list[str], ids: np.ndarray, sizes, scores, losses) -> None:
        first, last = len(self.index), len(self.index) + len(words)
        while last > len(self.score):
            self.start, self.size, self.score, self.loss = (np.concatenate([x, x]) for x in (self.start, self.size, self.score, self.loss))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[first:last], self.score[first:last], self.loss[first:last] = sizes, scores, losses
        self.start[first:last] = self.used + np.cumsum(self.size[first:last]) - self.size[first:last]
        self.used += len(ids)
        self.index.update(zip(words, range(first, last)))

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * MULTIPLIER + ord(c)) & 0xFFFFFFFFFFFFFFFF
        return h

    @classmethod
    def load(cls, path: str, n: int = N_BEST) -> Lattice:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte_ids, pieces, rank = [0] * 256, {}, 0
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                rank += 1
                pieces[model.id_to_piece(i).replace("▁", " ")] = (i, -EACH - round(1000 * math.log(rank)))
        return cls(pieces, byte_ids, n)

    def edges(self, text: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """For each end position, (start, score, ids) of the edges that lead to it."""
        size = len(text)
        into: list[list] = [[] for _ in range(size + 1)]
        get, longest = self.pieces.get, self.longest
        for i in range(size):
            for j in range(i + 1, min(size, i + longest) + 1):
                found = get(text[i:j])
                if found is not None:
                    into[j].append((i, found[1], (found[0],)))
                elif j == i + 1:
                    ids = tuple(self.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass"))
                    into[j].append((i, BYTE_SCORE * len(ids), ids))
        return into

    def best_and_loss(self, text: str) -> tuple[int, tuple[int, ...], int]:
        """(score, ids, loss) of the best segmentation; loss: how much less the second best scores.

        The second best has an edge that the best hasn't, so it is the best one through such an edge.
        """
        into, size = self.edges(text), len(text)
        best, back = [0] * (size + 1), [None] * (size + 1)
        for j in range(1, size + 1):
            top = None
            for edge in into[j]:
                value = best[edge[0]] + edge[1]
                if top is None or value > top:
                    top, back[j] = value, edge
            best[j] = top
        rest = [None] * (size + 1)
        rest[size], second = 0, None
        for j in range(size, 0, -1):
            after = rest[j]
            if after is None:
                continue
            for edge in into[j]:
                i, value = edge[0], edge[1] + after
                if rest[i] is None or value > rest[i]:
                    rest[i] = value
        on_path, j, ids = set(), size, []
        while j:
            on_path.add(id(back[j]))
            ids.append(back[j][2])
            j = back[j][0]
        for j in range(1, size + 1):
            after = rest[j]
            if after is not None:
                for edge in into[j]:
                    value = best[edge[0]] + edge[1] + after
                    if (second is None or value > second) and id(edge) not in on_path:
                        second = value
        return best[size], tuple(x for part in reversed(ids) for x in part), (NO_SECOND if second is None else best[size] - second)

    def n_best(self, text: str, n: int | None = None) -> list[tuple[int, tuple[int, ...]]]:
        """(score, ids) of the best segmentations, best first."""
        n = n or self.n
        into = self.edges(text)
        best = [0] * (len(text) + 1)
        for j in range(1, len(text) + 1):
            best[j] = max(best[i] + s for i, s, _ in into[j])
        # an entry: (-estimate, position, serial, score from here to the end, ids of the edge, entry after it)
        heap, serial, out = [(-best[-1], len(text), 0, 0, (), None)], 0, []
        while heap and len(out) < n:
            entry = heapq.heappop(heap)
            _, at, _, score, _, _ = entry
            if at == 0:
                ids: list[int] = []
                while entry is not None:
                    ids += entry[4]
                    entry = entry[5]
                out.append((score, tuple(ids)))
                continue
            for i, s, ids in into[at]:
                serial += 1
                heapq.heappush(heap, (-(best[i] + s + score), i, serial, score + s, ids, entry))
        return out

    def learn(self, words: list[str]) -> None:
        """Put the distinct words' best segmentations and losses into the cache, many words a step."""
        new = [w for w in words if w not in self.index]
        if len(self.index) + len(new) > CACHE:
            self.forget()
            new = words
        if self.lockstep_works:
            short = sorted((w for w in new if len(w) <= LONGEST), key=len)
            for i in range(0, len(short), 8192):
                self._lockstep(short[i : i + 8192])
        for w in new:
            if w not in self.index:
                score, ids, loss = self.best_and_loss(w)
                self._add([w], np.array(ids, "<u4"), len(ids), score, loss)

    def _lockstep(self, words: list[str]) -> None:
        n = len(words)
        lens = np.array([len(w) for w in words])
        size = int(lens.max())
        codes = np.zeros((size, n), dtype=np.uint64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        column = np.repeat(np.arange(n), lens)
        codes[np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens), column] = flat
        prefix = np.zeros((size + 1, n), dtype=np.uint64)
        factor = np.uint64(MULTIPLIER)
        for j in range(size):
            prefix[j + 1] = prefix[j] * factor + codes[j]
        scores, ids, power = {}, {}, 1
        plain = np.ones(n, dtype=bool)  # every character is a piece
        for width in range(1, min(self.longest, size) + 1):
            power = power * MULTIPLIER & 0xFFFFFFFFFFFFFFFF
            if width not in self.by_length:
                continue
            table, values, id_of, letters, low = self.by_length[width]
            h = prefix[width:] - prefix[:-width] * np.uint64(power)
            at, word = np.nonzero(low[h & np.uint64(LOW)] & (np.arange(width, size + 1)[:, None] <= lens))
            place = np.minimum(np.searchsorted(table, h[at, word]), len(table) - 1)
            same = (letters[place] == codes[at[:, None] + np.arange(width), word[:, None]]).all(axis=1)
            at, word, place = at[same], word[same], place[same]
            scores[width], ids[width] = np.full(h.shape, NEVER), np.zeros(h.shape, np.int64)
            scores[width][at, word], ids[width][at, word] = values[place], id_of[place]
            there = scores[width] != NEVER
            if width == 1:
                plain = (there | (np.arange(size)[:, None] >= lens)).all(axis=0)
        best, back = np.full((size + 1, n), NEVER), np.zeros((size + 1, n), dtype=np.int64)
        best[0] = 0
        widths = sorted(scores, reverse=True)
        for j in range(1, size + 1):
            for width in widths:
                if width <= j:
                    value = best[j - width] + scores[width][j - width]
                    more = value > best[j]
                    best[j][more], back[j][more] = value[more], width
        rest = np.full((size + 1, n), NEVER)
        rest[lens, np.arange(n)] = 0
        for i in range(size - 1, -1, -1):
            for width in widths:
                if i + width <= size:
                    np.maximum(rest[i], scores[width][i] + rest[i + width], out=rest[i])
        second = np.full(n, 4 * NEVER)
        total = best[lens, np.arange(n)]
        through = {w: best[: size + 1 - w] + scores[w] + rest[w:] for w in widths}
        at, steps = np.where(plain, lens, 0), []
        while at.any():
            live = np.flatnonzero(at > 0)
            width = back[at[live], live]
            step = np.full(n, -1, dtype=np.int64)
            for w in np.unique(width):
                own = live[width == w]
                start = at[own] - w
                step[own] = ids[int(w)][start, own]
                through[int(w)][start, own] = NEVER
            steps.append(step)
            at[live] -= width
        for w in widths:
            np.maximum(second, through[w].max(axis=0), out=second)
        loss = np.where(second > NEVER // 2, total - second, NO_SECOND)
        chain = np.array(steps[::-1]).T if steps else np.zeros((n, 0), dtype=np.int64)
        sizes, good = (chain >= 0).sum(axis=1), np.flatnonzero(plain)  # words with a byte piece have no chain
        self._add([words[i] for i in good], chain[chain >= 0], sizes[good], total[good], loss[good])

    def choices_of(self, text: str) -> list[tuple[int, tuple[int, ...]]]:
        """``n_best`` of a word, through a cache of its own."""
        found = self.listed.get(text)
        if found is None:
            if len(self.listed) >= CACHE // 10:
                self.listed.clear()
            found = self.n_best(text)
            if len(text) <= LONGEST:
                self.listed[text] = found
        return found

    def mixes(self, scores: np.ndarray, losses: np.ndarray, chunks: list[str]) -> list[tuple[int, list[tuple[int, tuple[int, ...]]]]]:
        """Each of the N best of a text as (score, [(word, its ids)] where they aren't the best's)."""
        total, n = int(scores.sum()), self.n - 1
        least = np.partition(losses, n - 1)[n - 1] if 0 < n < len(losses) else NO_SECOND
        open_ = sorted((lost, i) for i in np.flatnonzero(losses <= least).tolist() if (lost := int(losses[i])) < NO_SECOND)[:n]
        choices = {i: self.choices_of(chunks[i]) for _, i in open_}
        # word by word, the N best mixes so far with each of the word's choices
        mixes: list[tuple[int, tuple]] = [(0, ())]
        for _, i in open_:
            first = choices[i][0][0]
            mixes = sorted([(lost + first - found[0], (*changed, (i, c)) if c else changed) for lost, changed in mixes for c, found in enumerate(choices[i])])[: self.n]
        return [(total - lost, sorted((i, choices[i][c][1]) for i, c in changed)) for lost, changed in mixes]

    def encode_many(self, texts: list[str]) -> list[list[tuple[int, bytes]]]:
        """(score, ids as little-endian 32-bit integers) of the N best segmentations of each text."""
        cut = [CHUNK.findall(" " + t) if t else [] for t in texts]
        words = pa.array([c for chunks in cut for c in chunks], pa.string()).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        self.learn(distinct)
        at = np.array([self.index[w] for w in distinct], np.int64)[words.indices.to_numpy()] if distinct else np.zeros(0, np.int64)
        size = self.size[at]
        after = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[at] - (after - size), size) + np.arange(int(size.sum()))]
        raw, after = ids.tobytes(), np.r_[0, after]
        out, word = [], 0
        for chunks in cut:
            if not chunks:
                out.append([(0, b"")])
                continue
            own = slice(word, word + len(chunks))
            begin, end, rows = int(after[word]), int(after[own.stop]), []
            for score, changed in self.mixes(self.score[at[own]], self.loss[at[own]], chunks):
                done, parts = begin, []
                for i, other in changed:
                    parts += [raw[4 * done : 4 * int(after[word + i])], array("I", other).tobytes()]
                    done = int(after[word + i + 1])
                parts.append(raw[4 * done : 4 * end])
                rows.append((score, b"".join(parts)))
            out.append(rows)
            word = own.stop
        return out

    def encode_n_best(self, text: str) -> list[tuple[int, tuple[int, ...]]]:
        """(score, ids) of the N best segmentations of a whole text."""
        return [(score, tuple(memoryview(raw).cast("I"))) for score, raw in self.encode_many([text])[0]]

    def decoded(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes, and where each ends, of many segmentations of ``sizes`` ids each, without the spaces put before them."""
        size, start = self.piece_size[ids], self.piece_start[ids]
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        size[first] -= 1
        start[first] += 1
        after = np.cumsum(size)
        where = np.repeat(start - (after - size), size)
        where += np.arange(len(where))
        ends = np.r_[0, after][np.cumsum(sizes)]
        return self.piece_bytes[where], ends

    def decode(self, ids) -> str:
        """The text of ids, without the space put before it."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def vocabulary_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def lattice_of(path: str | None, n: int) -> Lattice:
    """A worker's lattice."""
    where = path or vocabulary_path()
    state = worker_state()
    return state.get(("lattice", where, n)) or state.setdefault(("lattice", where, n), Lattice.load(where, n))


def segment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, n: int = N_BEST) -> DataFrame:
    """(id, text, scores, ids) of every text: its N best segmentations, best first, each as little-endian 32-bit ids.

    ``path``: the vocabulary file, the same on every worker; by default the installed public one.
    """
    return texts_of(docs, id_col, text_col).mapInArrow(segmenter(path, n), SEGMENTS)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return spread(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))


def segmenter(path: str | None = None, n: int = N_BEST) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``segment`` on batches of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_of(path, n)
        for batch in batches:
            texts, start = [v.as_py() or "" for v in batch.column(1)], 0
            while start < len(texts):
                stop, used = start, 0
                while stop < len(texts) and used < CHARACTERS:
                    used += len(texts[stop])
                    stop += 1
                rows, part = lattice.encode_many(texts[start:stop]), batch.slice(start, stop - start)
                scores, ids = pa.array([[s for s, _ in r] for r in rows], pa.list_(pa.int64())), pa.array([[b for _, b in r] for r in rows], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, scores, ids], ["id", "text", "scores", "ids"])
                start = stop

    return run


def decode(segments: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``segments`` with ``decoded``: the texts of the segmentations in column ``ids_col``."""
    schema = StructType([*segments.schema.fields, StructField("decoded", ArrayType(StringType()))])
    return segments.mapInArrow(decoder(ids_col, path), schema)


def decoder(ids_col: str = "ids", path: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``decode`` on batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_of(path, N_BEST)
        for batch in batches:
            column, start, held = batch.column(batch.schema.get_field_index(ids_col)), 0, 0
            for i, each in enumerate(column):
                held += sum(len(b.as_buffer()) for b in each.values) if each.is_valid else 0
                if held >= BATCH or i + 1 == len(column):
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, texts_back(lattice, column.slice(start, i + 1 - start))], [*part.schema.names, "decoded"])
                    start, held = i + 1, 0

    return run


def texts_back(lattice: Lattice, column: pa.ListArray) -> pa.ListArray:
    """The texts of a column of lists of segmentations; null lists stay null."""
    flat = column.flatten()
    raw = [b.as_py() for b in flat]
    data, ends = lattice.decoded(np.frombuffer(b"".join(raw), "<u4"), np.array([len(b) // 4 for b in raw], np.int64))
    texts = pa.StringArray.from_buffers(len(raw), pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(data))
    sizes = [0 if n is None else n for n in pc.list_value_length(column).to_pylist()]
    offsets = np.r_[0, np.cumsum(np.array(sizes, np.int64))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), texts, mask=column.is_null())


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and checksums of segmentations and of their decoded texts."""
    for batch in batches:
        rows = []
        for text, scores, ids, back in zip(*(batch.column(k) for k in range(1, 5))):
            raw, whole = [b.as_buffer() for b in ids.values], text.as_buffer() if text.is_valid else pa.py_buffer(b"")
            texts = [t.as_buffer() for t in back.values]
            crcs = [zlib.crc32(b) for b in raw]
            rows.append((raw[0].size // 4, crcs[0], ",".join(map(str, scores.as_py())), ",".join(map(str, crcs)), hashlib.sha256(texts[0]).hexdigest(), all(t.equals(whole) for t in texts)))
        columns = [batch.column(0), *(pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_())))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids_crc32", "n_best_scores", "n_best_crc32", "decoded_sha256", "exact"])


def op9_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The N best segmentations of every document, decoded again; checksums stand for ids (little-endian, 32 bits) and texts."""
    encode_batches, decode_batches = segmenter(), decoder()  # in one worker, which holds one lattice
    schema = "doc_id long, n_pieces long, ids_crc32 long, n_best_scores string, n_best_crc32 string, decoded_sha256 string, exact boolean"
    return texts_of(table(spark, sf_dir, "documents")).mapInArrow(lambda batches: digests(decode_batches(encode_batches(batches))), schema)
