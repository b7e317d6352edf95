"""Media columns: losslessly stored 8-bit samples in FLAC streams.

``encode`` writes mono 8-bit streams of 192-sample blocks: constant, verbatim,
fixed-predictor or linear-predictor subframes with Rice-coded residuals, and a
seek table.  The decoder reads streams of 4 to 32 bits and one to eight channels:
it decodes Rice partitions (escapes too) and linear predictors, verifies each
frame's CRC-8 and CRC-16 and the stream's MD5, and gives PCM blocks with the sample
offset and the byte offset of each, so that a reader can seek.  Frames of the shape
that ``encode`` writes are decoded in lockstep, all frames of a batch at once, one
sample a step; any other frame goes through a bit reader.

A text's samples are its bytes less 128.  Defined results: a null text is empty;
an empty text is one block of spaces; null media have no blocks; equal bytes give
equal streams; a damaged or cut stream raises ``ValueError``; an empty table gives
no rows; rows with equal or null ids are read one by one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import spread, table

BLOCK = 192
#: Frames between two points of the seek table.
SEEK_EVERY = 64
#: Samples that one step of the encoder or decoder holds.
CHUNK_FRAMES = 6144
RATE = 8000
#: Predictors that the encoder tries, besides constant and verbatim: (fixed order, None) or (order, shift) of an equal-weight linear predictor.
PREDICTORS = ((0, None), (1, None), (2, None), (8, 3))
PRECISION = 5
#: Longest run of zeros that the encoder writes in a Rice code, so that a code fits a 57-bit window.
LONGEST = 15


def _crc_table(polynomial: int, bits: int) -> np.ndarray:
    top, mask, out = 1 << (bits - 1), (1 << bits) - 1, []
    for value in range(256):
        crc = value << (bits - 8)
        for _ in range(8):
            crc = ((crc << 1) ^ polynomial) & mask if crc & top else (crc << 1) & mask
        out.append(crc)
    return np.array(out, dtype=np.int64)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _tables(polynomial_table: np.ndarray, bits: int, length: int) -> np.ndarray:
    """[k, byte]: what a byte with k bytes after it adds to the CRC (CRCs are linear)."""
    mask, rows = (1 << bits) - 1, [polynomial_table]
    for _ in range(length - 1):
        last = rows[-1]
        rows.append(((last << 8) & mask) ^ polynomial_table[last >> (bits - 8)])
    return np.array(rows, dtype=np.uint16)


CRC8_AT, CRC16_AT = _tables(CRC8, 8, 16), _tables(CRC16, 16, 256)


def crc16(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = ((crc << 8) & 0xFFFF) ^ int(CRC16[(crc >> 8) ^ b])
    return crc


def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = int(CRC8[crc ^ b])
    return crc


def coded_number(n: int) -> bytes:
    """A frame number in the extended UTF-8 form of frame headers."""
    if n < 0x80:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1) or k == 7)
    tail = [0x80 | (n >> (6 * i)) & 0x3F for i in range(size - 2, -1, -1)]
    return bytes([(0xFF << (8 - size)) & 0xFF | n >> (6 * (size - 1)), *tail])


HEADERS: list[bytes] = []


def _headers(upto: int) -> list[bytes]:
    """Frame headers, CRC-8 included, of 192-sample mono 8-bit blocks with the numbers below ``upto``."""
    for n in range(len(HEADERS), upto):
        head = b"\xff\xf8\x14\x02" + coded_number(n)  # 192 samples, 8 kHz; mono, 8 bits
        HEADERS.append(head + bytes([crc8(head)]))
    return HEADERS


def residual(samples: np.ndarray, order: int, shift: int | None) -> np.ndarray:
    """What is left of each row from sample ``order`` on."""
    if shift is None:
        return np.diff(samples, n=order, axis=1) if order else samples
    sums = np.cumsum(samples, axis=1, dtype=np.int32)
    before = np.concatenate([np.zeros((len(samples), 1), np.int32), sums], axis=1)
    return samples[:, order:] - ((before[:, order:-1] - before[:, : -order - 1]) >> shift)


def encode_blocks(samples: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """FLAC frames of the rows of ``samples`` (n, 192; int16), numbered so."""
    n = len(samples)
    best = np.full(n, 8 * BLOCK)  # verbatim
    kind, rice = np.full(n, -1), np.zeros(n, dtype=np.int64)
    zigzags = []
    for i, (order, shift) in enumerate(PREDICTORS):
        r = residual(samples, order, shift)
        z = ((r << 1) ^ (r >> 15)).astype(np.uint16)
        zigzags.append(z)
        sums, most = z.sum(axis=1, dtype=np.int64), z.max(axis=1)
        # the parameter near log2 of the mean, or above, so that no code is too long
        k = np.log2(np.maximum(sums, 1) / z.shape[1] * 0.75 + 0.5).astype(np.int64).clip(1, 9)
        while (over := most >> k > LONGEST).any():
            k[over] += 1
        fixed = 8 * order + 10 + (0 if shift is None else 9 + PRECISION * order)
        bits = fixed + (k + 1) * z.shape[1] + (z >> k[:, None].astype(np.uint16)).sum(axis=1, dtype=np.int64)
        better = bits < best
        best[better], kind[better], rice[better] = bits[better], i, k[better]
    kind[(samples == samples[:, :1]).all(axis=1)] = -2
    bodies: list[bytes] = [b""] * n
    unsigned = (samples & 0xFF).astype(np.uint8)
    for i in np.flatnonzero(kind == -2):
        bodies[i] = bytes([0, unsigned[i, 0]])
    for i in np.flatnonzero(kind == -1):
        bodies[i] = b"\x02" + unsigned[i].tobytes()
    for code in np.unique(kind[kind >= 0] * 16 + rice[kind >= 0]):
        p, k = int(code) // 16, int(code) % 16
        rows = np.flatnonzero((kind == p) & (rice == k))
        order, shift = PREDICTORS[p]
        head = 8 + order if shift is None else 31 + order
        bit_head = np.unpackbits(np.array([head << 1], dtype=np.uint8))
        warm = np.unpackbits(unsigned[rows, :order], axis=1) if order else np.zeros((len(rows), 0), np.uint8)
        fields = []
        if shift is not None:
            fields = [(PRECISION - 1, 4), (shift, 5), *[(1, PRECISION)] * order]
        fields += [(0, 2), (0, 4), (k, 4)]
        middle = np.array([v >> b & 1 for v, w in fields for b in range(w - 1, -1, -1)], dtype=np.uint8)
        z = zigzags[p][rows].astype(np.int64)
        q = z >> k
        fixed = 8 + warm.shape[1] + len(middle)
        ends = np.cumsum(q + (k + 1), axis=1)
        total = (fixed + ends[:, -1] + 7) // 8
        base = np.r_[0, np.cumsum(total)[:-1]] * 8
        bits = np.zeros(int(total.sum()) * 8, dtype=np.uint8)
        front = np.concatenate([np.tile(bit_head, (len(rows), 1)), warm, np.tile(middle, (len(rows), 1))], axis=1)
        bits[base[:, None] + np.arange(fixed)] = front
        at = (base + fixed)[:, None] + ends  # just after each code
        bits[at - (k + 1)] = 1
        for b in range(k):
            bits[at - (b + 1)] = (z >> b) & 1
        packed = np.packbits(bits).tobytes()
        for i, s, t in zip(rows.tolist(), (base // 8).tolist(), total.tolist()):
            bodies[i] = packed[s : s + t]
    heads = _headers(int(numbers.max(initial=-1)) + 1)
    frames = [heads[i] + b for i, b in zip(numbers.tolist(), bodies)]
    sizes = np.array([len(f) for f in frames])
    data = np.frombuffer(b"".join(frames), dtype=np.uint8)
    ends = np.cumsum(sizes)
    behind = np.repeat(ends, sizes) - 1 - np.arange(len(data))
    checks = np.bitwise_xor.reduceat(CRC16_AT[behind, data], ends - sizes) if n else []
    return [f + int(c).to_bytes(2, "big") for f, c in zip(frames, checks)]


def _metadata(pcm: bytes, sizes: list[int]) -> bytes:
    total = len(pcm)
    info = BLOCK.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
    info += (RATE << 44 | 0 << 41 | 7 << 36 | total).to_bytes(8, "big") + hashlib.md5(pcm).digest()
    points, at = [], 0
    for i, size in enumerate(sizes):
        if i % SEEK_EVERY == 0:
            points.append((i * BLOCK).to_bytes(8, "big") + at.to_bytes(8, "big") + BLOCK.to_bytes(2, "big"))
        at += size
    seek = b"".join(points)
    return b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of byte strings whose lengths are positive multiples of 192."""
    counts = [len(p) // BLOCK for p in payloads]
    if any(c == 0 or len(p) % BLOCK for c, p in zip(counts, payloads)):
        raise ValueError("a payload must be a positive multiple of 192 bytes")
    samples = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, BLOCK).astype(np.int16) - 128
    numbers = np.concatenate([np.arange(c) for c in counts]) if counts else np.zeros(0, np.int64)
    frames: list[bytes] = []
    for i in range(0, len(samples), CHUNK_FRAMES):
        frames += encode_blocks(samples[i : i + CHUNK_FRAMES], numbers[i : i + CHUNK_FRAMES])
    out, at = [], 0
    for payload, count in zip(payloads, counts):
        own = frames[at : at + count]
        at += count
        pcm = (np.frombuffer(payload, dtype=np.uint8) ^ 0x80).tobytes()
        out.append(_metadata(pcm, [len(f) for f in own]) + b"".join(own))
    return out


class _Bits:
    """A reader of single fields, for frames of any shape."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def take(self, n: int) -> int:
        if self.at + n > 8 * len(self.data):
            raise ValueError("the stream ends within a frame")
        first, last = self.at // 8, (self.at + n + 7) // 8
        value = int.from_bytes(self.data[first:last], "big") >> (8 * last - self.at - n) & ((1 << n) - 1)
        self.at += n
        return value

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value - (1 << n) if n and value >> (n - 1) else value

    def unary(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


#: Fixed values of frame headers: bits a sample, of the codes that aren't reserved (0: as the stream says).
WIDTHS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}
#: Block sizes by code; 6 and 7 stand for a field of one or two bytes.
SIZES = {1: 192} | {c: 576 << (c - 2) for c in range(2, 6)} | {c: 256 << (c - 8) for c in range(8, 16)}


def _subframe(bits: _Bits, size: int, depth: int) -> list[int]:
    """The ``size`` samples, of ``depth`` bits, of one channel."""
    if bits.take(1):
        raise ValueError("bad subframe header")
    kind = bits.take(6)
    wasted = 1 + bits.unary() if bits.take(1) else 0
    depth -= wasted
    if depth < 1:
        raise ValueError("no bits are left of a sample")
    if kind == 0:
        samples = [bits.signed(depth)] * size
    elif kind == 1:
        samples = [bits.signed(depth) for _ in range(size)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        samples = [bits.signed(depth) for _ in range(order)]
        if kind >= 32:
            precision, shift = bits.take(4) + 1, bits.signed(5)
            if precision == 16 or shift < 0:
                raise ValueError("bad linear predictor")
            weights = [bits.signed(precision) for _ in range(order)]
        else:
            shift, weights = 0, [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order]
        method, parts = bits.take(2), 1 << bits.take(4)
        if method > 1 or size % parts or size // parts < order:
            raise ValueError("bad residual coding")
        field = 4 + method
        for part in range(parts):
            k, count = bits.take(field), size // parts - (order if part == 0 else 0)
            raw = bits.take(5) if k == (1 << field) - 1 else None
            for _ in range(count):
                if raw is not None:
                    r = bits.signed(raw)
                else:
                    z = bits.unary() << k
                    z |= bits.take(k) if k else 0
                    r = (z >> 1) ^ -(z & 1)
                samples.append(r + (sum(w * s for w, s in zip(weights, reversed(samples[len(samples) - order :]))) >> shift if order else 0))
        low, high = -1 << (depth - 1), 1 << (depth - 1)
        if not all(low <= v < high for v in samples):
            raise ValueError("a sample is out of range")
    else:
        raise ValueError(f"reserved subframe {kind}")
    return [v << wasted for v in samples] if wasted else samples


def read_frame(data: bytes, at: int, stated: tuple[int, int] = (1, 8)) -> tuple[int, int, np.ndarray, int]:
    """(number, variable blocking?, samples, end) of the frame at byte ``at`` of a stream with the stated channels and bits.

    Samples have a row for each instant, and a column for each channel where there are several.
    """
    bits = _Bits(data, at)
    if bits.take(15) != 0x7FFC:
        raise ValueError(f"no frame at byte {at}")
    variable = bits.take(1)
    size_code, rate_code, layout, width, _ = bits.take(4), bits.take(4), bits.take(4), bits.take(3), bits.take(1)
    lead = bits.take(8)
    more = next(i for i in range(8) if not lead & (0x80 >> i)) if lead < 0xFF else 8
    if lead == 0xFF or more == 1:
        raise ValueError("bad frame number")
    number = lead & (0x7F >> more)
    for _ in range(max(0, more - 1)):
        number = number << 6 | bits.take(8) & 0x3F
    size = bits.take(8 * (size_code - 5)) + 1 if size_code in (6, 7) else SIZES.get(size_code)
    if rate_code in (12, 13, 14):
        bits.take(8 if rate_code == 12 else 16)
    if crc8(data[at : bits.at // 8]) != bits.take(8):
        raise ValueError(f"header checksum at byte {at}")
    channels, depth = (layout + 1 if layout < 8 else 2), WIDTHS.get(width, stated[1] if width == 0 else 0)
    if not size or rate_code == 15 or layout > 10 or (channels, depth) != tuple(stated):
        raise ValueError(f"the frame at byte {at} isn't of the stream's shape")
    side = {8: 1, 9: 0, 10: 1}.get(layout)  # the channel that is a difference has a bit more
    columns = [np.array(_subframe(bits, size, depth + (c == side)), dtype=np.int64) for c in range(channels)]
    if layout == 8:
        columns[1] = columns[0] - columns[1]
    elif layout == 9:
        columns[0] = columns[0] + columns[1]
    elif layout == 10:
        twice = columns[0] << 1 | columns[1] & 1
        columns = [(twice + columns[1]) >> 1, (twice - columns[1]) >> 1]
    end = -(-bits.at // 8)
    if end + 2 > len(data) or crc16(data[at:end]) != int.from_bytes(data[end : end + 2], "big"):
        raise ValueError(f"frame checksum at byte {at}")
    return number, variable, columns[0] if channels == 1 else np.stack(columns, axis=1), end + 2


def _lockstep(data: np.ndarray, start: np.ndarray, body: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Decode frames whose subframe begins at byte ``body``; True where ``out`` holds the samples and the frame ends where its bits do.

    Handles constant, verbatim, and one-partition Rice subframes of 192 samples; others give False.
    """
    n = len(start)
    end = np.zeros(n, dtype=np.int64)
    head = data[body]
    kind = head >> 1
    done = (head & 1) == 0
    flat, plain = np.flatnonzero(done & (kind == 0)), np.flatnonzero(done & (kind == 1))
    out[flat] = data[body[flat] + 1].astype(np.int8)[:, None]
    end[flat] = body[flat] + 2
    out[plain] = data[np.minimum(body[plain][:, None] + 1 + np.arange(BLOCK), len(data) - 1)].view(np.int8)
    end[plain] = body[plain] + 1 + BLOCK
    ok = np.zeros(n, dtype=bool)
    ok[flat] = ok[plain] = True
    rows = np.flatnonzero(done & ((kind >= 8) & (kind <= 12) | (kind >= 32)))
    orders = np.where(kind < 32, kind - 8, kind.astype(np.int64) - 31).astype(np.int64)
    rows = rows[np.argsort(orders[rows], kind="stable")]
    if not len(rows):
        return np.where(ok & (end + 2 <= len(data)), end + 2, -1)
    order, code = orders[rows], kind[rows]
    low = int(body.min())
    words = np.concatenate([data[low : int(body.max()) + 300], np.zeros(16, np.uint8)])
    wide = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(words, 8)).view(">u8")[:, 0].astype(np.uint64)
    most = len(wide) - 1

    def window(at):  # 57 bits or more from each bit position
        return wide[np.minimum(at >> 3, most)] << (at & 7).astype(np.uint64)

    at = (body[rows] - low + 1 + order) * 8
    good = np.ones(len(rows), dtype=bool)
    lpc = np.flatnonzero(code >= 32)
    shift, weights = np.zeros(len(rows), dtype=np.int64), np.zeros((len(rows), int(order[lpc].max(initial=0))), dtype=np.int64)
    if len(lpc):
        w = window(at[lpc])
        precision, shift[lpc] = (w >> np.uint64(60)).astype(np.int64) + 1, ((w >> np.uint64(55)) & np.uint64(31)).astype(np.int64)
        good[lpc] &= (precision < 16) & (shift[lpc] < 16)
        at[lpc] += 9
        for i in range(weights.shape[1]):
            some = order[lpc] > i
            p = precision[some]
            value = (window(at[lpc[some]]) >> (64 - p).astype(np.uint64)).astype(np.int64)
            weights[lpc[some], i] = value - ((value >> (p - 1)) << p)
            at[lpc[some]] += p
    w = window(at)
    good &= (w >> np.uint64(58)) == 0  # four-bit parameters, one partition
    k = ((w >> np.uint64(54)) & np.uint64(15)).astype(np.int64)
    good &= k < 15
    at += 10
    codes = np.zeros((BLOCK, len(rows)), dtype=np.int64)
    left = np.searchsorted(order, BLOCK - np.arange(BLOCK), side="left")  # rows with a code at each step
    down = (63 - k).astype(np.uint64)
    longest = np.zeros(len(rows), dtype=np.int64)
    for i in range(BLOCK - int(order[0])):
        m = left[i]
        w = window(at[:m])
        # leading zeros, from the exponent of the upper 53 bits
        q = 1075 - ((w >> np.uint64(11)).astype(np.float64).view(np.int64) >> 52)
        np.maximum(longest[:m], q, out=longest[:m])
        w = (w << q.astype(np.uint64).clip(0, 63)) >> down[:m]  # the stop bit and the k bits after it
        codes[i, :m] = ((q - 1) << k[:m]) + w.view(np.int64)
        at[:m] += q + 1 + k[:m]
    good &= longest + k < 50
    end[rows] = ((at + 7) >> 3) + low
    codes = np.ascontiguousarray(codes.T)
    codes = (codes >> 1) ^ -(codes & 1)
    for o in np.unique(order):
        for linear in (False, True):
            part = np.flatnonzero((order == o) & ((code >= 32) == linear))
            if not len(part):
                continue
            warm = data[np.minimum((body[rows[part]] + 1)[:, None] + np.arange(o), len(data) - 1)].astype(np.int8).astype(np.int64) if o else np.zeros((len(part), 0), np.int64)
            r = np.concatenate([warm, codes[part, : BLOCK - o]], axis=1)
            if linear:
                _predict(r, int(o), weights[part, :o], shift[part])
            else:
                for level in range(int(o), 0, -1):  # undo the differences, from the innermost on
                    r[:, o - 1] = np.diff(warm, n=level - 1, axis=1)[:, -1]
                    r[:, o - 1 :] = np.cumsum(r[:, o - 1 :], axis=1)
                r[:, :o] = warm
            out[rows[part]] = r
            ok[rows[part]] = good[part] & (r >= -128).all(axis=1) & (r < 128).all(axis=1)
    return np.where(ok & (end + 2 <= len(data)), end + 2, -1)


def _predict(r: np.ndarray, order: int, weights: np.ndarray, shift: np.ndarray) -> None:
    """Turn each row's warm-up samples and residuals into samples, in place."""
    columns = np.ascontiguousarray(r.T)
    if (weights == 1).all():
        running = columns[:order].sum(axis=0)
        for i in range(order, BLOCK):
            columns[i] += running >> shift
            running += columns[i] - columns[i - order]
    else:
        turned = np.ascontiguousarray(weights[:, ::-1].T)
        for i in range(order, BLOCK):
            columns[i] += (columns[i - order : i] * turned).sum(axis=0) >> shift
    r[:] = columns.T


def _frame_starts(data: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(start, subframe byte) of all frames, if they are 192-sample 8-bit mono frames numbered from 0 on."""
    at = first + np.flatnonzero((data[first:-1] == 0xFF) & (data[first + 1 :] == 0xF8))
    at = at[at + 8 < len(data)]
    at = at[(data[at + 2] == 0x14) & (data[at + 3] == 0x02)]
    starts, bodies, number = [], [], 0
    raw = data.tobytes()
    heads = _headers(len(at) + 1)
    for a in at.tolist():
        head = heads[number]
        if raw.startswith(head, a) and a + len(head) < len(raw):
            starts.append(a)
            bodies.append(a + len(head))
            number += 1
    if not starts or starts[0] != first:
        return None
    return np.array(starts), np.array(bodies)


def parse_metadata(stream: bytes) -> tuple[dict, int]:
    """The stream's properties and seek points, and where the frames begin."""
    if stream[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, found = 4, 0, {"seek": []}
    while not last:
        head = stream[at : at + 4]
        size = int.from_bytes(head[1:], "big")
        body = stream[at + 4 : at + 4 + size]
        if len(head) < 4 or len(body) < size:
            raise ValueError("the stream ends within its metadata")
        last, kind = head[0] >> 7, head[0] & 0x7F
        if (kind == 0) != (at == 4) or kind == 0 and size != 34 or kind == 3 and size % 18:
            raise ValueError("bad metadata")
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            found |= {"rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & ((1 << 36) - 1), "md5": body[18:34]}
        elif kind == 3:
            found["seek"] = [(int.from_bytes(body[i : i + 8], "big"), int.from_bytes(body[i + 8 : i + 16], "big")) for i in range(0, size, 18)]
        at += 4 + size
    if found["bits"] < 4:
        raise ValueError("fewer than 4 bits a sample")
    return found, at


def shape(info: dict) -> tuple[int, int]:
    return info["channels"], info["bits"]


def as_pcm(samples: np.ndarray, bits: int) -> np.ndarray:
    """The samples in the smallest type of whole bytes that numpy has."""
    return samples.astype(np.int8 if bits <= 8 else "<i2" if bits <= 16 else "<i4")


def pcm_bytes(pcm: np.ndarray, bits: int) -> bytes:
    """Interleaved little-endian samples of the least whole number of bytes."""
    if 16 < bits <= 24:
        return np.ascontiguousarray(pcm).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return pcm.tobytes()


def decode_many(streams: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each stream: PCM samples (``as_pcm``), and the sample and byte offset of each block."""
    out: list = [None] * len(streams)
    fast, starts, bodies, owner, base = [], [], [], [], 0
    joined = []
    for i, stream in enumerate(streams):
        info, first = parse_metadata(stream)
        data = np.frombuffer(stream, dtype=np.uint8)
        found = _frame_starts(data, first) if shape(info) == (1, 8) else None
        if found is not None and len(found[0]) * BLOCK == info["samples"]:
            fast.append((i, info, found[0]))
            starts.append(found[0] + base)
            bodies.append(found[1] + base)
            owner.append(np.full(len(found[0]), base + len(stream)))
            joined.append(data)
            base += len(stream)
        else:
            out[i] = decode_slow(stream)
    if fast:
        joined.append(np.zeros(16, np.uint8))  # the last frame may be cut
        data, s, b, stop = map(np.concatenate, (joined, starts, bodies, owner))
        after = np.r_[s[1:], base]
        after = np.minimum(after, stop)
        # the next frame of the same stream begins where this one ends; the stream's end closes the last
        samples = np.zeros((len(s), BLOCK), dtype=np.int16)
        end = np.concatenate([_lockstep(data, s[j : j + CHUNK_FRAMES], b[j : j + CHUNK_FRAMES], samples[j : j + CHUNK_FRAMES]) for j in range(0, len(s), CHUNK_FRAMES)])
        last = np.zeros(len(s), dtype=bool)
        last[np.cumsum([len(x[2]) for x in fast]) - 1] = True
        expected = np.where(last, stop, after)
        good = end == expected
        size = np.where(good & (end - s <= 258), end - s, 3)
        flat = np.repeat(s, size - 2) + np.arange(int((size - 2).sum())) - np.repeat(np.cumsum(size - 2) - (size - 2), size - 2)
        behind = np.repeat(np.cumsum(size - 2), size - 2) - 1 - np.arange(len(flat))
        check = np.bitwise_xor.reduceat(CRC16_AT[behind, data[flat]], np.cumsum(size - 2) - (size - 2))
        good &= check == data[s + size - 2].astype(np.uint16) << 8 | data[s + size - 1]
        at = 0
        for i, info, found in fast:
            n = len(found)
            if not good[at : at + n].all():
                out[i] = decode_slow(streams[i])  # finds the damaged frame, or reads what isn't of this shape
            else:
                pcm = samples[at : at + n].astype(np.int8).reshape(-1)
                _verify(pcm, info)
                out[i] = (pcm, np.arange(n) * BLOCK, found)
            at += n
    return out


def _verify(pcm: np.ndarray, info: dict) -> None:
    if info["samples"] and len(pcm) != info["samples"]:
        raise ValueError("the stream has other than its stated samples")
    if any(info["md5"]) and hashlib.md5(pcm_bytes(pcm, info["bits"])).digest() != info["md5"]:
        raise ValueError("the samples' MD5 differs")


def decode_slow(stream: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One stream, frame by frame, of any blocking."""
    info, at = parse_metadata(stream)
    blocks, offsets, places, total = [], [], [], 0
    while at < len(stream):
        _, _, samples, end = read_frame(stream, at, shape(info))
        blocks.append(as_pcm(samples, info["bits"]))
        offsets.append(total)
        places.append(at)
        total, at = total + len(samples), end
    pcm = np.concatenate(blocks) if blocks else as_pcm(np.zeros(0), info["bits"])
    _verify(pcm, info)
    return pcm, np.array(offsets, dtype=np.int64), np.array(places, dtype=np.int64)


def seek(stream: bytes, sample: int, count: int) -> np.ndarray:
    """``count`` samples from ``sample`` on, decoding from the nearest seek point only."""
    info, first = parse_metadata(stream)
    at_sample, at = max(((s, first + o) for s, o in info["seek"] if s <= sample), default=(0, first))
    out: list[np.ndarray] = []
    while at < len(stream) and at_sample < sample + count:
        _, _, samples, at = read_frame(stream, at, shape(info))
        out.append(as_pcm(samples, info["bits"])[max(0, sample - at_sample) : sample + count - at_sample])
        at_sample += len(samples)
    return np.concatenate(out) if out else as_pcm(np.zeros(0), info["bits"])


def payload(text: bytes) -> bytes:
    return text + b" " * (-len(text) % BLOCK or (0 if text else BLOCK))


class Features:
    """Peak, energy and sign changes of the blocks it is given, in order."""

    def __init__(self):
        self.peak = self.energy = self.crossings = 0
        self.last = None

    def add(self, pcm: np.ndarray) -> None:
        wide, negative = pcm.astype(np.int64), np.signbit(pcm)
        self.peak = max(self.peak, int(np.abs(wide).max(initial=0)))
        self.energy += int((wide * wide).sum())
        self.crossings += int((negative[1:] != negative[:-1]).sum()) + (self.last is not None and len(pcm) > 0 and bool(negative[0]) != self.last)
        if len(pcm):
            self.last = bool(negative[-1])

    def __str__(self) -> str:
        return f"peak={self.peak};energy={self.energy};crossings={self.crossings}"


def store_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's bytes, padded with spaces, as a FLAC stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            media = encode([payload(t) for t in texts])
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "id long, n_bytes long, media binary")


#: PCM blocks that are handed on at once.
BLOCKS = 4096


def read_blocks(streams: list[bytes]) -> Iterator[tuple[int, dict, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(stream, its properties, first block, sample offsets, byte offsets, ends, samples) for every 4,096 verified blocks; offsets are the stream's, and samples begin at the first of them."""
    for i, (pcm, offsets, places) in enumerate(decode_many(streams)):
        info, _ = parse_metadata(streams[i])
        ends = np.r_[offsets[1:], len(pcm)]
        for j in range(0, len(offsets), BLOCKS):
            part = slice(j, j + BLOCKS)
            yield i, info, j, offsets[part], places[part], ends[part], pcm[offsets[j] : ends[part][-1]]


def pcm_blocks(media: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id, block, sample_offset, byte_offset, n_samples, channels, bits, pcm): the verified PCM blocks of FLAC streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, streams in _chunks(batches):
            for i, info, first, offsets, places, ends, pcm in read_blocks(streams):
                n, base = len(offsets), offsets[0]
                rows = [pcm_bytes(pcm[a:b], info["bits"]) for a, b in zip(offsets - base, ends - base)]
                columns = [pa.array([ids[i].as_py()] * n, pa.int64()), pa.array(np.arange(first, first + n)), pa.array(offsets), pa.array(places), pa.array(ends - offsets)]
                columns += [pa.array([v] * n, pa.int32()) for v in shape(info)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.binary())], ["id", "block", "sample_offset", "byte_offset", "n_samples", "channels", "bits", "pcm"])

    source = media.where(F.col(media_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media"))
    return source.mapInArrow(run, "id long, block long, sample_offset long, byte_offset long, n_samples long, channels int, bits int, pcm binary")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return spread(docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")))


def _chunks(batches: Iterator[pa.RecordBatch], budget: int = 1_000_000):
    """(ids, values) of about ``budget`` bytes each."""
    for batch in batches:
        values = [v.as_py() for v in batch.column(1)]
        start, used = 0, 0
        for i, v in enumerate(values):
            used += len(v)
            if used >= budget or i + 1 == len(values):
                yield batch.column(0).slice(start, i + 1 - start), values[start : i + 1]
                start, used = i + 1, 0


class _Digest:
    """What the PCM blocks of one stored text amount to."""

    def __init__(self):
        self.sha, self.features, self.bytes, self.blocks, self.tail = hashlib.sha256(), Features(), 0, 0, b""

    def add(self, pcm: np.ndarray, blocks: int) -> None:
        back = (pcm.view(np.uint8) ^ 0x80).tobytes()
        self.sha.update(back)
        self.features.add(pcm)
        self.bytes += len(back)
        self.blocks += blocks
        self.tail = (self.tail + back[-16:])[-16:]


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text as FLAC, read the stored stream's PCM blocks back, and digest them."""
    schema = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            media = encode([payload(t) for t in texts])
            digests = [_Digest() for _ in media]
            for i, _, _, offsets, _, _, pcm in read_blocks(media):
                digests[i].add(pcm, len(offsets))
            rows = [(len(t), d.bytes, d.sha.hexdigest(), zlib.crc32(d.tail), len(m), hashlib.sha256(m).hexdigest(), str(d.features), d.blocks) for t, m, d in zip(texts, media, digests)]
            columns = [ids, *(pa.array(list(c)) for c in zip(*rows))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_blocks"])

    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def op1_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as FLAC and read back."""
    return media_digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
