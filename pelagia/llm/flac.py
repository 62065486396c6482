"""FLAC media columns: encode 8-bit mono samples, verify and decode frames, write PCM blocks with sample offsets.

A stored form is a FLAC stream: STREAMINFO, a SEEKTABLE with a point for every frame, and frames of a fixed block size.  The
decoder reads constant, verbatim, fixed-predictor and linear-predictor subframes with partitioned Rice residuals (both
parameter widths and the escape code) and checks CRC-8 of each header, CRC-16 of each frame and the stream's MD5.

The seek table gives every frame's start, so the frames of a whole batch are decoded side by side: step n restores sample n of
all frames at once.  The same holds for the checksums and for the encoder.

Cases: a null or empty text is stored as its padding alone; a stream that is cut short, has a wrong checksum or uses what this
decoder doesn't read (other widths than 8 bits, more than one channel) raises ValueError; equal payloads give equal streams.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1024
RATE = 8000
ORDER = 4  # of the encoder's linear predictor
PRECISION = 12
ROWS = 500  # texts that are coded side by side
TOGETHER = 2048  # frames that are restored side by side

#: Coefficients of the format's fixed predictors, orders 0 to 4.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    out = []
    for c in range(256):
        c <<= bits - 8
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
        out.append(c)
    return np.array(out, np.uint32)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = int(CRC8[c ^ b])
    return c


def crc16_rows(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-16 of the first length[i] bytes of each row."""
    c = np.zeros(len(rows), np.uint32)
    order = np.argsort(-length, kind="stable")
    c, rows, length = c[order], np.ascontiguousarray(rows[order].T), length[order]
    live = np.searchsorted(-length, -np.arange(rows.shape[0]), side="left")  # rows with more than n bytes
    for n in range(rows.shape[0]):
        k = live[n]
        if not k:
            break
        v = c[:k]
        c[:k] = ((v << np.uint32(8)) & np.uint32(0xFFFF)) ^ CRC16[(v >> np.uint32(8)) ^ rows[n, :k]]
    out = np.empty_like(c)
    out[order] = c
    return out


def _utf8_number(n: int) -> bytes:
    """A frame number, coded like a UTF-8 code point of up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    room = 6
    while True:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        room -= 1
        if n < 1 << room:
            return bytes([0xFF << (room + 1) & 0xFF | n, *reversed(tail)])


def _header(number: int, size: int) -> bytes:
    code, extra = {192: (1, b""), 1024: (10, b"")}.get(size, (7, (size - 1).to_bytes(2, "big")))
    head = bytes([0xFF, 0xF8, code << 4, 0 << 4 | 1 << 1]) + _utf8_number(number) + extra
    return head + bytes([crc8(head)])


# ---------------------------------------------------------------------------------------------
# Encoding


def _zigzag(e: np.ndarray) -> np.ndarray:
    return (e << 1) ^ (e >> 31)


def _linear(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients and shifts of a linear predictor for each row, by autocorrelation and Levinson's recursion."""
    f = x.astype(np.float64) * np.hanning(x.shape[1] + 2)[1:-1]
    r = np.stack([(f[:, k:] * f[:, : f.shape[1] - k]).sum(1) for k in range(ORDER + 1)], 1)
    err = np.where(r[:, 0] > 0, r[:, 0], 1.0)
    a = np.zeros((len(x), ORDER))
    for i in range(ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / err
        new = a.copy()
        new[:, i] = k
        new[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a, err = new, np.maximum(err * (1 - k * k), 1e-9)
    a = np.nan_to_num(np.clip(a, -7.9, 7.9))
    most = np.maximum(np.abs(a).max(1), 1e-9)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(most * 1.0001)), 0, 12).astype(np.int32)
    return np.clip(np.rint(a * (1 << shift)[:, None]), -(1 << PRECISION - 1), (1 << PRECISION - 1) - 1).astype(np.int32), shift


def _residuals(x: np.ndarray, order: int, coef: np.ndarray | None = None, shift: np.ndarray | None = None) -> np.ndarray:
    if coef is None:
        e = x
        for _ in range(order):
            e = np.diff(e, axis=1)
        return e
    n = x.shape[1]
    p = sum(coef[:, j : j + 1] * x[:, order - 1 - j : n - 1 - j] for j in range(order))
    return x[:, order:] - (p >> shift[:, None])


def _rice_cost(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits and the parameter of the cheaper of two Rice codes of each row, around the mean's logarithm."""
    u = _zigzag(e)
    mean = u.mean(1) if u.shape[1] else np.zeros(len(u))
    guess = np.clip(np.log2(np.maximum(mean, 1) * 0.7).astype(np.int64), 0, 8)
    cost = np.stack([(u >> (guess + d)[:, None].astype(u.dtype)).sum(1, dtype=np.int64) + u.shape[1] * (guess + d + 1) for d in (0, 1)], 1)
    return cost.min(1), guess + cost.argmin(1)


class _Bits:
    """Fields of given widths, for many frames: a matrix of bits."""

    @staticmethod
    def of(values: np.ndarray, width: int) -> np.ndarray:
        return ((values[..., None] >> np.arange(width - 1, -1, -1)) & 1).astype(np.uint8).reshape(*values.shape[:-1], -1)


def _rice_bits(e: np.ndarray, k: int) -> list[np.ndarray]:
    """The Rice code of each row, as bits."""
    u = _zigzag(e)
    q = u >> k
    width = q + 1 + k
    ends = np.cumsum(width, 1)
    total = ends[:, -1]
    base = np.concatenate([[0], np.cumsum(total)[:-1]])
    out = np.zeros(int(total.sum()), np.uint8)
    stop = base[:, None] + ends - k - 1
    out[stop.ravel()] = 1
    for j in range(k):
        out[(stop + 1 + j).ravel()] = ((u >> (k - 1 - j)) & 1).ravel()
    return np.split(out, np.cumsum(total)[:-1])


def _encode_frames(x: np.ndarray, numbers: list[int]) -> list[bytes]:
    """Frames of the rows of x (all of one length), each by its cheapest subframe."""
    rows, n = x.shape
    plain = 8 + 8 * n
    same = (x == x[:, :1]).all(1)
    options = []  # cost, parameter, order, coefficients, shift, residuals
    for order in (0, 1, 2):
        if n > order:
            e = _residuals(x, order)
            cost, k = _rice_cost(e)
            options.append((8 + 8 * order + 10 + cost, k, order, None, None, e))
    if n > ORDER:
        coef, shift = _linear(x)
        e = _residuals(x, ORDER, coef, shift)
        cost, k = _rice_cost(e)
        options.append((8 + 8 * ORDER + 9 + PRECISION * ORDER + 10 + cost, k, ORDER, coef, shift, e))
    costs = np.stack([np.full(rows, plain), *[o[0] for o in options]], 1)
    best = np.where(same, -1, costs.argmin(1))
    body: list[np.ndarray] = [np.empty(0, np.uint8)] * rows
    for r in np.flatnonzero(same):
        body[r] = _Bits.of(np.array([0, int(x[r, 0]) & 255]), 8)
    for r in np.flatnonzero(best == 0):
        body[r] = _Bits.of(np.concatenate([[2], x[r] & 255]), 8)
    for i, (_, k, order, coef, shift, e) in enumerate(options, 1):
        for p in np.unique(k[best == i]):
            at = np.flatnonzero((best == i) & (k == p))
            for r, code in zip(at, _rice_bits(e[at], int(p)), strict=True):
                kind = 0x40 | (order - 1) << 1 if coef is not None else 0x10 | order << 1
                head = [_Bits.of(np.array([kind]), 8), _Bits.of(x[r, :order] & 255, 8)]
                if coef is not None:
                    head += [_Bits.of(np.array([PRECISION - 1]), 4), _Bits.of(shift[r : r + 1] & 31, 5), _Bits.of(coef[r] & ((1 << PRECISION) - 1), PRECISION)]
                body[r] = np.concatenate([*head, _Bits.of(np.array([0]), 2), _Bits.of(np.array([0]), 4), _Bits.of(np.array([p]), 4), code])
    frames = [_header(m, n) + np.packbits(b).tobytes() for m, b in zip(numbers, body, strict=True)]
    length = np.array([len(f) for f in frames])
    packed = np.zeros((rows, int(length.max())), np.uint8)
    for r, f in enumerate(frames):
        packed[r, : len(f)] = np.frombuffer(f, np.uint8)
    return [f + int(c).to_bytes(2, "big") for f, c in zip(frames, crc16_rows(packed, length), strict=True)]


def encode_batch(payloads: list[bytes], block: int = BLOCK) -> list[bytes]:
    """A FLAC stream of each payload; its bytes are the samples plus 128."""
    by_size: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for i, p in enumerate(payloads):
        x = np.frombuffer(p, np.uint8).astype(np.int32) - 128
        for m in range(0, len(x), block):
            part = x[m : m + block]
            by_size.setdefault(len(part), []).append((i, m // block, part))
    frames: dict[tuple[int, int], bytes] = {}
    for jobs in by_size.values():
        for a in range(0, len(jobs), 512):
            some = jobs[a : a + 512]
            for (i, m, _), f in zip(some, _encode_frames(np.stack([j[2] for j in some]), [j[1] for j in some]), strict=True):
                frames[i, m] = f
    out = []
    for i, p in enumerate(payloads):
        own = [frames[i, m] for m in range((len(p) + block - 1) // block)]
        sizes = [len(f) for f in own] or [0]
        signed = (np.frombuffer(p, np.uint8) ^ np.uint8(128)).tobytes()
        info = block.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + hashlib.md5(signed).digest()
        seek, at = b"", 0
        for m, f in enumerate(own):
            seek += (m * block).to_bytes(8, "big") + at.to_bytes(8, "big") + min(block, len(p) - m * block).to_bytes(2, "big")
            at += len(f)
        # A block's length field has 24 bits: longer tables go on in further blocks of the same type.
        tables = [seek[a : a + 18 * 900_000] for a in range(0, len(seek), 18 * 900_000)]
        meta = b"\x00" + len(info).to_bytes(3, "big") + info
        meta += b"".join(bytes([3 | (0x80 if t == len(tables) - 1 else 0)]) + len(x).to_bytes(3, "big") + x for t, x in enumerate(tables))
        out.append(b"fLaC" + meta + b"".join(own))
    return out


# ---------------------------------------------------------------------------------------------
# Decoding


def _metadata(data: bytes) -> tuple[int, int, bytes, list[tuple[int, int, int]], int]:
    """Block size, samples, MD5, seek points and where the frames begin."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, points, info = 4, False, [], None
    while not last:
        last, kind, size = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        if len(body) < size:
            raise ValueError("the metadata is cut short")
        if kind == 0:
            info = body
        elif kind == 3:
            points += [(int.from_bytes(body[p : p + 8], "big"), int.from_bytes(body[p + 8 : p + 16], "big"), int.from_bytes(body[p + 16 : p + 18], "big")) for p in range(0, size, 18)]
        at += 4 + size
    if info is None:
        raise ValueError("no STREAMINFO")
    word = int.from_bytes(info[10:18], "big")
    if word >> 41 & 7 or (word >> 36 & 31) != 7:
        raise ValueError("only one channel of 8 bits is read")
    return int.from_bytes(info[:2], "big"), word & (1 << 36) - 1, info[18:34], points, at


def _frame_header(f: bytes) -> tuple[int, int, int]:
    """Number, block size and length of a frame's header, after its CRC-8."""
    if len(f) < 6 or f[0] != 0xFF or f[1] != 0xF8:
        raise ValueError("no frame where the seek table has one")
    lead = f[4]
    more = 0 if lead < 0x80 else 8 - (~lead & 0xFF).bit_length() - 1
    number = lead if not more else lead & (0x7F >> (more + 1))
    for b in f[5 : 5 + more]:
        number = number << 6 | b & 0x3F
    at, code = 5 + more, f[2] >> 4
    if code == 6:
        size, at = f[at] + 1, at + 1
    elif code == 7:
        size, at = int.from_bytes(f[at : at + 2], "big") + 1, at + 2
    else:
        size = 192 if code == 1 else 576 << code - 2 if 2 <= code <= 5 else 256 << code - 8
    if crc8(f[:at]) != f[at]:
        raise ValueError("a frame header's CRC-8 is wrong")
    return number, size, at + 1


#: Leading zeros of each 16-bit number.
ZEROS = np.array([16 - int(v).bit_length() for v in range(1 << 16)], np.uint64)
U = np.uint64


def _windows(packed: np.ndarray) -> np.ndarray:
    """The 64 bits that begin at each byte, row after row; the last 8 bytes of a row are padding."""
    flat = np.concatenate([packed.ravel(), np.zeros(8, np.uint8)])
    out = np.zeros(packed.size, U)
    for j in range(8):
        out |= flat[j : j + packed.size].astype(U) << U(56 - 8 * j)
    return out


def _restore(packed: np.ndarray, at: np.ndarray, order: np.ndarray, n: np.ndarray, coef: np.ndarray, shift: np.ndarray, y: np.ndarray) -> None:
    """Fill y (samples by rows) from Rice residuals at bit `at`; rows are sorted by n, the largest first.

    coef[j] multiplies the sample j + 1 back; y holds the warm-up samples already.
    """
    limit = packed.shape[1] * 8
    window = _windows(packed)
    base = (np.arange(len(n)) * limit).astype(U)
    pos = base + at.astype(U)
    last = base + U(limit - 64)

    def peek(rows: slice | np.ndarray) -> np.ndarray:
        p = np.minimum(pos[rows], last[rows])
        return window[p >> U(3)] << (p & U(7))

    every = slice(0, len(n))
    v = peek(every)
    wide = (v >> U(62)).astype(np.int64)
    parts = (v >> U(58) & U(15)).astype(np.int64)
    if (wide > 1).any():
        raise ValueError("a reserved residual coding")
    pos += U(6)
    size = n >> parts
    room = np.where(order < size, size - order, 0)  # residuals until the next parameter
    k = np.zeros(len(n), U)
    raw = np.full(len(n), -1, np.int64)
    fresh = np.ones(len(n), bool)
    top = int(order.max())
    live = np.searchsorted(-n, -np.arange(int(n[0])), side="left")  # rows that have a sample s
    reach = [np.flatnonzero((coef[j] != 0) | (order > j)) for j in range(len(coef))]
    reach = [j for j, r in enumerate(reach) if len(r)]
    for s in range(int(n[0])):
        m = int(live[s])
        rows = slice(0, m)
        on = s >= order[:m] if s < top else None
        need = fresh[:m] if on is None else fresh[:m] & on
        while need.any():
            g = np.flatnonzero(need)
            v = peek(g)
            width = np.where(wide[g] == 1, 5, 4).astype(U)
            new = v >> (U(64) - width)
            pos[g] += width
            k[g], raw[g] = new, -1
            esc = new == (U(1) << width) - U(1)
            if esc.any():
                h = g[esc]
                raw[h] = (peek(h) >> U(59)).astype(np.int64)
                pos[h] += U(5)
            fresh[g] = room[g] == 0  # a partition may hold none
            room[g] = np.where(room[g] == 0, size[g], room[g])
            need = np.zeros(m, bool)
            need[g] = fresh[g]
        v = peek(rows)
        q = ZEROS[v >> U(48)]
        kk = k[:m]
        far = q == U(16)
        if far.any():
            plain = raw[:m] < 0
            far &= plain if on is None else plain & on
            g = np.flatnonzero(far)
            while len(g):
                pos[g] += U(16)
                if (pos[g] > last[g] + U(64)).any():
                    raise ValueError("a residual is cut short")
                more = ZEROS[peek(g) >> U(48)]
                q[g] += more
                g = g[more == U(16)]
            if far.any():
                pos[:m][far] -= q[far] // U(16) * U(16)
                ahead = np.minimum(pos[:m] + q + U(1), last[:m])
                low = window[ahead >> U(3)] << (ahead & U(7))
            else:
                low = v << (q + U(1))
        else:
            low = v << (q + U(1))
        u = (q << kk | low >> U(1) >> (U(63) - kk)).view(np.int64)
        e = u >> 1 ^ -(u & 1)
        step = q + U(1) + kk
        odd = np.flatnonzero(raw[:m] >= 0)
        if len(odd):
            w = raw[odd]
            x = peek(odd).view(np.int64)
            e[odd] = np.where(w > 0, x >> (64 - np.maximum(w, 1)), 0)
            step[odd] = w.astype(U)
        if reach:
            p = coef[reach[0], :m] * y[s - 1 - reach[0], :m] if s > reach[0] else np.zeros(m, np.int64)
            for j in reach[1:]:
                if s > j:
                    p = p + coef[j, :m] * y[s - 1 - j, :m]
            e = e + (p >> shift[:m])
        if on is None:
            y[s, :m] = e
            pos[:m] += step
            room[:m] -= 1
            fresh[:m] = room[:m] == 0
        else:
            y[s, :m] = np.where(on, e, y[s, :m])
            pos[:m] += np.where(on, step, U(0))
            room[:m] -= on
            fresh[:m] |= on & (room[:m] == 0)
        np.copyto(room[:m], size[:m], where=fresh[:m] & (s >= order[:m]))
    if (pos > last + U(64)).any():
        raise ValueError("a residual is cut short")


def _bits_at(packed: np.ndarray, at: np.ndarray, width: int, signed: bool = False) -> np.ndarray:
    """The number of `width` bits at bit at[i] of each row."""
    v = np.zeros(len(packed), np.int64)
    rows = np.arange(len(packed))
    for j in range(4):
        v = v << 8 | packed[rows, (at >> 3) + j]
    v = v >> (32 - width - (at & 7)) & ((1 << width) - 1)
    return np.where(v >> (width - 1) == 1, v - (1 << width), v) if signed else v


def _decode_frames(frames: list[bytes], sizes: list[int], begins: list[int]) -> list[np.ndarray]:
    """Samples of each frame; sizes: how many it holds; begins: where its subframe starts."""
    order_of = sorted(range(len(frames)), key=lambda r: -sizes[r])
    frames, n, at = [frames[r] for r in order_of], np.array([sizes[r] for r in order_of]), np.array([begins[r] for r in order_of])
    length = np.array([len(f) for f in frames])
    packed = np.zeros((len(frames), int(length.max()) + 16), np.uint8)
    for r, f in enumerate(frames):
        packed[r, : len(f)] = np.frombuffer(f, np.uint8)
    rows = np.arange(len(frames))
    if (crc16_rows(packed, length - 2) != (packed[rows, length - 2].astype(np.uint32) << 8 | packed[rows, length - 1])).any():
        raise ValueError("a frame's CRC-16 is wrong")
    kind = packed[rows, at]
    if (kind & 0x81).any():
        raise ValueError("wasted bits or a reserved bit")
    kind = kind >> 1
    signed = packed.view(np.int8)
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(frames)
    for r in np.flatnonzero(kind == 0):
        out[order_of[r]] = np.full(n[r], signed[r, at[r] + 1], np.int8)
    for r in np.flatnonzero(kind == 1):
        if at[r] + 1 + n[r] + 2 > length[r]:
            raise ValueError("a verbatim subframe is cut short")
        out[order_of[r]] = signed[r, at[r] + 1 : at[r] + 1 + n[r]].copy()
    coded = np.flatnonzero(kind > 1)
    if not len(coded):
        return out
    kind, at, n, packed, signed = kind[coded], at[coded], n[coded], packed[coded], signed[coded]
    linear = kind >= 32
    if ((kind < 8) | (kind > 12) & ~linear).any():
        raise ValueError("a reserved subframe")
    order = np.where(linear, (kind & 31) + 1, kind & 7).astype(np.int64)
    most = int(order.max())
    coef, shift, pos = np.zeros((max(most, 1), len(coded)), np.int64), np.zeros(len(coded), np.int64), (at + 1 + order) * 8
    y = np.zeros((int(n[0]), len(coded)), np.int64)
    for j in range(most):
        g = np.flatnonzero(order > j)
        y[j, g] = signed[g, at[g] + 1 + j]
    for o in np.unique(order[~linear]):
        for j in range(o):
            coef[j, (order == o) & ~linear] = FIXED[o][j]
    if linear.any():
        g = np.flatnonzero(linear)
        precision = _bits_at(packed[g], pos[g], 4) + 1
        shift[g] = _bits_at(packed[g], pos[g] + 4, 5, True)
        if (shift[g] < 0).any() or (precision > 15).any():
            raise ValueError("a negative shift or a reserved precision")
        for p in np.unique(precision):
            for j in range(most):
                h = g[(precision == p) & (order[g] > j)]
                if len(h):
                    coef[j, h] = _bits_at(packed[h], pos[h] + 9 + j * int(p), int(p), True)
        pos[g] += 9 + precision * order[g]
    _restore(packed, pos, order, n, coef, shift, y)
    samples = np.ascontiguousarray(y.T).astype(np.int8)
    for r, c in enumerate(coded):
        out[order_of[c]] = samples[r, : n[r]]
    return out


def decode_batch(streams: list[bytes]) -> list[list[tuple[int, np.ndarray]]]:
    """For each stream its blocks, (first sample, samples), all checksums verified."""
    jobs: list[tuple[int, int, bytes, int, int]] = []
    want = []
    for i, data in enumerate(streams):
        block, samples, md5, points, start = _metadata(data)
        want.append((samples, md5))
        ends = [p[1] for p in points[1:]] + [len(data) - start]
        for (first, at, size), end in zip(points, ends, strict=bool(points)):
            f = data[start + at : start + end]
            number, n, head = _frame_header(f)
            if n != size or number * block != first:
                raise ValueError("a frame isn't the one that the seek table names")
            jobs.append((i, first, f, n, head))
    blocks: list[list[tuple[int, np.ndarray]]] = [[] for _ in streams]
    for a in range(0, len(jobs), TOGETHER):
        part = jobs[a : a + TOGETHER]
        for (i, first, *_), row in zip(part, _decode_frames([p[2] for p in part], [p[3] for p in part], [p[4] for p in part]), strict=True):
            blocks[i].append((first, row))
    for own, (samples, md5) in zip(blocks, want, strict=True):
        own.sort(key=lambda b: b[0])
        pcm = b"".join(b.tobytes() for _, b in own)
        if len(pcm) != samples or hashlib.md5(pcm).digest() != md5:
            raise ValueError("the samples' number or MD5 is wrong")
    return blocks


# ---------------------------------------------------------------------------------------------
# Columns


def payload(text: str | None, unit: int = 64) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % unit if raw else unit)


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: the text's bytes, padded, as a FLAC stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                part = b.slice(a, ROWS)
                got = [payload(t.as_py()) for t in part.column(1)]
                media = encode_batch([p for _, p in got])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """A row for each block of each stream: doc_id, sample_offset, n_samples, pcm (signed 8-bit), all checksums verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "sample_offset", "n_samples", "pcm"]
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                part = b.slice(a, ROWS)
                rows = [(d, first, len(x), x.tobytes()) for d, blocks in zip(part.column(0).to_pylist(), decode_batch(part.column(1).to_pylist()), strict=True) for first, x in blocks]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names)

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, sample_offset long, n_samples int, pcm binary")


def media_digests(media: DataFrame) -> DataFrame:
    """For each stored stream: what was read back, its digests, and a feature string.

    feature: blocks, mean absolute sample, sign changes and the largest step between samples that follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for b in batches:
            for a in range(0, b.num_rows, ROWS):
                part = b.slice(a, ROWS)
                streams = part.column(2).to_pylist()
                rows = []
                for d, n, data, blocks in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), streams, decode_batch(streams), strict=True):
                    x = np.concatenate([v for _, v in blocks])
                    raw = (x.view(np.uint8) ^ np.uint8(128)).tobytes()
                    wide = x.astype(np.int16)
                    step = int(np.abs(np.diff(wide)).max()) if len(x) > 1 else 0
                    feature = f"blocks={len(blocks)};mean_abs={np.abs(wide).mean():.6f};sign_changes={int(((wide[1:] < 0) != (wide[:-1] < 0)).sum())};max_step={step}"
                    rows.append((d, n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
