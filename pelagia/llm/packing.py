"""Sum-of-squares online packing of token ids into windows of a fixed length.

N(h) counts the windows filled to level h.  A piece of length a goes where the sum of N(h)^2 over the partly filled levels ends
smallest: raising a window from h to h + a changes it by 2 * (N(h + a) - N(h)) + 2, opening one by 2 * N(a) + 1; a full window
counts nothing.  The counts are one array over the levels, so a choice is a single vector operation.

Each task packs the rows it reads as they come: no shuffle, and no more than the open windows in memory.  A document of a
window's length or more fills whole windows first; only its rest is placed.  When a task's rows end, the pieces of its open
windows are laid end to end and cut into full windows; what is left over is cut at powers of two, which need no padding.  So a task
leaves no padding at all, at the price of a few short sequences.

Sequence numbers are the task's number times 2^40 plus a running count; a task that is run again gives the same ones.

Cases: a null or empty text is the end id alone; repeated rows are packed each on their own; no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
WINDOW, END_ID = 2048, 1
#: A text that holds this may hold a special token, which crosses the rules of chunks: it takes the tokenizer's own path.
_SPECIAL = "<|"
#: The tokenizer's own pre-tokenisation of a chunk without blanks; a fixed pattern.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level models write for each byte: itself where it prints, else the next one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Ids:
    """Lists of token ids one after another, in arrays that grow."""

    def __init__(self, width: type) -> None:
        self.size = self.used = 0
        self.begin, self.count, self.flat = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(4096, width)

    @staticmethod
    def _room(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x)), x.dtype)])

    def extend(self, ids: np.ndarray, counts: np.ndarray) -> None:
        n, used = self.size + len(counts), self.used + len(ids)
        self.begin, self.count, self.flat = self._room(self.begin, n), self._room(self.count, n), self._room(self.flat, used)
        self.flat[self.used : used] = ids
        self.count[self.size : n] = counts
        self.begin[self.size : n] = self.used + np.cumsum(counts) - counts
        self.size, self.used = n, used

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these lists, and where each of them ends."""
        count = self.count[numbers].astype(np.int64)
        stop = np.concatenate([[0], np.cumsum(count)])
        return self.flat[np.repeat(self.begin[numbers] - stop[:-1], count) + np.arange(stop[-1])], stop


class CachedTokenizer:
    """Ids of texts by a tokenizer whose pieces never cross white space: each distinct chunk between ASCII blanks is encoded once.

    The chunks of a whole batch are split and told apart in Arrow; only the distinct ones meet the cache.  A new chunk of printable
    characters below U+0180 is lower-cased and cut into pieces here, and the model encodes each distinct piece once; other chunks,
    where normalisation does more, take the tokenizer's own path.  The caches hold about max_chunks entries and start anew beyond that.
    """

    def __init__(self, path: str, max_chunks: int):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.width = np.uint16 if self.full.get_vocab_size() <= 1 << 16 else np.uint32
        self.model = self.full.model
        self.max_chunks = max_chunks
        self.letters = _byte_letters()
        self._reset()

    def _reset(self) -> None:
        self.chunks: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.of_chunk, self.of_piece = _Ids(self.width), _Ids(self.width)

    def _learn(self, chunks: list[str]) -> None:
        known, parts, many = self.pieces, [], []
        new: list[int] = []  # ids of the pieces that are new
        sizes: list[int] = []
        for c in chunks:
            if not c.isprintable() or not c.isascii() and (max(c) > "\u017f" or "\u0130" in c):
                pieces, whole = (c,), True
            else:
                low, whole = c.lower(), False
                pieces = (low,) if low.isalpha() else (low[:-1], low[-1]) if low[-1:] in (".", ",") and low[:-1].isalpha() else _PIECES.findall(low)
            many.append(len(pieces))
            for x in pieces:
                n = known.get(x)
                if n is None:
                    n = known[x] = len(known)
                    if whole:
                        ids = self.full.encode(x, add_special_tokens=False).ids
                    else:
                        ids = [t.id for t in self.model.tokenize(x if x.isascii() else x.encode().decode("latin-1").translate(self.letters))]
                    new += ids
                    sizes.append(len(ids))
                parts.append(n)
        self.of_piece.extend(np.array(new, self.width), np.array(sizes, np.int32))
        ids, stop = self.of_piece.of(np.array(parts, np.int64))
        self.chunks.update(zip(chunks, range(len(self.chunks), len(self.chunks) + len(chunks)), strict=True))
        self.of_chunk.extend(ids, np.diff(stop[np.concatenate([[0], np.cumsum(many)])]))

    def encode(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """For each text its ids and the end id; null is an empty text."""
        if len(self.chunks) + len(self.pieces) > self.max_chunks:
            self._reset()
        texts = pc.fill_null(texts, "")
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        get = self.chunks.get
        if new := [c for c in distinct if get(c) is None]:
            self._learn(new)
        number = np.fromiter(map(get, distinct), np.int64, len(distinct))
        ends = lists.offsets.to_numpy().astype(np.int64)
        tokens, stop = self.of_chunk.of(number[coded.indices.to_numpy(zero_copy_only=False)])
        last = stop[ends[1:] - ends[0]]
        ids = np.insert(tokens.astype("<u4"), last, end_id)
        out = np.split(ids, (last + np.arange(1, len(last) + 1))[:-1]) if len(last) else []
        for i in np.flatnonzero(pc.match_substring(texts, _SPECIAL).to_numpy(zero_copy_only=False)):
            out[i] = np.array([*self.full.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, end_id], "<u4")
        return out


MAX_CHUNKS, BATCH = 1_000_000, 8 << 20
_TOKENIZERS: dict[tuple[str, int], CachedTokenizer] = {}


def tokenizer(path: str, max_chunks: int = MAX_CHUNKS) -> CachedTokenizer:
    """One for each Python worker, kept from task to task."""
    if (path, max_chunks) not in _TOKENIZERS:
        _TOKENIZERS[path, max_chunks] = CachedTokenizer(path, max_chunks)
    return _TOKENIZERS[path, max_chunks]


class SumOfSquares:
    """The level array and the open windows of one packer."""

    EMPTY = -(1 << 40)

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)  # N(h); entries 0 and window stay 0
        self.filled = np.full(window + 1, self.EMPTY, np.int64)  # N(h), or EMPTY where there is none to fill further
        self.open: list[list[list]] = [[] for _ in range(window + 1)]  # by level: windows, each a list of pieces
        self.done: list[list] = []

    def place(self, piece: tuple, length: int) -> None:
        w = self.window
        if length == w:
            self.done.append([piece])
            return
        # Twice N(h + a) - N(h), plus 2, for h = 1 .. w - a - 1; filling up to the brim only takes a window away.
        h, least = 0, 2 * int(self.levels[length]) + 1
        if w - length > 1:
            gain = self.levels[length + 1 : w] - self.filled[1 : w - length]
            at = int(gain.argmin())
            if 2 * int(gain[at]) + 2 < least:
                h, least = at + 1, 2 * int(gain[at]) + 2
        if self.levels[w - length] and 1 - 2 * int(self.levels[w - length]) < least:
            h = w - length
        held = self._taken(h) if h else []
        held.append(piece)
        if h + length == w:
            self.done.append(held)
        else:
            at = h + length
            self.levels[at] += 1
            self.filled[at] = self.levels[at]
            self.open[at].append(held)

    def _taken(self, h: int) -> list:
        self.levels[h] -= 1
        self.filled[h] = self.levels[h] or self.EMPTY
        return self.open[h].pop()

    def full(self) -> list[list]:
        out, self.done = self.done, []
        return out

    def close(self) -> list[tuple]:
        """The pieces of all open windows, in a fixed order."""
        return [p for windows in self.open for held in windows for p in held]


def _cut(pieces: list[tuple], window: int) -> Iterator[list[tuple]]:
    """Full windows out of the pieces laid end to end; the rest at powers of two."""
    left = sum(len(p[2]) for p in pieces)
    size = lambda: window if left >= window else 1 << (left.bit_length() - 1)
    room, held = size() if left else 0, []
    for doc, start, ids, total in pieces:
        at = 0
        while at < len(ids):
            n = min(room, len(ids) - at)
            held.append((doc, start + at, ids[at : at + n], total))
            at, room, left = at + n, room - n, left - n
            if not room:
                yield held
                held, room = [], size() if left else 0


def _together(batches: Iterator[pa.RecordBatch], size: int = BATCH) -> Iterator[tuple[list, pa.Array]]:
    """doc_ids and texts, small batches put together and large ones cut to about `size` bytes of text."""
    held, many = [], 0

    def gathered() -> tuple[list, pa.Array]:
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return t.column(0).to_pylist(), t.column(1).combine_chunks() if t.num_rows else pa.array([], pa.string())

    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size - many, side="right")))
            held.append(b.slice(at, stop - at))
            many += int(ends[stop - 1]) - before
            at = stop
            if many >= size or at < b.num_rows:
                yield gathered()
                many = 0
    if held:
        yield gathered()


def _packer(path: str, window: int, end_id: int, max_chunks: int, batch_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, max_chunks)
        state, number = SumOfSquares(window), TaskContext.get().partitionId() << 40
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
        rows: list[tuple] = []

        def emit(windows) -> None:
            nonlocal number
            for pieces in windows:
                offset = 0
                for doc, start, ids, total in pieces:
                    rows.append((doc, start, len(ids), zlib.crc32(ids), total, number, offset))
                    offset += len(ids)
                number += 1

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
            rows.clear()
            return out

        for docs, texts in _together(batches, batch_bytes):
            for doc, ids in zip(docs, tok.encode(texts, end_id), strict=True):
                total = len(ids)
                whole = total // window * window
                if whole:
                    emit([(doc, at, ids[at : at + window], total)] for at in range(0, whole, window))
                if whole < total:
                    # An open window keeps a copy, not the batch that its piece lies in.
                    state.place((doc, whole, ids[whole:].copy(), total), total - whole)
                    if state.done:
                        emit(state.full())
                if len(rows) > 5000:
                    yield batch()
        emit(_cut(state.close(), window))
        if rows:
            yield batch()

    return pack


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, max_chunks: int = MAX_CHUNKS, batch_bytes: int = BATCH) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    tokenizer_path: a `tokenizers` JSON file that every executor has at that path, of a tokenizer whose pieces end at white space.
    max_chunks and batch_bytes (of text encoded at once) bound what a worker holds; smaller ones take longer and give the same ids.
    """
    return docs.select("doc_id", "text").mapInArrow(_packer(tokenizer_path, window, end_id, max_chunks, batch_bytes), SCHEMA)
