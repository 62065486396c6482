"""SentencePiece encoding that keeps offsets: ids, and the bytes of the original text that each piece stands for.

A text is normalised by the longest prefix that the model's compiled character map (a double-array trie) has a rule for; for every
byte of the result the place in the original is recorded.  The normalised text is cut where no piece of the vocabulary can reach
across, each cut part is merged by byte-pair ranks once and remembered (a batch's new parts all together, one merge of each at a time),
and every piece's end is projected back to the original through the recorded places.  Characters without a piece fall back to bytes: the last byte's piece spans the character.

Texts never leave the task that reads them; the remembered parts of a task are bounded (REMEMBERED).  Nothing is shuffled.

Cases: a null text is encoded as an empty one, which has no pieces; rows that repeat a doc_id are encoded each on their own; null
doc_ids stay; texts of any length are encoded whole; columns other than doc_id and text are not read.  Models that are no BPE,
lack byte fallback, or have pieces of other kinds than normal, control, unknown and byte are an error.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Parts that a task remembers, and the longest that it does, in characters.
REMEMBERED, LONGEST = 400_000, 32


class CharacterMap:
    """The rules of a compiled character map: a double array over UTF-8 bytes, and the replacements end to end."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units: list[int] = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.texts = compiled[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key that begins at a byte, and that key's length."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units) or units[node] & 0x800000FF != raw[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start = found[0]
        return self.texts[start : self.texts.index(b"\0", start)], found[1]


class Normaliser:
    """Text -> normalised text and, for each of its bytes and its end, the place in the original's bytes."""

    def __init__(self, compiled: bytes, dummy_prefix: bool, trim: bool, escape: bool):
        self.rules, self.dummy, self.trim = CharacterMap(compiled), dummy_prefix, trim
        self.space = (SPACE if escape else " ").encode()

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        if not raw:
            return b"", np.zeros(1, np.int32)
        return self._by_rules(raw) if self.rules.units or self.trim else self._plain(raw)

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Without rules every byte stands for itself and only spaces grow."""
        wide = len(self.space)
        widths = np.ones(len(raw), np.int32)
        widths[np.frombuffer(raw, np.uint8) == 32] = wide
        begin = self.space if self.dummy else b""
        source = np.concatenate([np.zeros(len(begin), np.int32), np.repeat(np.arange(len(raw), dtype=np.int32), widths), np.array([len(raw)], np.int32)])
        return begin + raw.replace(b" ", self.space), source

    def _prefix(self, raw: bytes, at: int) -> tuple[bytes, int]:
        got = self.rules.longest(raw, at)
        if got is None:
            lead = raw[at]
            n = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return raw[at : at + n], n
        return got

    def _by_rules(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        at, out, source = 0, bytearray(), []
        if self.trim:
            while at < len(raw):
                text, n = self._prefix(raw, at)
                if text != b" ":
                    break
                at += n
            if at == len(raw):
                return b"", np.zeros(1, np.int32)

        def add(text: bytes) -> None:
            out.extend(text)
            source.extend([at] * len(text))

        if self.dummy:
            add(self.space)
        after_space = self.trim
        while at < len(raw):
            text, n = self._prefix(raw, at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                add(text.replace(b" ", self.space))
                after_space = text.endswith(b" ")
            if not self.trim:
                after_space = False
            at += n
        if self.trim:
            while out.endswith(self.space):
                at = source[len(out) - len(self.space)]
                del out[len(out) - len(self.space) :], source[len(out) :]
        return bytes(out), np.array([*source, at], np.int32)


class Encoder:
    """The encoder of one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto, TrainerSpec

        with open(path, "rb") as f:
            model = ModelProto()
            model.ParseFromString(f.read())
        spec, kind = model.normalizer_spec, ModelProto.SentencePiece
        odd = {p.type for p in model.pieces} - {kind.NORMAL, kind.CONTROL, kind.UNKNOWN, kind.BYTE}
        if model.trainer_spec.model_type != TrainerSpec.BPE or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix or odd:
            raise ValueError("only BPE models with byte fallback, without pieces of the user's own")
        self.library = SentencePieceProcessor(model_file=path)
        self.normaliser = Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self._pairs(model)
        long = [p for p in self.ids if len(p) > 1]
        joined = sorted({c for p in long for c in p} - {SPACE})
        letters = "".join(map(re.escape, joined))
        if any(a != SPACE and b == SPACE for p in long for a, b in zip(p, p[1:], strict=False)):
            self.parts = re.compile(f"[{letters}{SPACE}]+|.", re.S)
        else:  # a part ends before a space
            self.parts = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|.", re.S)
        self.known: dict[str, bytes] = {}  # ids, as little-endian 32-bit numbers

    def _pairs(self, model) -> None:
        """Symbols (pieces and their characters) by number; of each pair of symbols that makes a piece its rank and the piece's number."""
        own = [p for p in model.pieces if p.piece in self.ids]
        symbols = list(dict.fromkeys([*self.ids, *(c for p in self.ids for c in p)]))
        self.number = {s: i for i, s in enumerate(symbols)}
        self.out = [self._as_ids(s) for s in symbols]
        places = {score: i for i, score in enumerate(sorted({p.score for p in own}, reverse=True))}  # equal scores rank alike
        self.none, self.size = len(places), len(symbols)
        self.rank: dict[int, int] = {}
        self.makes: dict[int, int] = {}
        for p in own:
            for k in range(1, len(p.piece)):
                left, right = self.number.get(p.piece[:k]), self.number.get(p.piece[k:])
                if left is not None and right is not None:
                    self.rank[left * self.size + right] = places[p.score]
                    self.makes[left * self.size + right] = self.number[p.piece]
        # The same as arrays.
        self.index = pd.Index(np.fromiter(self.rank, np.int64, len(self.rank)))
        self.place, self.made = np.fromiter(self.rank.values(), np.int64, len(self.rank)), np.fromiter(self.makes.values(), np.int64, len(self.rank))
        self.symbol = np.full(0x110000, -1, np.int32)
        for s, i in self.number.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        self.symbol_ids = np.array([self.ids.get(s, -1) for s in symbols], "<i4")
        self.width, self.lead = np.zeros(len(model.pieces), np.int32), np.zeros(len(model.pieces), np.int32)
        for s, i in self.ids.items():
            self.width[i] = len(s.encode())
        for b, i in self.bytes.items():
            self.lead[i] = 1 if b < 0x80 else 0 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4

    def _as_ids(self, symbol: str) -> bytes:
        """A piece's id, or those of a character's bytes."""
        ids = [self.ids[symbol]] if symbol in self.ids else [self.bytes[b] for b in symbol.encode()]
        return np.array(ids, "<i4").tobytes()

    def _learn(self, parts: list[str]) -> None:
        """Remember parts of 2 to LONGEST characters.  In each round the best-ranked pair of every part becomes one, the leftmost of equals."""
        sizes = list(map(len, parts))
        for low, high in ((2, 8), (9, 16), (17, LONGEST)):
            own = [p for p, n in zip(parts, sizes, strict=True) if low <= n <= high]
            if own:
                self._remember(own, *self._merged(self.symbol[np.frombuffer("".join(own).encode("utf-32-le"), "<u4")], np.array(list(map(len, own)))))

    def _merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words' characters, end to end, with their numbers -> the words' pieces likewise."""
        n, width = len(sizes), int(sizes.max())
        grid = np.full((n, width), -1, np.int64)
        grid[np.arange(width) < sizes[:, None]] = symbols
        ranks = self._ranks(grid[:, :-1], grid[:, 1:])
        columns = np.arange(width)
        live = np.flatnonzero(ranks.min(1) < self.none)
        while len(live):
            g, r, row = grid[live], ranks[live], np.arange(len(live))
            at = r.argmin(1)
            made = self.made[self.index.get_indexer(g[row, at] * self.size + g[row, at + 1])]
            moved = np.minimum(columns + (columns > at[:, None]), width - 1)
            g = np.take_along_axis(g, moved, 1)
            g[:, -1] = -1
            g[row, at] = made
            r = np.take_along_axis(r, moved[:, :-1] - (moved[:, :-1] == width - 1), 1)
            r[:, -1] = self.none
            before = np.maximum(at - 1, 0)
            r[row, before] = np.where(at > 0, self._ranks(g[row, before], made), r[row, before])
            r[row, np.minimum(at, width - 2)] = self._ranks(made, g[row, np.minimum(at + 1, width - 1)])
            grid[live], ranks[live] = g, r
            live = live[r.min(1) < self.none]
        return grid[grid >= 0], (grid >= 0).sum(1)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.index.get_indexer(np.where((left >= 0) & (right >= 0), left * self.size + right, -1).ravel())
        return np.where(found >= 0, self.place[found], self.none).reshape(left.shape)

    def _remember(self, parts: list[str], symbols: np.ndarray, sizes: np.ndarray) -> None:
        ids = self.symbol_ids[symbols]
        plain, raw, at = (np.add.reduceat(ids < 0, np.cumsum(sizes) - sizes) == 0).tolist(), ids.tobytes(), 0
        for part, n, whole in zip(parts, sizes.tolist(), plain, strict=True):
            # A character may have no piece of its own.
            self.known[part] = raw[4 * at : 4 * (at + n)] if whole else self._joined(symbols[at : at + n].tolist())
            at += n

    def _joined(self, symbols: list[int]) -> bytes:
        return b"".join([self.out[x] for x in symbols])

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same by a queue of pairs, for parts of many characters."""
        live: list[int | None] = list(symbols)
        before, after = list(range(-1, len(live) - 1)), [*range(1, len(live)), -1]
        queue: list[tuple[int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                pair = live[left] * self.size + live[right]
                if pair in self.rank:
                    heapq.heappush(queue, (self.rank[pair], left, right, pair))

        for i in range(1, len(live)):
            offer(i - 1, i)
        while queue:
            _, left, right, pair = heapq.heappop(queue)
            if live[left] is None or live[right] is None or after[left] != right or live[left] * self.size + live[right] != pair:
                continue
            live[left], live[right] = self.makes[pair], None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [x for x in live if x is not None]

    def encode_all(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text the ids, and the first byte and the end of each piece in its UTF-8 bytes."""
        normal = [self.normaliser((t or "").encode("utf-8")) for t in texts]
        parts = [self.parts.findall(n.decode("utf-8")) for n, _ in normal]
        every = set().union(*parts)
        if len(self.known) + len(every) > REMEMBERED:
            self.known.clear()
        new = every - self.known.keys()
        self._learn([p for p in new if 1 < len(p) <= LONGEST])
        for p in new - self.known.keys():
            self.known[p] = self._as_ids(p) if len(p) == 1 else self._joined(self._merged_long([self.number[c] for c in p]))
        out = []
        for own, (_, source) in zip(parts, normal, strict=True):
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, own)), "<i4")
            ends = np.cumsum(self._widths(ids), dtype=np.int64)
            out.append((ids, source[np.concatenate([[0], ends[:-1]]) if len(ends) else ends], source[ends]))
        for p in new:
            if len(p) > LONGEST:
                del self.known[p]
        return out

    def _widths(self, ids: np.ndarray) -> np.ndarray:
        """How many normalised bytes each piece stands for: of a character in bytes, the last byte's piece for all."""
        widths, lead = self.width[ids], self.lead[ids]
        at = np.flatnonzero(lead)
        widths[at + lead[at] - 1] = lead[at]
        return widths

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def encoded(docs: DataFrame, model: str, rows: int = 500) -> DataFrame:
    """doc_id, ids, begins, ends (of each piece, in the text's bytes) and decoded (what the ids give back) for every row.

    model: the path of a model file that every executor has.
    """
    kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]

    def lists(parts: list[np.ndarray]) -> pa.ListArray:
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]), pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for whole in batches:
            for a in range(0, whole.num_rows, rows):
                b = whole.slice(a, rows)
                got = encoder.encode_all(b.column(1).to_pylist())
                texts = [encoder.decode(ids.tolist()) for ids, _, _ in got]
                yield pa.RecordBatch.from_arrays([b.column(0), *[lists([g[k] for g in got]) for k in range(3)], pa.array(texts, kinds[3])], ["doc_id", "ids", "begins", "ends", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string")


def digest(pieces: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, span_bytes (of the text, that its pieces span)."""
    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)) - F.get("begins", F.lit(0)), F.lit(0)).cast("long").alias("span_bytes"),
    )
