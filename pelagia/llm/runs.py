"""Periodic runs: stretches of words that repeat with a period, each in full and once.

A text's words are numbered.  Suffix grouping from the largest group down, the first phase of Baier's suffix sorter, leaves every
position with its longest Lyndon word; done for both orders of the words it gives the Lyndon roots that every run has at least one of.
Each root is extended both ways by the longest common extension of its two ends (hashed prefixes, all roots at once), and every run
that comes out is checked word by word.

Before that a text is narrowed to the stretches that can hold runs: a run of `least` words or more, of two periods at least, consists of
words in groups of (least + 1) / 2 that occur twice in it, one at most half of it after the other.  Stretches are cut until all their
groups do; prose keeps next to nothing, and no run is lost.

Texts never leave the task that reads them and nothing is shuffled.

Cases: a null or empty text has no words and no runs; rows that repeat a doc_id are searched each on their own; null doc_ids stay; texts
of any length are searched whole; a run of one word over and over has period 1; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import rolling

LEAST = 12
#: Moduli of the prefix hashes, primes under 2^31, and their bases.
MODULI, BASES = (2147483647, 2147483629), (1_000_003, 911_382_323)
_POWERS: list[np.ndarray] = [np.ones(1, np.int64), np.ones(1, np.int64)]


def lyndon_lengths(ranks: list[int], kinds: int) -> list[int]:
    """The length of the longest Lyndon word that begins at each position; ranks are 0 to kinds - 1, the text's end is smaller.

    Groups of positions are taken from the largest down.  Where a member's nearest position of a lower group, to the left, is p, the
    member's Lyndon word joins p's; positions of one group that gain equally many form a new group right above it.
    """
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    n = len(ranks)
    group, length, jump = list(ranks), [1] * n, [-2] * (n + 1)  # jump: to the nearest lower position, once that is settled
    below, above = list(range(-1, kinds - 1)), [*range(1, kinds), -1]
    g = kinds - 1
    while g >= 0:
        gained: dict[int, int] = {}
        size = 0
        for i in members[g]:
            if group[i] == g:
                p = i - 1
                while jump[p] != -2:
                    p = jump[p]
                jump[i] = p
                gained[p] = gained.get(p, 0) + 1
                size = length[i]
        members[g] = []
        gained.pop(-1, None)
        if gained:
            moved: dict[tuple[int, int], list[int]] = {}
            for p, times in gained.items():
                length[p] += times * size
                key = group[p], times
                if key in moved:
                    moved[key].append(p)
                else:
                    moved[key] = [p]
            last_old = last = -1
            for key in sorted(moved) if len(moved) > 1 else moved:
                if key[0] != last_old:
                    last_old = last = key[0]
                new = len(members)
                members.append(moved[key])
                for p in moved[key]:
                    group[p] = new
                up = above[last]
                below.append(last)
                above.append(up)
                above[last] = new
                if up >= 0:
                    below[up] = new
                last = new
        g = below[g]
    return length


class Extensions:
    """Longest common extensions of many pairs of places at once, by hashed prefixes."""

    def __init__(self, w: np.ndarray):
        self.n, self.prefixes = len(w), []
        for k, (m, base) in enumerate(zip(MODULI, BASES, strict=True)):
            while len(_POWERS[k]) <= self.n:  # twice as many at a time
                have = _POWERS[k]
                _POWERS[k] = np.concatenate([have, have * (int(have[-1]) * base % m) % m])
            terms = (w + 1) % m * _POWERS[k][: self.n] % m
            self.prefixes.append(np.concatenate([[0], np.cumsum(terms)]) % m)

    def _equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Whether `size` words from i and from j > i are the same."""
        same = np.ones(len(i), bool)
        for m, p, h in zip(MODULI, _POWERS, self.prefixes, strict=True):
            same &= (h[i + size] - h[i]) % m * p[j - i] % m == (h[j + size] - h[j]) % m
        return same

    def _longest(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        out, live = np.zeros(len(i), np.int64), np.arange(len(i))
        step = 1
        while len(live):  # doubling, then halving
            sure = live[out[live] + step <= most[live]]
            shift = out[sure] + step if back else -out[sure]
            sure = sure[self._equal(i[sure] - shift, j[sure] - shift, step)]
            out[sure] += step
            live, step = sure, step * 2
        while step > 1:
            step //= 2
            at = np.flatnonzero(out + step <= most)
            shift = out[at] + step if back else -out[at]
            at = at[self._equal(i[at] - shift, j[at] - shift, step)]
            out[at] += step
        return out

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._longest(i, j, self.n - j, False)

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the words before i and before j."""
        return self._longest(i, j, i, True)


def _all_runs(w: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """start, length and period of the runs of at least `least` words, by Lyndon roots of both orders."""
    names, w = np.unique(w, return_inverse=True)
    kinds = len(names)
    ranks = w.tolist()
    found = [lyndon_lengths(ranks, kinds), lyndon_lengths([kinds - 1 - r for r in ranks], kinds)]
    at = np.tile(np.arange(len(w)), 2)
    period = np.concatenate([np.array(f, np.int64) for f in found])
    to = at + period
    in_reach = to < len(w)
    follows = np.zeros(len(at), bool)
    follows[in_reach] = w[at[in_reach]] == w[to[in_reach]]
    precedes = (at > 0) & (w[np.maximum(at - 1, 0)] == w[to - 1])
    some = np.flatnonzero(follows | precedes)
    at, to, period = at[some], to[some], period[some]
    reach = Extensions(w.astype(np.int64))

    def distinct(right: np.ndarray, left: np.ndarray) -> list[tuple[int, int, int]]:
        long = period + right + left >= np.maximum(2 * period, least)
        return [tuple(r) for r in np.unique(np.stack([at - left, period + right + left, period])[:, long], axis=1).T.tolist()]

    runs = distinct(reach.right(at, to), reach.left(at, to))
    if all((w[s : s + size - p] == w[s + p : s + size]).all() for s, size, p in runs):
        return runs
    return distinct(*_scanned(w, at, to))  # two stretches of words had the same hashes


def _scanned(w: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The extensions of each pair, word by word."""
    right, left = [], []
    for i, j in zip(at.tolist(), to.tolist(), strict=True):
        differ = np.flatnonzero(w[i : len(w) - j + i] != w[j:])
        right.append(int(differ[0]) if len(differ) else len(w) - j)
        differ = np.flatnonzero(w[:i][::-1] != w[j - i : j][::-1])
        left.append(int(differ[0]) if len(differ) else i)
    return np.array(right, np.int64), np.array(left, np.int64)


def stretches(w: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Disjoint ranges of words, in order, outside of which no run lies; every run lies whole in one."""
    k = (least + 1) // 2
    grams = rolling(w.astype(np.uint64) + np.uint64(1), k)
    if not len(grams):
        return []
    order = np.argsort(grams, kind="stable")
    again = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= again
    twice[:-1] |= again
    order = order[twice]  # by gram, then place
    while len(order):
        cover = np.zeros(len(w) + 1, np.int64)
        np.add.at(cover, order, 1)
        np.add.at(cover, order + k, -1)
        inside = np.cumsum(cover) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside[:-1], [False]])))
        begins, ends = edges[::2], edges[1::2]
        stretch = np.searchsorted(begins, order, "right") - 1
        gap = order[1:] - order[:-1]
        near = (grams[order[1:]] == grams[order[:-1]]) & (stretch[1:] == stretch[:-1]) & (2 * gap <= (ends - begins)[stretch[1:]])
        keep = np.zeros(len(order), bool)
        keep[1:] |= near
        keep[:-1] |= near
        keep &= (ends - begins)[stretch] >= least
        if keep.all():
            return list(zip(begins.tolist(), ends.tolist(), strict=True))
        order = order[keep]
    return []


def runs_of(w: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """start, length and period of every run of at least `least` words and two periods, by start and period.  w: numbered words."""
    out = [(a + s, size, p) for a, b in stretches(w, least) for s, size, p in _all_runs(w[a:b], least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Words by the order in which they first occur."""
    ids: dict[bytes, int] = defaultdict(count().__next__)
    return np.array(list(map(ids.__getitem__, words)), np.int64)


def word_runs(docs: DataFrame, least: int = LEAST, order: Callable[[int | None, int], np.ndarray | None] | None = None, rows: int = 500) -> DataFrame:
    """doc_id, runs (start, length, period; by start and period) and collapsed: the words, less what follows a run's first period.

    order (doc_id, number of words) -> which word stands at each place, where a text is to be rearranged before.
    """
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, rows):
                b = whole.slice(a, rows)
                found, kept = [], []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    words = (text.as_py() or "").encode("utf-8").split()
                    w = numbered(words)
                    moved = order(doc_id, len(words)) if order else None
                    if moved is not None:
                        words, w = [words[i] for i in moved.tolist()], w[moved]
                    own = runs_of(w, least)
                    if own:
                        cover = np.zeros(len(words) + 1, np.int64)
                        for s, size, p in own:
                            cover[s + p] += 1
                            cover[s + size] -= 1
                        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                    found.append([{"start": s, "length": size, "period": p} for s, size, p in own])
                    kept.append(b" ".join(words).decode("utf-8"))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind), pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of every tenth document, by its id's checksum, the words from some place on repeat with some period."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) with its exponent, digests of all runs and of what is kept."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.shorter")
    return out.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), length.alias("length"), period.alias("period"), F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
