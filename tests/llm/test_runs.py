"""Runs against every period tried at every place, Lyndon lengths against their definition."""

import hashlib
import zlib

import numpy as np
import pytest

from pelagia.llm import runs
from tests.llm.test_llm import docs_of, words


def plain_runs(w, least=12):
    """Every period tried: stretches that no neighbour extends, of two periods and `least` words; of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        start = None
        for i in range(len(w) - q + 1):
            if i < len(w) - q and w[i] == w[i + q]:
                start = i if start is None else start
            elif start is not None:
                size = i - start + q
                if size >= max(least, 2 * q):
                    out.setdefault((start, size), q)
                start = None
    return sorted(((s, size, q) for (s, size), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_lyndon(w):
    """The longest prefix of each suffix that is smaller than all its proper suffixes."""
    out = []
    for i in range(len(w)):
        j = next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w))
        out.append(j - i)
    return out


def texts(rng):
    yield from ([], [0], [0] * 40, [0, 1] * 30, list(range(50)), [0] * 11, [0] * 12)
    for _ in range(150):
        kinds = int(rng.integers(1, 5))
        yield rng.integers(0, kinds, int(rng.integers(1, 120))).tolist()
    for _ in range(60):  # periods inside periods
        w = rng.integers(0, 3, int(rng.integers(1, 5))).tolist()
        for _ in range(int(rng.integers(1, 5))):
            w = w * int(rng.integers(1, 4)) + rng.integers(0, 3, int(rng.integers(0, 4))).tolist()
        yield w[:400]
    a, b = [0], [0, 1]
    for _ in range(10):
        a, b = b, b + a
    yield b


def test_lyndon_lengths_of_both_orders():
    for w in texts(np.random.default_rng(1)):
        kinds = max(w, default=-1) + 1
        assert runs.lyndon_lengths(w, kinds) == plain_lyndon(w)
        turned = [kinds - 1 - c for c in w]
        assert runs.lyndon_lengths(turned, kinds) == plain_lyndon(turned)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_are_all_runs(least):
    seen = 0
    for w in texts(np.random.default_rng(2)):
        want = plain_runs(w, least)
        assert runs.runs_of(np.array(w, np.int64), least) == want, w
        seen += len(want)
    assert seen > 100


def test_stretches_of_prose_are_few():
    rng = np.random.default_rng(3)
    w = rng.integers(0, 3000, 20_000)
    assert runs.stretches(w, 12) == []
    w[5000:5100] = w[400:500]  # a passage again, far away
    assert runs.stretches(w, 12) == []
    w[7000:7030] = np.tile(w[7000:7010], 3)
    assert runs.runs_of(w) == [(7000, 30, 10)]


def test_extensions_are_longest():
    rng = np.random.default_rng(4)
    w = np.concatenate([np.tile(rng.integers(0, 2, 7), 9), rng.integers(0, 2, 60)])
    x = runs.Extensions(w)
    i, j = np.array([(a, b) for a in range(0, 100, 3) for b in range(a + 1, len(w), 5)]).T
    agree = lambda a, b: next((k for k, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
    assert x.right(i, j).tolist() == [agree(w[a:], w[b:]) for a, b in zip(i, j, strict=True)]
    assert x.left(i, j).tolist() == [agree(w[:a][::-1], w[:b][::-1]) for a, b in zip(i, j, strict=True)]
    right, left = runs._scanned(w, i, j)
    assert right.tolist() == x.right(i, j).tolist() and left.tolist() == x.left(i, j).tolist()


def test_equal_hashes_are_noticed(monkeypatch):
    rng = np.random.default_rng(8)
    w = np.tile(rng.integers(0, 3, 20), 4)
    w[45] = 9
    monkeypatch.setattr(runs.Extensions, "right", lambda self, i, j: self.n - j)
    assert runs.runs_of(w) == plain_runs(w.tolist())


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(((-size, s, q) for s, size, q in found), default=None)
    four = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *four, sha("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_the_query_equals_every_period_tried(spark):
    rng = np.random.default_rng(5)
    rows = [(i, words(rng, int(rng.integers(0, 300)))) for i in range(500)]
    rows += [(600 + i, words(rng, int(rng.integers(12, 200)), 3)) for i in range(40)]
    rows += [(700, None), (701, ""), (702, " \t\n"), (703, "same " * 500), (704, "\xa0a b " * 20), (703, "same " * 500), (None, "x y " * 12), (705, "é\x0b" * 13)]
    docs = docs_of(spark, rows).withColumnRenamed("lang", "runs").withColumnRenamed("source", "collapsed")
    got = runs.digest(runs.word_runs(docs, order=runs.planted)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r["n_runs"] > 0 for r in got) > 40
    assert runs.word_runs(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    rng = np.random.default_rng(6)
    w = [f"w{i}" for i in rng.integers(0, 50_000, 300_000)]
    w[1000:201_000] = (w[1000:4000] * 67)[:200_000]
    (row,) = runs.word_runs(docs_of(spark, [(1, " ".join(w))])).collect()
    assert [tuple(r) for r in row["runs"]] == [(1000, 200_000, 3000)]
    assert len(row["collapsed"].split()) == 300_000 - 197_000
