"""Alignment against the usual table, and the search by rare words against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from pelagia.llm import near_dups
from pelagia.llm.common import Scratch


def plain(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out) + 1), rng.random()
        if kind < 0.4 and at < len(out):
            out[at] = rng.randrange(10**6)
        elif kind < 0.7 or at == len(out):
            out.insert(at, rng.randrange(10**6))
        else:
            del out[at]
    return out


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 60))]
        b = edited(rng, a, rng.randrange(0, 14)) if rng.random() < 0.7 else [rng.randrange(6) for _ in range(rng.randrange(0, 60))]
        m = plain(a, b)
        assert near_dups.common_subsequence(a, b, 99) == near_dups.common_subsequence(a, b, 99, 5) == m
        s = m / (len(a) + len(b) - m)
        assert near_dups.aligned_similarity(np.array(a, np.uint32), np.array(b, np.uint32)) == (s if s >= 0.8 - 1e-12 else 0.0)


def test_rare_words_meet_every_pair_that_aligns(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(40):
        base = [rng.randrange(60) if rng.random() < 0.6 else rng.randrange(10**6) for _ in range(rng.randrange(1, 80))]
        texts += [edited(rng, base, rng.randrange(0, 1 + len(base) // 5)) or [1] for _ in range(4)]
    split = [[f"{w}" for w in t] for t in texts]
    rows = [(k, i, i // 6 * 6 if i % 3 else i) for k in (1, 2) for i in range(len(texts))]
    words = spark.createDataFrame([(i, bytearray(np.array(t, np.uint32).tobytes())) for i, t in enumerate(texts)], "node long, words binary")
    open_ = spark.createDataFrame(rows, "key long, node long, label long")
    label = {i: k for _, i, k in rows}

    def classes(pairs):
        root = {k: k for k in label.values()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            x, y = find(label[a]), find(label[b])
            root[max(x, y)] = min(x, y)
        return {k: find(k) for k in root}

    want = [(i, j) for j in range(len(texts)) for i in range(j) if min(len(split[i]), len(split[j])) >= 0.8 * max(len(split[i]), len(split[j])) and (m := plain(texts[i], texts[j])) / (len(texts[i]) + len(texts[j]) - m) >= 0.8 - 1e-12]
    assert len({(i, j) for i, j in want if label[i] != label[j]}) > 40
    for unit_rows in (9, 1000):
        got = near_dups.across(open_, words, 0.8, unit_rows).collect()
        assert all(label[r.a] != label[r.b] for r in got) and classes(got) == classes(want)
        held = near_dups.units(open_, unit_rows).groupBy("key", "kind", "low", "high").count().agg(F.max("count")).first()[0]
        assert held <= 3 * 2 * unit_rows


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    scratch = Scratch(spark)
    got = {r.node: r.label for r in near_dups.components(links, scratch).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90}
    scratch.close()


def test_near_copies_are_found(spark):
    """Copies with one word in twenty changed: recall of at least 0.95, and no class of unrelated texts."""
    rng = random.Random(3)
    rows, family = [], {}
    for d in range(0, 400, 2):
        base = [rng.randrange(5000) for _ in range(rng.randrange(40, 300))]
        rows += [(d, " ".join(f"w{x}" for x in base)), (d + 1, " ".join(f"w{x}" for x in edited(rng, base, len(base) // 20)))]
        family[d] = family[d + 1] = d
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("node", "label", "words", "token", "a", "b")})
    got = {r.doc_id: r.class_id for r in near_dups.digest_rows(docs).collect()}
    assert all(family[c] == family[d] for d, c in got.items())
    assert np.mean([got[d + 1] == d for d in range(0, 400, 2)]) >= 0.95
