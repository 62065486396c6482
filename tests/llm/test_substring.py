"""Repeated rows of a few doc_ids cost no more than one row each."""

import numpy as np
import xxhash

from pelagia.llm import substring
from pelagia.llm.common import free_names, set_aside


def text(seed, n):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, 4000, n))


def test_a_thousand_copies_of_two_ids(spark):
    p, q = text(1, 400), text(2, 300)
    kinds = {1: p, 2: f"{q} {p}", 3: text(3, 200)}
    rows = [(d, kinds[d]) for d in (1, 2) for _ in range(1000)] + [(3, kinds[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: substring.F.lit(1) for c in ("tag", "zipped", "seeds", "begin", "r")})
    got = substring.digest(substring.remove_repeats(docs)).collect()
    want = substring.brute_force(list(kinds.items()))
    assert len(got) == 2001
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got} == {(d, *v) for d, v in want.items()}


def test_two_texts_of_one_id_are_judged_apart(spark):
    p, q = text(4, 120), text(5, 120)
    rows = [(1, p), (2, p), (2, q), (2, p), (3, q)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 120, 0), (2, 120, 0), (2, 120, 120), (2, 120, 120), (3, 120, 120)]


def test_texts_whose_short_hashes_agree(spark):
    """Two texts of one doc_id, one a copy and one new, whose hashes share their low 20 bits."""
    low, passage = lambda t: xxhash.xxh3_64_intdigest(t.encode()) & 0xFFFFF, text(6, 60)
    copies, draw = {low(f"{passage} {i}"): f"{passage} {i}" for i in range(3000)}, 0
    while low(new := f"{text(7, 80)} {draw}") not in copies:
        draw += 1
    rows = [(1, passage), (5, copies[low(new)]), (5, new)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 60, 0), (5, 61, 60), (5, 81, 0)]


def test_names_are_set_aside(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Size int, size_ int, other int")
    assert free_names(df, "size", "x", "x") == ["size__", "x", "x_"]
    out, back = set_aside(df, ["SIZE"], ["other"])
    assert [back.get(c, c) for c in out.columns] == ["Size", "size_"] and "size" not in [c.lower() for c in out.columns]
