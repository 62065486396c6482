"""The flow by parts, the search for the last document level by level, and columns whose names clash."""

import numpy as np
from pyspark.sql import functions as F

from pelagia.llm import line_dedup, mixing

SCHEMA = "doc_id long, text string, source string"


def rows_of(n):
    rng = np.random.default_rng(3)
    return [(d, " ".join("w" for _ in range(int(rng.integers(0, 30)))), rng.choice(["a", "b", "c"], p=[0.8, 0.1, 0.1]).item()) for d in range(n)]


def test_parts_give_the_same_flow():
    capacity, quota = {0: 10, 1: 7, 2: 5, 3: 9}, {0: 12, 1: 9, 2: 18, 3: 1}
    links = [(0, 0), (1, 0), (1, 1), (2, 1), (3, 2), (3, 3)]
    whole = mixing.min_cost_flow(capacity, quota, links)
    assert mixing.routed(capacity, quota, links) == {p: sum(x for (q, _), x in whole.items() if q == p) for p in capacity}
    assert mixing.routed({0: 3}, {}, []) == {0: 0}


def test_deeper_levels_take_the_same_documents(spark):
    docs = spark.createDataFrame(rows_of(1500), SCHEMA)
    sized, back = mixing.measured(docs, F.array("source"))
    sized = sized.cache()
    want = {(r.doc_id, r.taken) for r in mixing.take(sized, mixing.plan(sized), back).collect()}
    assert {(r.doc_id, r.taken) for r in mixing.take(sized, mixing.plan(sized, bucket_rows=1), back).collect()} == want
    assert len({d for d, _ in want}) == 1500


def test_columns_with_clashing_names(spark):
    names = ["last", "whole", "target", "rest", "part", "source_size", "Size", "taken", "pattern", "order_key", "_memberships"]
    docs = spark.createDataFrame(rows_of(60), SCHEMA)
    plain = {(r.doc_id, r.size, r.taken) for r in mixing.mix(docs).collect()}
    got = mixing.mix(docs.withColumns({n: F.lit(n) for n in names}))
    assert sorted(got.columns) == sorted([*docs.columns, "last", "whole", "rest", "part", "pattern", "order_key", "_memberships", "size", "source_size", "target", "taken"])
    rows = got.collect()
    assert {(r.doc_id, r.size, r.taken) for r in rows} == plain and all(r["last"] == "last" and r.pattern == "pattern" for r in rows)
    assert {(r.doc_id, r.taken) for r in mixing.mix(docs.withColumn("pattern", F.array("source")), F.col("pattern")).collect()} == {(d, t) for d, _, t in plain}


def test_line_dedup_with_clashing_names(spark):
    line = "a line that is long enough to be looked at by the operator"
    docs = spark.createDataFrame([(d, f"{line}\nown {d}") for d in range(6)], "doc_id long, text string")
    names = ["_id", "_hash", "_gone", "_lines", "n_lines", "N_dropped", "kept_text", "h1", "text_hash", "keeper", "batch"]
    got = line_dedup.dedup_lines(docs.withColumns({n: F.lit(n) for n in names})).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got) == [(d, 2, int(d < 5), f"own {d}" if d < 5 else f"{line}\nown 5") for d in range(6)]
    assert all((r["_id"], r["_hash"], r["_gone"], r["_lines"], r["h1"], r["keeper"]) == ("_id", "_hash", "_gone", "_lines", "h1", "keeper") for r in got)
