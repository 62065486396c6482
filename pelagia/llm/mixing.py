"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them).  Token capacity flows from patterns to
source quotas: the first copy of a pattern's tokens is free, each further copy costs more than the one before (convex), so the
flow repeats as little as the quotas allow.  The flow gives each pattern a number of tokens; its documents are taken in a seeded
order, whole, until that number is reached; the last one gives only the words still needed.

Only one row for each pattern reaches the driver, and the plan that goes back (one row for each pattern) is what is broadcast;
max_patterns bounds both and a corpus with more raises an error.  Each set of patterns that sources join is a flow of its own; one of
more than 2,000 patterns (about a minute for the driver, with two of 100 sources each) raises an error, too.  The order within a pattern is found by ranges of the seeded key, so no task holds a whole source.

Cases: a null source is a source of its own, last in order; a null or empty text has size 0 and is never taken; repeated rows
are rows of their own and share alike at the boundary; no documents, or only empty ones, give targets of 0; other columns pass
through, whatever their names, but size, source_size, target and taken, which the result replaces.
"""

from __future__ import annotations

import heapq
import json
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.llm.common import WORD, Scratch, free_names, set_aside

SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], total: int, weights: tuple[int, ...] = (5, 2, 1), ratio: Fraction = Fraction(3, 2), copies: int = 2) -> dict[str | None, Fraction]:
    """ratio * total shared by weight; none above copies * its size, the excess shared again by weight among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, Fraction] = {}
    left, open_ = ratio * total, list(order)
    while open_:
        whole = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / whole for s in open_}
        full = [s for s in open_ if share[s] > copies * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = Fraction(copies * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(capacity: dict[int, int], quota: dict[int, int], links: list[tuple[int, int]], copies: int = 2) -> dict[tuple[int, int], int]:
    """Tokens from patterns to sources: as much of the quotas as can be met, at the least cost.

    The k-th copy of a pattern's tokens costs k * k a token.  Successive shortest paths with potentials over the aggregated graph.
    """
    start, end = 0, 1
    left = {p: 2 + i for i, p in enumerate(capacity)}
    right = {s: 2 + len(left) + i for i, s in enumerate(quota)}
    edges: list[list[int]] = []  # to, capacity left, cost
    out: list[list[int]] = [[] for _ in range(2 + len(left) + len(right))]

    def edge(a: int, b: int, cap: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, cap, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    for p, cap in capacity.items():
        for k in range(copies):
            edge(start, left[p], cap, k * k)
    at = {(p, s): edge(left[p], right[s], copies * capacity[p], 0) for p, s in links}
    for s, cap in quota.items():
        edge(right[s], end, cap, 0)
    height = [0] * len(out)
    while True:
        dist: list[float] = [float("inf")] * len(out)
        via = [-1] * len(out)
        dist[start], heap = 0, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for e in out[a]:
                b, cap, cost = edges[e]
                if cap and (n := d + cost + height[a] - height[b]) < dist[b]:
                    dist[b], via[b] = n, e
                    heapq.heappush(heap, (n, b))
        if via[end] < 0:
            return {k: edges[e + 1][1] for k, e in at.items()}
        height = [h + (int(d) if d < float("inf") else 0) for h, d in zip(height, dist, strict=True)]
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = edges[via[b] ^ 1][0]
        push = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= push
            edges[e ^ 1][1] += push


def routed(capacity: dict[int, int], quota: dict[int, int], links: list[tuple[int, int]], copies: int = 2, max_joined: int = 2000) -> dict[int, int]:
    """Tokens that each pattern gives: one flow for each set of patterns that sources join, so disjoint sources cost no search."""
    root = {s: s for s in quota}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    first: dict[int, int] = {}
    for p, s in links:
        root[find(s)] = find(first.setdefault(p, s))
    parts: dict[int, list[tuple[int, int]]] = {}
    for p, s in links:
        parts.setdefault(find(s), []).append((p, s))
    out = dict.fromkeys(capacity, 0)
    for part in parts.values():
        patterns = {p: capacity[p] for p, _ in part}
        if len(patterns) > max_joined:
            raise ValueError(f"sources join more than {max_joined} membership patterns")
        for (p, _), x in min_cost_flow(patterns, {s: quota[s] for _, s in part}, part, copies).items():
            out[p] += x
    return out


def _order_key(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


#: Columns that the work adds and takes away again, and those that its result has.
INNER, RESULTS = ("pattern", "order_key", "whole", "rest", "last", "part"), ("size", "source_size", "target", "taken")


def measured(docs: DataFrame, memberships: Column) -> tuple[DataFrame, dict[str, str]]:
    """docs with size, pattern (its sorted memberships as JSON) and seeded order key; columns of those names are set aside."""
    (name,) = free_names(docs, "_memberships")
    docs, back = set_aside(docs.withColumn(name, memberships), INNER, RESULTS)
    sized = docs.withColumns({"size": word_count(F.col("text")), "pattern": F.to_json(F.array_sort(F.array_distinct(name)), {"ignoreNullFields": "false"}), "order_key": _order_key(F.col("doc_id"))})
    return sized.drop(name), back


def plan(sized: DataFrame, copies: int = 2, max_patterns: int = 100_000, bucket_rows: int = 2000) -> DataFrame:
    """One row for each pattern: whole copies of every document, and up to which document one more copy is taken.

    sized: doc_id, size, pattern, order_key (staged; it is read more than once).
    """
    spark = sized.sparkSession
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("cap"), F.count("*").alias("n")).orderBy("pattern").limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = [(r["pattern"], json.loads(r["pattern"]), r["cap"]) for r in rows]
    sizes: dict[str | None, int] = {}
    for _, sources, cap in patterns:
        for s in sources:
            sizes[s] = sizes.get(s, 0) + cap
    goal = targets(sizes, sum(cap for _, _, cap in patterns), copies=copies)
    names = list(goal)
    number = {s: i for i, s in enumerate(names)}
    quota = {number[s]: int(t + Fraction(1, 2)) for s, t in goal.items()}
    given = routed({i: cap for i, (_, _, cap) in enumerate(patterns)}, quota, [(i, number[s]) for i, (_, sources, _) in enumerate(patterns) for s in sources], copies)
    wanted = [(key, *divmod(given[i], cap), float(goal[sources[0]]) if sources else 0.0, sizes[sources[0]] if sources else 0) if cap else (key, 0, 0, 0.0, 0) for i, (key, sources, cap) in enumerate(patterns)]
    # The document at which the rest is reached: 256 ranges of the order key for each pattern, then 256 within the one where the rest
    # ends, until that holds about bucket_rows rows; these are put in order.  No step holds more than 256 sums of a pattern.
    most = max((r["n"] for r in rows), default=0)
    levels = max(1, -(-max(0, (most // bucket_rows).bit_length()) // 8))
    prefix = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")
    same = sized.where("size > 0").groupBy("pattern", "order_key", "doc_id", "size").agg(F.count("*").alias("n")).withColumns({"prefix": prefix, "words": F.col("size") * F.col("n")})
    open_ = F.broadcast(spark.createDataFrame([(w[0], w[2]) for w in wanted if w[2]], "pattern string, rest long"))
    reach = same.join(open_, "pattern")
    for level in range(1, min(levels, 4) + 1):
        sums = reach.withColumn("bucket", F.shiftright("prefix", 32 - 8 * level)).groupBy("pattern", "rest", "bucket").agg(F.sum("words").alias("words"))
        ahead = sums.withColumn("ahead", F.sum("words").over(W.partitionBy("pattern").orderBy("bucket")) - F.col("words"))
        edge = ahead.where("ahead < rest AND rest <= ahead + words").select("pattern", "bucket", (F.col("rest") - F.col("ahead")).alias("rest")).collect()  # a row a pattern at most
        table = F.broadcast(spark.createDataFrame(edge, "pattern string, bucket long, rest long"))
        reach = same.withColumn("bucket", F.shiftright("prefix", 32 - 8 * level)).join(table, ["pattern", "bucket"]).drop("bucket")
    before = F.sum("words").over(W.partitionBy("pattern").orderBy("order_key", "doc_id", "size")) - F.col("words")
    last = reach.withColumn("before", before).where("before < rest AND rest <= before + words").select("pattern", F.struct("order_key", "doc_id", "size").alias("last"), F.floor((F.col("rest") - F.col("before")) / F.col("n")).alias("part"))
    at = {r["pattern"]: (tuple(r["last"]), r["part"]) for r in last.collect()}  # one row a pattern at most
    return spark.createDataFrame([(*w, *at.get(w[0], (None, 0))) for w in wanted], "pattern string, whole long, rest long, target double, source_size long, last struct<order_key string, doc_id long, size long>, part long")


def take(sized: DataFrame, plan: DataFrame, back: dict[str, str]) -> DataFrame:
    """sized with target, source_size and taken (words, repeats counted); rows stay where they are."""
    here = F.struct("order_key", F.col("doc_id").cast("long").alias("doc_id"), "size")
    more = F.when(F.col("last").isNull(), 0).when(here < F.col("last"), F.col("size")).when(here == F.col("last"), F.col("part")).otherwise(0)
    out = sized.join(F.broadcast(plan), "pattern").withColumn("taken", (F.col("size") * F.col("whole") + more).cast("long"))
    return out.drop(*INNER).withColumnsRenamed(back)


def _small(sized: DataFrame, scratch: Scratch, keep: bool) -> DataFrame:
    return scratch.staged(sized.select("doc_id", "size", "pattern", "order_key"), "sizes", keep=keep)


def mix(docs: DataFrame, memberships: Column | None = None, copies: int = 2) -> DataFrame:
    """docs with size, source_size, target (its first source's) and taken.  memberships: an array of source names; source alone by default."""
    scratch = Scratch(docs.sparkSession)
    sized, back = measured(docs, F.array("source") if memberships is None else memberships)
    table = plan(_small(sized, scratch, keep=False), copies)
    scratch.close()
    return take(sized, table, back)


def sizes_and_taken(docs: DataFrame, memberships: Column | None = None, copies: int = 2) -> DataFrame:
    """As mix(), from the staged sizes alone: the texts are read once.  The sizes stay in the shared folder until release()."""
    sized, _ = measured(docs, F.array("source") if memberships is None else memberships)
    small = _small(sized, Scratch(docs.sparkSession), keep=True)
    return take(small, plan(small, copies), {})


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row for each copy taken; the copy that is cut short ends after the words it gives."""
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), 1, rest), "")
    copies = F.concat(F.array_repeat("text", whole), F.when(rest > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    return mixed.where("taken > 0").withColumn("text", F.explode(copies))
