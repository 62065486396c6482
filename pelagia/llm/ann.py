"""Approximate nearest neighbours over balanced posting lists.

fit() chooses centroids by balanced k-means over a bounded sample (at most `sample_rows` vectors); every vector then joins the
list of its nearest centroid and, when it lies near a boundary, the lists of further centroids whose distance is within
`boundary` times the nearest (at most `replicas` lists).  The centroids are searched by a graph in memory: each is linked to its
nearest others, and a best-first walk visits a few of them for each vector.  A query reads all lists whose centroids are within
`prune` times the distance of its nearest one (where the walk ends before that bound, all centroids are compared), at least
`least_lists`, and goes on through the list of centroids until the lists it has hold enough rows.  No number of lists ends this: where
distances hardly differ, as for isotropic vectors, the bound admits nearly all lists, and the search is nearly a full scan.

The centroids, with their links and list sizes, are what is broadcast: at most `max_lists` of them, whatever the input.  A list
of any size is dealt over blocks of at most about `block_rows` rows (a hot vector's list too), small lists share a block, and each
block answers the queries that read its lists in chunks; only the k best of each block go on.  All vectors are indexed; the ranking uses the original
components in double precision.

Cases: vectors that are null, zero, of another length than the sample's most common one, or hold null or non-finite components
take no part; rows that repeat a vec_id count once (the smallest embedding); with fewer than k candidates all are returned;
equal distances go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.llm.common import Scratch, smallest_hashes


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 8, weight: float = 1.0, seed: int = 7) -> np.ndarray:
    """k centroids whose clusters differ little in size: a cluster above its share is made to look farther away."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].astype(np.float64)
    share, penalty = len(x) / k, np.zeros(k)
    for _ in range(rounds):
        near = np.concatenate([(_squares(x[a : a + 2000], c) + penalty).argmin(1) for a in range(0, len(x), 2000)])
        count = np.bincount(near, minlength=k)
        spread = float(np.mean(((x - c[near]) ** 2).sum(1)))
        penalty = np.maximum(penalty + weight * spread * 0.2 * (count / share - 1).clip(-1, 1), 0)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.choice(len(x), k)])
    return np.unique(c, axis=0)


@dataclass
class Graph:
    """Centroids linked to their nearest others, and to a few far ones so that every centroid can be reached."""

    points: np.ndarray
    links: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = len(self.points)
        degree = min(16, n - 1)
        near = np.concatenate([np.argsort(_squares(self.points[a : a + 1000], self.points), axis=1, kind="stable")[:, 1 : degree + 1] for a in range(0, n, 1000)]) if n > 1 else np.zeros((1, 0), np.int64)
        far = np.random.default_rng(3).integers(0, n, (n, 4 if n > 1 else 0))
        ring = (np.arange(n)[:, None] + 1) % n
        self.links = np.concatenate([near, far, ring], axis=1)
        self.starts = np.linspace(0, n - 1, min(n, 16)).astype(np.int64)

    def search(self, v: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest centroids found by a best-first walk, nearest first, and their distances."""
        d = np.sqrt(((self.points[self.starts] - v) ** 2).sum(1))
        seen = np.zeros(len(self.points), bool)
        seen[self.starts] = True
        todo = list(zip(d.tolist(), self.starts.tolist(), strict=True))
        heapq.heapify(todo)
        best = [(-a, b) for a, b in todo]
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        while todo:
            a, i = heapq.heappop(todo)
            if len(best) >= width and a > -best[0][0]:
                break
            new = self.links[i][~seen[self.links[i]]]
            if not len(new):
                continue
            new = np.unique(new)
            seen[new] = True
            for b, j in zip(np.sqrt(((self.points[new] - v) ** 2).sum(1)).tolist(), new.tolist(), strict=True):
                if len(best) < width or b < -best[0][0]:
                    heapq.heappush(todo, (b, j))
                    heapq.heappush(best, (-b, j))
                    if len(best) > width:
                        heapq.heappop(best)
        found = sorted((-a, j) for a, j in best)
        return np.array([j for _, j in found]), np.array([a for a, _ in found])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part, one row a vec_id."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    out = vectors.select("vec_id", x.alias("embedding")).where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda e: e != 0))
    out = out if dim is None else out.where(F.size("embedding") == dim)
    return out.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


@dataclass
class PostingLists:
    graph: Graph | None
    dim: int
    list_rows: int = 200
    boundary: float = 1.15
    replicas: int = 4
    prune: float = 1.35
    least_lists: int = 24
    block_rows: int = 4000
    query_rows: int = 1000

    @classmethod
    def fit(cls, vectors: DataFrame, sample_rows: int = 20_000, max_lists: int = 4096, list_rows: int = 200, **settings) -> PostingLists:
        """Centroids from the sample_rows vectors with the smallest hashes; one list for each list_rows vectors, max_lists at most."""
        ok = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        n = ok.count()
        sample = smallest_hashes(ok.withColumn("order", F.xxhash64(F.lit("ann"), "vec_id")), "order", n, sample_rows).orderBy("order", "vec_id").limit(sample_rows)
        rows = [r for r in sample.toPandas()["embedding"] if r is not None and len(r)]
        sizes = [len(r) for r in rows]
        if not rows:
            return cls(None, 0, list_rows, **settings)
        dim = max(set(sizes), key=lambda s: (sizes.count(s), s))
        x = np.array([np.array([np.nan if v is None else v for v in r], np.float64) for r in rows if len(r) == dim])
        x = x[np.isfinite(x).all(1) & (x != 0).any(1)]
        if not len(x):
            return cls(None, dim, list_rows, **settings)
        distinct = np.unique(x, axis=0)  # copies of one vector need no centroids of their own
        centroids = balanced_kmeans(distinct, int(min(max_lists, max(1, n // list_rows), max(1, len(distinct) // 4))))
        return cls(Graph(centroids), dim, list_rows, **settings)

    def assign(self, vectors: DataFrame) -> DataFrame:
        """vec_id, embedding, list, primary: a row for each list that holds the vector."""
        graph = vectors.sparkSession.sparkContext.broadcast(self.graph)
        boundary, replicas = self.boundary, self.replicas

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = _matrix(b.column(1))
                at, lists = [], []
                for i, v in enumerate(x):
                    c, d = graph.value.search(v, 4 * replicas)
                    own = c[:replicas][d[:replicas] <= boundary * d[0]]
                    at += [i] * len(own)
                    lists += own.tolist()
                first = np.concatenate([[True], np.diff(at) > 0])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(lists, pa.int32()), pa.array(first)], ["vec_id", "embedding", "list", "is_primary"])

        return usable(vectors, self.dim).mapInArrow(run, "vec_id long, embedding array<double>, list int, is_primary boolean")

    def probes(self, queries: DataFrame, held: dict[int, int], k: int) -> DataFrame:
        """query_id, embedding, lists: the lists that each query reads.  held: rows of which each list is the nearest one."""
        spark = queries.sparkSession
        sent = spark.sparkContext.broadcast((self.graph, np.array([held.get(i, 0) for i in range(len(self.graph.points))])))
        prune, least = self.prune, self.least_lists

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            graph, rows = sent.value
            for b in batches:
                if not b.num_rows:
                    continue
                lists = []
                for v in _matrix(b.column(1)):
                    c, d = graph.search(v, 4 * least)
                    keep = max(least, int(np.searchsorted(d, prune * d[0], side="right")))
                    if keep >= len(c) or rows[c[:keep]].sum() <= k:  # the walk ends before the bound, or few rows near by: all centroids in order
                        d = np.sqrt(_squares(v[None], graph.points)[0])
                        c = np.argsort(d, kind="stable")
                        enough = int(np.searchsorted(np.cumsum(rows[c]), k + 1)) + 1
                        keep = max(least, int((d <= prune * d.min()).sum()), enough)
                    lists.append(c[:keep])
                ends = np.cumsum([0] + [len(c) for c in lists])
                kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), kept], ["query_id", "embedding", "lists"])

        return queries.mapInArrow(run, "query_id long, embedding array<double>, lists array<int>")

    def units(self, rows: dict[int, int]) -> np.ndarray:
        """The unit of each list: lists that share a block, as long as they hold block_rows rows at most; a longer list is alone."""
        out, unit, held = np.zeros(len(self.graph.points), np.int32), 0, 0
        for i in range(len(out)):
            n = rows.get(i, 0)
            if held and held + n > self.block_rows:
                unit, held = unit + 1, 0
            out[i], held = unit, held + n
        return out

    def search(self, vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
        """query_id, rank, vec_id, score (Euclidean distance): the k nearest found of each row that is_query admits."""
        spark = vectors.sparkSession
        if self.graph is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        scratch = Scratch(spark)
        lists = scratch.staged(self.assign(vectors), "posting_lists", keep=True)
        sizes = lists.groupBy("list").agg(F.count("*").alias("rows"), F.sum(F.col("is_primary").cast("int")).alias("own")).collect()  # at most max_lists rows
        queries = usable(vectors.where(is_query), self.dim).withColumnRenamed("vec_id", "query_id")
        probes = scratch.staged(self.probes(queries, {r["list"]: r["own"] for r in sizes}, k), "probes", keep=True)
        unit_of = self.units({r["list"]: r["rows"] for r in sizes})
        sent = spark.sparkContext.broadcast(unit_of)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, lists in enumerate(b.column(2)):
                    by = pd.Series(lists.values.to_numpy()).groupby(sent.value[lists.values.to_numpy()]).agg(list)
                    n = pa.array(np.full(len(by), i))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(n), b.column(1).take(n), pa.array(by.index.to_numpy(), pa.int32()), pa.array(by.tolist(), pa.list_(pa.int32()))], ["query_id", "embedding", "unit", "lists"])

        asks = probes.mapInArrow(spread, "query_id long, embedding array<double>, unit int, lists array<int>")
        asked = {r["unit"]: r["n"] for r in asks.groupBy("unit").agg(F.count("*").alias("n")).collect()}  # at most max_lists rows
        held = np.bincount(unit_of[[r["list"] for r in sizes]], [r["rows"] for r in sizes], unit_of.max() + 1).astype(int).tolist() if sizes else []
        blocks = spark.createDataFrame([(u, -(-n // self.block_rows), -(-asked.get(u, 0) // self.query_rows)) for u, n in enumerate(held)], "unit int, blocks int, chunks int")
        blocks = F.broadcast(blocks.where("blocks > 0 AND chunks > 0"))  # at most max_lists rows
        names = F.broadcast(spark.createDataFrame(list(enumerate(unit_of.tolist())), "list int, unit int"))
        rows = lists.join(names, "list").join(blocks, "unit").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        rows = rows.select("unit", "block", "chunk", "list", "vec_id", "embedding")
        asks = asks.join(blocks, "unit").withColumn("chunk", F.pmod(F.xxhash64(F.lit(5), "query_id"), F.col("chunks")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asks = asks.select("unit", "block", "chunk", "query_id", "embedding", "lists")

        def nearest(a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            if a.empty or q.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            ids, first, number = np.unique(a["vec_id"].to_numpy(), return_index=True, return_inverse=True)  # a vector may be in several of the lists
            x = np.stack(a["embedding"].to_numpy()[first])
            names, place = np.unique(a["list"].to_numpy(), return_inverse=True)
            holds = np.zeros((len(names), len(ids)), np.float32)
            holds[place, number] = 1
            squares, out = (x * x).sum(1), []
            for at in range(0, len(q), 200):
                part = q.iloc[at : at + 200]
                y = np.stack(part["embedding"].to_numpy())
                reads = np.array([np.isin(names, lists) for lists in part["lists"]], np.float32)
                near_by = (reads @ holds > 0) & (ids[None] != part["query_id"].to_numpy()[:, None])
                whole = (y * y).sum(1)
                about = squares + whole[:, None] - 2 * y @ x.T  # rough: decides only which rows are measured
                slack = 1e-9 * (squares.max() + whole)
                for query, v, mine, rough, tol in zip(part["query_id"], y, near_by, about, slack, strict=True):
                    near = np.flatnonzero(mine)
                    if len(near) > k and np.isfinite(rough).all():
                        rough = rough[near]
                        near = near[rough <= np.partition(rough, k - 1)[k - 1] + tol]
                    diff = x[near] - v
                    d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                    best = np.argsort(d, kind="stable")[:k]  # ids ascend, so ties keep their order
                    out.append((np.full(len(best), query), ids[near[best]], d[best]))
            return pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("query_id", "vec_id", "score"))})

        found = rows.groupBy("unit", "block", "chunk").cogroup(asks.groupBy("unit", "block", "chunk")).applyInPandas(nearest, "query_id long, vec_id long, score double")
        once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # a vector may be in several blocks
        rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
        return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
