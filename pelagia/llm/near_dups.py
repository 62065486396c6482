"""Near-duplicate classes by Order MinHash and banded alignment.

Sketches: a text's runs of five words are labelled by occurrence (the second "a b c d e" differs from the first).  Each of
`sketches` hash functions picks the `ell` smallest labelled runs and keeps them in text order; two texts that agree in one sketch
agree in those runs and in their order, so agreement follows edit similarity rather than mere overlap.

Links: texts with an equal sketch form a bucket.  Copies with equal words are one node.  Every node of a bucket is aligned with
the bucket's most central node (the one whose buckets are fullest), which costs a link a node and not a pair of nodes.  Where that
leaves a bucket in several components, the nodes outside its largest one meet the others inside tasks, by their rarest words: texts
that align share one of those (prefix filtering, below), so a link that the central node misses is still found.

Alignment: the longest common subsequence of words, within the band that the threshold allows; similarity is matched / (words of
both - matched).  One word in twenty changed breaks a quarter of the runs of five but leaves an alignment of 0.9.

Classes are connected components of the links, named by their smallest doc_id, found by label propagation over staged tables.

Words are compared without ASCII case and punctuation.  Cases: texts without words are in a class of their own each; texts
of fewer than five words are one run; rows with a null doc_id get a null class; rows that repeat a doc_id with other words are
judged each by their own; columns other than doc_id and text are not read.  The classes stay in the shared folder until release().
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import Scratch, mix64, rolling, salted_lookup, word_hashes

RUN, THRESHOLD, SKETCHES, ELL = 5, 0.8, 14, 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MARKS = bytes(c for c in range(33, 127) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LOWER, _MARKS).split() or raw.split()


def labelled(h: np.ndarray) -> np.ndarray:
    """Hashes that are different for each occurrence of the same hash; the first keeps its own."""
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    if not same.any():
        return h
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    nth = np.empty(len(h), np.uint64)
    nth[order] = (np.arange(len(h)) - start).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(nth > 0, mix64(h + nth * np.uint64(0x9E3779B97F4A7C15)), h)


def labelled_runs(words: list[bytes], run: int = RUN) -> np.ndarray:
    """A hash for each run of words, different for each occurrence of the same run."""
    return labelled(rolling(word_hashes(words), min(run, len(words)))) if words else np.zeros(0, np.uint64)


_ODD = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def order_sketches(runs: np.ndarray, sketches: int = SKETCHES, ell: int = ELL) -> np.ndarray:
    """For each hash function: the ell smallest labelled runs, hashed in text order."""
    if not len(runs):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = (runs[None] ^ _ODD[32 : 32 + sketches, None]) * _ODD[:sketches, None]
        h ^= h >> np.uint64(29)
        at = np.argpartition(h, ell - 1, axis=1)[:, :ell] if len(runs) > ell else np.broadcast_to(np.arange(len(runs)), (sketches, len(runs)))
        at = np.sort(at, axis=1)
        out = np.arange(1, sketches + 1, dtype=np.uint64)
        for j in range(at.shape[1]):
            out = mix64(out * np.uint64(3) + runs[at[:, j]])
    return out


def least_match(la: int, lb: int, threshold: float) -> int:
    """How many words must match for matched / (la + lb - matched) to reach the threshold."""
    return math.ceil(threshold / (1 + threshold) * (la + lb) - 1e-9)


def common_subsequence(a: list[int], b: list[int], band: int, block: int | None = None) -> int:
    """Length of the longest common subsequence, with matches at most about `band` places apart.

    Bits of one integer stand for the columns of a row of the usual table (0: the length grows here), so a row costs a few
    operations on whole integers; each block of rows works on the columns within its band.
    """
    full, block = (1 << len(b)) - 1, block or max(256, band)
    for begin in range(0, len(a), block):
        rows = a[begin : begin + block]
        low, high = max(0, begin - band), min(len(b), begin + len(rows) + band)
        if low >= high:
            break
        at: dict[int, int] = {}
        for j in range(low, high):
            at[b[j]] = at.get(b[j], 0) | 1 << (j - low)
        mask = (1 << (high - low)) - 1
        v = full >> low & mask
        for x in rows:
            if m := at.get(x):
                u = v & m
                v = ((v + u) | (v - u)) & mask
        full = full & ~(mask << low) | v << low
    return len(b) - full.bit_count()


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of the best alignment of two lists of word hashes; 0.0 where it can't reach the threshold."""
    la, lb = len(a), len(b)
    if not la or not lb or min(la, lb) < threshold * max(la, lb) - 1e-9:
        return 0.0
    need, n = least_match(la, lb, threshold), min(la, lb)
    band = la + lb - 2 * need
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(a[la - n + head :][::-1] != b[lb - n + head :][::-1])
    tail = int(differ[0]) if len(differ) else n - head
    a, b = a[head : la - tail], b[head : lb - tail]
    if len(a) * len(b) > 10_000:  # a bound first: words in common, in any order
        ua, ca = np.unique(a, return_counts=True)
        ub, cb = np.unique(b, return_counts=True)
        _, x, y = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
        if head + tail + int(np.minimum(ca[x], cb[y]).sum()) < need:
            return 0.0
    m = head + tail + common_subsequence(a.tolist(), b.tolist(), band)
    return m / (la + lb - m) if m >= need else 0.0


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same, sk = [], []
            for t in b.column(1):
                words = words_of((t.as_py() or "").encode("utf-8", "surrogatepass"))
                same.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                sk.append(order_sketches(labelled_runs(words)).view(np.int64))
            ends = np.cumsum([0, *map(len, sk)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *sk]), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(same, pa.binary()), lists], ["doc_id", "text_hash", "same", "sketches"])

    return _keyed(docs).mapInArrow(run, "doc_id long, text_hash long, same binary, sketches array<long>")


def _zipped(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            zipped = pa.array([z.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), zipped], ["doc_id", "text_hash", "zipped"])

    return _keyed(docs).mapInArrow(run, "doc_id long, text_hash long, zipped binary")


def _with_words(zipped: DataFrame) -> DataFrame:
    """node and words: the hashes of its text's words, 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            words = [(word_hashes(words_of(z.decompress(x.as_py()))) >> np.uint64(32)).astype(np.uint32).tobytes() for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.binary())], ["node", "words"])

    return zipped.select("node", "zipped").mapInArrow(run, "node long, words binary")


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """a, b of the pairs (a, b, words_a, words_b) whose alignment reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [aligned_similarity(np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32), threshold) >= threshold for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "words_a", "words_b").mapInArrow(run, "a long, b long")


def links_of(pairs: DataFrame, words: DataFrame, threshold: float, unit_rows: int) -> DataFrame:
    """The pairs (a, b) whose texts align.  A node b of many pairs is repeated, so that no task aligns more than about unit_rows with it.

    These joins keep one form at every size: whether a side is broadcast would otherwise hang on the input.
    """
    spread = pairs.groupBy("b").agg(F.ceil(F.count("*") / unit_rows).cast("int").alias("salts"))
    left = salted_lookup(pairs, spread, ["b"], "inner").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")).join(words.select(F.col("node").alias("a"), F.col("words").alias("words_a")).hint("merge"), "a")
    right = words.select(F.col("node").alias("b"), F.col("words").alias("words_b")).join(spread, "b").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return _verified(left.join(right.hint("merge"), ["b", "salt"]), threshold)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the smallest node that links (a, b) connect it to.  Nodes without a link have no row."""
    work, old = Scratch(scratch.spark), Scratch(scratch.spark)
    both = work.staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = old.staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = salted_lookup(both.withColumnRenamed("b", "node"), labels, ["node"], "inner", 8).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # Follow the label's own label: chains halve in every round.
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        fresh = Scratch(scratch.spark)
        new = fresh.staged(salted_lookup(step, ahead, ["label"], "left", 8).select("node", "old", F.least("label", "jump").alias("label")), "labels")
        old.close()
        old, labels = fresh, new.select("node", "label")
        if new.where("old <> label").limit(1).count() == 0:
            work.close()
            scratch.own |= fresh.own
            return labels


def _rarest(tokens: list[np.ndarray], threshold: float) -> list[np.ndarray]:
    """Of each text its size - threshold * size + 1 rarest tokens, as ranks.

    Texts that align at the threshold have threshold * size tokens of the larger one in common.  In whatever order tokens stand, each
    then has one of the common ones among so many first; with the rarest first, few other texts have those.
    """
    size = np.array([len(t) for t in tokens])
    _, number, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    parts = np.split(rank[number], np.cumsum(size)[:-1])
    return [np.sort(r)[: len(r) - math.ceil(threshold * len(r) - 1e-9) + 1] for r in parts]


def _across(threshold: float):
    """Links between components inside one unit of a bucket: texts that share a rare token are aligned unless they are joined already."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "node"], kind="stable")
        nodes, labels, side = group["node"].tolist(), group["label"].tolist(), group["side"].to_numpy()
        words = [np.frombuffer(w, np.uint32) for w in group["words"]]
        root = {x: x for x in labels}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        size = np.array([len(w) for w in words])
        first = _rarest([labelled(w.astype(np.uint64)) for w in words], threshold)
        owner = np.repeat(np.arange(len(first)), [len(f) for f in first])
        order = np.argsort(np.concatenate(first), kind="stable")
        flat, owner = np.concatenate(first)[order], owner[order]
        within = int(group["within"].iloc[0])  # 1: all pairs; 0: pairs of the two sides
        out = []
        for i in range(len(nodes)) if within else np.flatnonzero(side == 1).tolist():
            low, high = np.searchsorted(flat, first[i], "left"), np.searchsorted(flat, first[i], "right")
            n = high - low
            near = np.unique(owner[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])
            near = near[(near < i) if within else (side[near] == 0)]
            near = near[np.minimum(size[near], size[i]) >= threshold * np.maximum(size[near], size[i]) - 1e-9]
            for j in near.tolist():
                a, b = find(labels[i]), find(labels[j])
                if a != b and aligned_similarity(words[i], words[j], threshold) >= threshold:
                    root[max(a, b)] = min(a, b)
                    out.append((nodes[i], nodes[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def units(open_: DataFrame, unit_rows: int) -> DataFrame:
    """The nodes of split buckets (key, node, label), dealt over units of at most about 2 * unit_rows: key, kind, low, high, within, side.

    The largest component of a bucket is dealt over blocks, the nodes outside it over blocks of their own.  A unit holds a block of
    each, or two blocks of outside nodes: nodes of the largest component never meet one another.  Few outside nodes cost a row each
    for every block of the others, and those one row each.
    """
    mass = open_.groupBy("key", "label").agg(F.count("*").alias("mass"))
    main = mass.groupBy("key").agg(F.max_by("label", F.struct("mass", "label")).alias("main"), F.max("mass").alias("n_main"), F.sum("mass").alias("n"))
    rows = salted_lookup(open_, main, ["key"], "inner")
    blocks = lambda n: F.ceil(n / unit_rows).cast("int")
    rows = rows.withColumns({"of_main": blocks(F.col("n_main")), "of_rest": blocks(F.col("n") - F.col("n_main")), "is_main": F.col("label") == F.col("main")})
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("of_main")).otherwise(F.col("of_rest"))).cast("int"))
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    core = rows.where("is_main").select("key", "node", "label", F.lit(0).alias("kind"), F.col("block").alias("low"), others("of_rest").alias("high"), F.lit(0).alias("within"), F.lit(0).alias("side"))
    rest = rows.where("NOT is_main")
    met = rest.select("key", "node", "label", F.lit(0).alias("kind"), others("of_main").alias("low"), F.col("block").alias("high"), F.lit(0).alias("within"), F.lit(1).alias("side"))
    both = rest.select("key", "node", "label", "block", others("of_rest").alias("other")).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    both = both.select("key", "node", "label", F.lit(1).alias("kind"), "low", "high", (F.col("low") == F.col("high")).cast("int").alias("within"), (F.col("block") == F.col("high")).cast("int").alias("side"))
    return core.unionByName(met).unionByName(both)


def across(open_: DataFrame, words: DataFrame, threshold: float, unit_rows: int) -> DataFrame:
    """Links (a, b) between components of the split buckets open_ (key, node, label)."""
    rows = units(open_, unit_rows).join(words.hint("merge"), "node")
    return rows.groupBy("key", "kind", "low", "high").applyInPandas(_across(threshold), "a long, b long")


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, unit_rows: int = 800) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class), text_hash (xxhash64 of the text) and is_first for every row of docs that
    has a doc_id.  is_first marks the (doc_id, text_hash) that may stand for the class: the smallest; rows that repeat it share it."""
    scratch = Scratch(docs.sparkSession)
    texts = scratch.staged(_sketched(docs), "sketches")
    nodes = texts.where("same IS NOT NULL").groupBy("same").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("sketches").alias("sketches"))
    nodes = scratch.staged(nodes.select("same", F.xxhash64("same").alias("node"), "rep", "sketches"), "nodes")
    keyed = nodes.select("node", F.explode("sketches").alias("key")).distinct()
    # Buckets of the same nodes count once.
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members")).where("n > 1")
    buckets = buckets.groupBy("n", "members").agg(F.min("key").alias("key")).select("key", "n")
    inside = scratch.staged(salted_lookup(keyed, buckets, ["key"], "inner"), "buckets")
    central = inside.groupBy("node").agg(F.sum("n").alias("fullness"))
    heads = inside.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("fullness", "node")).alias("head"))
    pairs = salted_lookup(inside.select("key", "node"), heads, ["key"], "inner").where("node <> head").select(F.least("node", "head").alias("x"), F.greatest("node", "head").alias("y"), F.col("node").alias("a"), F.col("head").alias("b")).dropDuplicates(["x", "y"]).select("a", "b")
    pairs = scratch.staged(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct().join(nodes.select("node", "rep.doc_id", "rep.text_hash"), "node")
    words = scratch.staged(_with_words(_zipped(docs).join(wanted.hint("merge"), ["doc_id", "text_hash"])).dropDuplicates(["node"]), "words")
    links = scratch.staged(links_of(pairs, words, threshold, unit_rows), "links")
    # Buckets that are still in several components, and hold pairs that no alignment has tried.
    label = components(links, scratch)
    known = inside.where("n > 2").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    open_ = scratch.staged(salted_lookup(known.select("key", "node", "label"), split, ["key"], "left_semi", 4), "open")
    more = scratch.staged(across(open_, words, threshold, unit_rows), "more_links")
    label = components(links.unionByName(more), scratch)
    labelled_nodes = nodes.join(label, "node", "left").select("same", "rep", F.coalesce("label", "node").alias("label"))
    firsts = labelled_nodes.groupBy("label").agg(F.min("rep").alias("first"))
    classes = salted_lookup(labelled_nodes.select("same", "label"), firsts, ["label"], "inner", 8).select("same", "first")
    out = salted_lookup(texts.select("doc_id", "text_hash", "same"), classes, ["same"], "left")
    is_first = F.coalesce((F.col("doc_id") == F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")), F.lit(True))
    out = scratch.staged(out.select("doc_id", F.coalesce("first.doc_id", "doc_id").alias("class_id"), "text_hash", is_first.alias("is_first")), "classes", keep=True)
    scratch.close()
    return out


def digest_rows(docs: DataFrame, **settings) -> DataFrame:
    """doc_id and class_id of every row; null ids have null classes."""
    none = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id"))
    return near_duplicate_classes(docs, **settings).select("doc_id", "class_id").unionByName(none)
