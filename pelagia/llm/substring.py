"""Substring dedup by seed and extend.

Seeds: every run of `seed` words is hashed, and the smallest hash of the span - seed + 1 runs in a window of `span` words is that
window's anchor (winnowing), so equal windows share an anchor at the same place.  Anchors that documents share are joined with
the smallest occurrence (document, position) of the same hash; the pair is extended word by word both ways to its maximal repeat,
which counts when it has `span` words.

Only the smallest occurrence is paired, so a passage in n documents costs n pairs.  Windows of an anchor that the extension
doesn't cover differ from the smallest occurrence's, so they can only repeat in other occurrences whose own extension doesn't
cover them either; those few are compared among themselves by a 128-bit hash, which closes the search: no repeat is lost.

A window counts as repeated when its words also start in a document with a smaller doc_id; its words go from the larger one.
Texts are shuffled once, compressed, into a bucketed table that both the extension and the removal read; what travels besides is
the segments of text around shared anchors.  Until release() that table and the ranges stay in the shared folder for the lazy result.

Cases: a null or empty text has no words; repeats within one document don't count; rows that repeat a doc_id are told apart by a
64-bit hash of their text and judged against smaller ids only; copies of a row are looked at once and all get its outcome; rows without
doc_id keep every word; texts shorter than a window, too; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import Scratch, partitions, rolling, salted_lookup, word_hashes

SPAN, SEED = 50, 10


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but [\\x20\\x09-\\x0D]: bytes.split() separates at just those."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _tag(raw: bytes) -> int:
    """64 bits that tell the texts of one doc_id apart."""
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def winnow(words: list[bytes], seed: int = SEED, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every anchor: position, hash, and the first and last window (by its first word) that it is the anchor of."""
    if len(words) < span:
        return (np.zeros(0, np.int64),) * 4
    h = rolling(word_hashes(words), seed)
    width = span - seed + 1
    best = np.lib.stride_tricks.sliding_window_view(h, width).argmin(1) + np.arange(len(h) - width + 1)
    at, first = np.unique(best, return_index=True)
    return at, h[at], first, np.append(first[1:], len(best)) - 1


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, tag and the compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            raw = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_tag(r) for r in raw], pa.int64()), pa.array([z.compress(r) for r in raw], pa.binary())], ["doc_id", "tag", "zipped"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, tag long, zipped binary")


def anchors(docs: DataFrame, seed: int = SEED, span: int = SPAN) -> DataFrame:
    """h, doc_id, tag, place: every anchor of every text.

    place packs the position (31 bits) and how far before it its first and last window begin (6 each).
    """
    if not 0 < span - seed < 64:
        raise ValueError("a window may hold at most 63 words more than a seed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tags, place, h = [], [], [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                at, x, first, last = winnow(raw.split(), seed, span)
                if len(at):
                    ids.append(np.full(len(at), d, np.int64))
                    tags.append(np.full(len(at), _tag(raw), np.int64))
                    place.append(at << 12 | (at - first) << 6 | (at - last))
                    h.append(x.view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (h, ids, tags, place)], ["h", "doc_id", "tag", "place"])

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "h long, doc_id long, tag long, place long")


def _segments(span: int):
    """The stretches of a text that its shared anchors' windows cover, each with its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, z = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        names = ["doc_id", "tag", "segment", "words", "place", "h"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for b in batches:
            rows = []
            for d, tag, zipped, seeds in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                words, stretches = unzip.decompress(zipped.as_py()).split(), []
                for s in sorted(seeds, key=lambda s: s["place"]):
                    at = s["place"] >> 12
                    begin, end = at - (s["place"] >> 6 & 63), at - (s["place"] & 63) + span
                    if stretches and begin <= stretches[-1][1]:
                        stretches[-1][1] = max(stretches[-1][1], end)
                        stretches[-1][2].append(s)
                    else:
                        stretches.append([begin, end, [s]])
                rows += [(d, tag, begin, z.compress(b" ".join(words[begin:end])), [s["place"] for s in own], [s["h"] for s in own]) for begin, end, own in stretches]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _extend(seed: int, span: int):
    """Each pair of segments, extended at every anchor: the maximal repeats, and the digests of the windows outside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        names = ["doc_id", "tag", "begin", "finish", "window"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for b in batches:
            rows = []
            for d, tag, start, first_doc, first_start, pairs, own, other in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x, y = unzip.decompress(own).split(), unzip.decompress(other).split()
                done: dict[int, tuple[int, int]] = {}  # diagonal -> the last maximal repeat on it
                for p in sorted(pairs, key=lambda p: p["place"]):
                    at = (p["place"] >> 12) - start
                    to = (p["first"] >> 12) - first_start
                    low, high = at - (p["place"] >> 6 & 63), at - (p["place"] & 63)
                    left, right = done.get(at - to, (0, 0))
                    if not (left <= at and at + seed <= right):
                        if x[at : at + seed] == y[to : to + seed]:
                            left = at
                            while left and left > at - to and x[left - 1] == y[left - 1 - at + to]:
                                left -= 1
                            right = at + seed
                            while right < len(x) and right - at + to < len(y) and x[right] == y[right - at + to]:
                                right += 1
                            done[at - to] = left, right
                            if right - left >= span and first_doc < d:
                                rows.append((d, tag, start + left, start + right, None))
                        else:  # another run of words with the same hash
                            left = right = -1
                    for w in range(low, high + 1):
                        if not (left <= w and w + span <= right):
                            rows.append((d, tag, start + w, start + w + span, xxhash.xxh3_128_digest(b" ".join(x[w : w + span]))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def shared_seeds(docs: DataFrame, scratch: Scratch, seed: int = SEED, span: int = SPAN) -> DataFrame:
    """The anchors whose hash occurs in two documents or more, gathered by text: doc_id, tag, seeds.  Repeated rows count once."""
    found = scratch.staged(anchors(docs, seed, span), "anchors")
    shared = found.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("h")
    both = salted_lookup(found, shared, ["h"], "left_semi", 4)
    return both.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("place", "h")).alias("seeds"))


def repeats(texts: DataFrame, scratch: Scratch, seed: int = SEED, span: int = SPAN, pair_rows: int = 500) -> DataFrame:
    """doc_id, tag and the word ranges (begin, finish) that repeat a passage of a smaller doc_id; ranges may overlap.

    texts: doc_id, tag, zipped, seeds; one row of those that repeat a text of a doc_id is looked at.
    """
    once = texts.where("seeds IS NOT NULL").dropDuplicates(["doc_id", "tag"])  # bucketed by these: nothing moves
    segments = scratch.staged(once.select("doc_id", "tag", "zipped", "seeds").mapInArrow(_segments(span), "doc_id long, tag long, segment int, words binary, place array<long>, h array<long>"), "segments")
    single = segments.select("doc_id", "tag", "segment", F.explode(F.arrays_zip("place", "h")).alias("s")).select("doc_id", "tag", "segment", "s.place", "s.h")
    first = single.groupBy("h").agg(F.min(F.struct("doc_id", "tag", "place", "segment")).alias("first"))
    met = salted_lookup(single, first, ["h"], "inner", 4)
    pairs = met.groupBy("doc_id", "tag", "segment", F.col("first.doc_id").alias("first_doc"), F.col("first.tag").alias("first_tag"), F.col("first.segment").alias("first_segment")).agg(F.collect_list(F.struct("place", F.col("first.place").alias("first"))).alias("pairs"))
    pairs = scratch.staged(pairs, "segment_pairs")
    # A segment that many meet is repeated, so that no task extends more than about pair_rows pairs against it.
    spread = pairs.groupBy("first_doc", "first_tag", "first_segment").agg(F.ceil(F.count("*") / pair_rows).cast("int").alias("salts"))
    key = ["first_doc", "first_tag", "first_segment"]
    salted = salted_lookup(pairs, spread, key, "inner", 8).withColumn("salt", F.pmod(F.xxhash64("doc_id", "tag", "segment"), F.col("salts")).cast("int")).drop("salts")
    text = segments.select("doc_id", "tag", "segment", F.col("words").alias("own"))
    other = segments.select(F.col("doc_id").alias("first_doc"), F.col("tag").alias("first_tag"), F.col("segment").alias("first_segment"), F.col("words").alias("other"))
    other = other.join(spread, key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    # Merge joins at every size: whether a side is broadcast would otherwise hang on the input.
    ready = salted.join(text.hint("merge"), ["doc_id", "tag", "segment"]).join(other.hint("merge"), [*key, "salt"]).select("doc_id", "tag", "segment", "first_doc", "first_segment", "pairs", "own", "other")
    extended = scratch.staged(ready.mapInArrow(_extend(seed, span), "doc_id long, tag long, begin int, finish int, window binary"), "extended")
    open_ = extended.where("window IS NOT NULL").select("doc_id", "tag", "begin", "window")
    again = open_.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("window", "low")
    rest = salted_lookup(open_, again, ["window"], "inner", 4).where("low < doc_id").select("doc_id", "tag", "begin", (F.col("begin") + span).alias("finish"))
    return extended.where("window IS NULL").select("doc_id", "tag", "begin", "finish").unionByName(rest)


def _keep():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            n, gone, texts = [], [], []
            for zipped, begins, ends in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                words = z.decompress(zipped.as_py()).split()
                n.append(len(words))
                if begins:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, begins, 1)
                    np.add.at(cover, ends, -1)
                    keep = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
                    gone.append(len(words) - len(keep))
                    words = [words[i] for i in keep]
                else:
                    gone.append(0)
                texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, seed: int = SEED, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row of docs."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    scratch = Scratch(spark)
    table = f"substring_texts_{uuid.uuid4().hex[:12]}"
    joined = _packed(docs).join(shared_seeds(docs, scratch, seed, span).hint("merge"), ["doc_id", "tag"], "left")
    joined.write.bucketBy(n, "doc_id", "tag").option("path", scratch.path(table, table, keep=True)).format("parquet").saveAsTable(table)
    texts = spark.table(table)
    ranges = repeats(texts, scratch, seed, span).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("begin", "finish")).alias("r"))
    ranges = scratch.staged(ranges, "ranges", keep=True)
    scratch.close()
    both = texts.select("doc_id", "tag", "zipped").join(ranges.hint("merge"), ["doc_id", "tag"], "left").select("doc_id", "zipped", F.col("r.begin").alias("begin"), F.col("r.finish").alias("finish"))
    return both.mapInArrow(_keep(), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], span: int = SPAN) -> dict[int, tuple[int, int, str]]:
    """The contract, window by window, for tests on small inputs with distinct ids."""
    first: dict[tuple[bytes, ...], int] = {}
    split = {d: words_of(t) for d, t in rows}
    for d in sorted(split):
        w = split[d]
        for i in range(len(w) - span + 1):
            first.setdefault(tuple(w[i : i + span]), d)
    out = {}
    for d, w in split.items():
        keep = [True] * len(w)
        for i in range(len(w) - span + 1):
            if first[tuple(w[i : i + span])] < d:
                keep[i : i + span] = [False] * span
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out
