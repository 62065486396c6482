"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line hashes, bucketed and sorted by hash, so that a new batch meets every run in a merge join without
moving the run.  A batch is reduced to one row for each hash; the rows that no run holds (merge anti joins) become a new run of
level 0, the others only add to the tallies.  When a level holds `fanout` runs they are merged into one run of the next level,
so a batch meets at most fanout * levels runs, and every hash is rewritten once for each level.

Batches go from the largest doc_id to the smallest, so the batch in which a hash is novel holds the document that keeps the line.

Cases: a null or empty text is one empty line; rows with a null doc_id keep all their lines and are counted nowhere; repeated
rows of one doc_id count as one document; other columns pass through untouched, whatever their names, but n_lines, n_dropped and
kept_text, which the result replaces.  Until release() the positions of lost lines stay in the shared folder for the lazy result.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm.common import BLANKS, Scratch, free_names, partitions, set_aside

KEY = ["h1", "h2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_hash, pos and the 128-bit key hash of every line of at least min_chars code points."""
    lines = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


class LineRuns:
    """The levels of runs.  Tables live in the shared folder under names of their own; close() deletes them."""

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        self.spark, self.fanout, self.buckets = spark, fanout, buckets or partitions(spark)
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.levels: list[list[str]] = [[]]
        self.tallies: list[str] = []
        self.merged: list[str] = []  # runs that a merged one replaces
        self.scratch = Scratch(spark)
        self.at: dict[str, str] = {}  # table -> path

    def _write(self, rows: DataFrame, kind: str) -> str:
        table = f"{self.name}_{kind}{len(self.at) + 1}"
        self.at[table] = self.scratch.path(table, table)
        out = rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        out.option("path", self.at[table]).format("parquet").saveAsTable(table)
        return table

    def _drop(self, tables: list[str]) -> None:
        for t in tables:
            self.scratch.drop(self.at[t])

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch (doc_id, h1, h2); returns its novel hashes with the largest doc_id that holds each.  Read them before the
        next batch, which deletes the runs that were merged."""
        self._drop(self.merged)
        self.merged = []
        entries = lines.groupBy("doc_id", *KEY).agg(F.count("*").alias("lines")).groupBy(*KEY).agg(F.count("*").alias("docs"), F.sum("lines").alias("lines"), F.max("doc_id").alias("keeper"))
        batch = self._write(entries, "batch")
        novel = self.spark.table(batch)
        for run in [t for level in self.levels for t in level]:
            novel = novel.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        run = self._write(novel, "run")
        repeats = self.spark.table(batch).join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        self.tallies.append(self._write(repeats.select(*KEY, "docs", "lines"), "tally"))
        self._drop([batch])
        self.levels[0].append(run)
        self._compact()
        return self.spark.table(run)

    def _compact(self) -> None:
        """Merge full levels, from the lowest up."""
        for at in range(len(self.levels)):
            if len(self.levels[at]) < self.fanout:
                return
            if at + 1 == len(self.levels):
                self.levels.append([])
            old = self.levels[at]
            merged = reduce(DataFrame.unionByName, [self.spark.table(t) for t in old])  # a hash is novel once: no two runs share one
            self.levels[at + 1].append(self._write(merged, f"level{at + 1}_"))
            self.levels[at] = []
            self.merged += old

    def totals(self) -> DataFrame:
        """For each hash: documents, lines and the document that keeps it."""
        runs = [self.spark.table(t).select(*KEY, "docs", "lines", "keeper") for level in self.levels for t in level]
        more = [self.spark.table(t).select(*KEY, "docs", "lines", F.lit(None).cast("long").alias("keeper")) for t in self.tallies]
        return reduce(DataFrame.unionByName, runs + more).groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("lines").alias("lines"), F.max("keeper").alias("keeper"))

    def close(self) -> None:
        self.scratch.close()


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4) -> DataFrame:
    """doc_id, text_hash and the positions of the lines that go, for the documents that lose any."""
    scratch = Scratch(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    batch = reduce(lambda out, cut: out + (F.col("doc_id") <= F.lit(cut)).cast("int"), sorted(set(cuts)), F.lit(0))
    lines = scratch.staged(line_hashes(docs, min_chars).withColumn("batch", batch), "lines", ["batch"])
    runs = LineRuns(docs.sparkSession)
    for b in range(len(set(cuts)) + 1):  # from the largest ids down
        runs.add(lines.where(F.col("batch") == b).drop("batch"))
    common = scratch.staged(runs.totals().where(F.col("docs") >= min_docs), "common_lines")
    runs.close()
    # At most 2,000 keys can hold more than one line in 2,000 each: those are broadcast, all others meet in a shuffle.
    total = common.agg(F.sum("lines")).first()[0] or 0
    bound = max(1000, total // 2000)
    heavy = F.broadcast(common.where(F.col("lines") > bound).select(*KEY, F.lit(True).alias("is_heavy"), F.col("keeper").alias("heavy_keeper")))
    marked = lines.drop("batch").join(heavy, KEY, "left")
    light = marked.where(F.col("is_heavy").isNull()).drop("heavy_keeper").join(common.where(F.col("lines") <= bound).select(*KEY, "keeper"), KEY)
    gone = marked.where(F.col("is_heavy")).select("doc_id", "text_hash", "pos", F.col("heavy_keeper").alias("keeper")).unionByName(light.select("doc_id", "text_hash", "pos", "keeper")).where(F.col("doc_id") != F.col("keeper"))
    out = scratch.staged(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone")), "gone_lines", keep=True)
    scratch.close()
    return out


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4) -> DataFrame:
    """docs with n_lines, n_dropped and kept_text: keys of at least min_chars code points in at least min_docs documents stay
    only in the largest doc_id that holds them."""
    gone = dropped_lines(docs, min_chars, min_docs, batches)
    docs, _ = set_aside(docs, (), ("n_lines", "n_dropped", "kept_text"))
    doc, text, at, ls = free_names(docs, "_id", "_hash", "_gone", "_lines")
    gone = gone.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text), F.col("gone").alias(at))
    both = docs.join(gone, (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(text)), "left")
    lines = both.withColumn(ls, lines_of(F.col("text"))).withColumn("n_lines", F.size(ls).cast("long"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(at))
    lines = lines.withColumn("n_dropped", F.when(F.col(at).isNull(), F.lit(0)).otherwise(F.size(at)).cast("long"))
    whole = F.when(F.col(at).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col(ls), i)), "\n"))
    return lines.withColumn("kept_text", whole).drop(doc, text, at, ls)
