"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

1. toxicity: documents that score 0.7 or more go.
2. line dedup: lines of 40 or more code points in 5 or more documents stay in the largest doc_id alone.
3. MinHash near-dedup: one row of each near-duplicate class stays, that of the smallest doc_id.
4. mixing: sources are drawn down or repeated towards their target weights; a row for each copy.
5. packing: the copies' token ids in sequences of at most 2048.

No SQL states the first, third and last stage; each stage's operator is tested against a plain version, and the stages one after another on
what they keep and drop.

Cases, the same in all stages: null and empty texts stay through the first three stages and end at the mixing, which takes words;
repeated rows are rows of their own until near-dedup leaves one; rows without doc_id pass near-dedup as they are and pack like others;
columns beyond COLUMNS are dropped by the first stage, whatever their names; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm import line_dedup, mixing, near_dups, packing, toxicity
from pelagia.llm.common import Scratch, held, release

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is under REJECT.  The model learns from the labels of two thirds of the documents."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return toxicity.scored(docs.select(*COLUMNS), model).where(F.col("score") < REJECT).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that it shares with many others; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumns({"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, that of the smallest doc_id (repeated rows of it count once); rows without doc_id stay."""
    docs = docs.select(*COLUMNS)
    key = ["doc_id", F.xxhash64("text").alias("text_hash")]
    classes = near_dups.near_duplicate_classes(docs.select("doc_id", "text"))
    told = classes.groupBy("doc_id", "text_hash").agg(F.bool_and("is_first").alias("is_first"), F.count("*").alias("n")).where("NOT is_first OR n > 1")
    kept = docs.select("*", key[1]).join(told, ["doc_id", "text_hash"], "left").where("is_first IS NULL OR is_first")
    if told.where("is_first AND n > 1").limit(1).count() == 0:
        return kept.select(*COLUMNS)
    again = kept.where("n > 1").dropDuplicates(["doc_id", "text_hash"])
    return kept.where("n IS NULL").select(*COLUMNS).unionByName(again.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy that the plan takes; where a source's target ends inside a document, that copy ends there."""
    mixed = mixing.repeated(mixing.mix(docs.select(*COLUMNS)))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each sequence."""
    import public_tokenizers

    # The workers still hold what the stages before left in them.
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), max_chunks=200_000, batch_bytes=2 << 20)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written and read again; what a stage staged for itself is deleted after it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.conf.get(batch)
    spark.conf.set(batch, min(int(rows), 1000))  # long texts go to Python a thousand at a time, which bounds what a worker holds
    try:
        for name, stage in STAGES[:-1]:
            mark, own = held(), Scratch(spark)
            docs = own.staged(stage(spark, docs, sf_dir), name)
            release(mark)
            before.close()
            before = own
    finally:
        spark.conf.set(batch, rows)
    before.keep()  # the last stage reads it
    return STAGES[-1][1](spark, docs, sf_dir)
