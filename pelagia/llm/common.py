"""What the operators share: staged tables, salted joins and word hashing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    A folder of its own is made only where the setting is missing and Spark runs in one process.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pelagia-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/pelagia/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: What lazy results still read: (session, path, table or "").
_HELD: list[tuple[SparkSession, str, str]] = []


def held() -> int:
    """A mark for release(): the tables that are held by now."""
    return len(_HELD)


def release(after: int = 0) -> None:
    """Delete the staged tables that lazy results read, those held after a mark.  Call it when the results are written; all go when Python ends."""
    while len(_HELD) > after:
        spark, path, table = _HELD.pop()
        if spark.sparkContext._jsc is not None:  # else the session is over, and its folder with it
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove(spark, path)


atexit.register(release)


class Scratch:
    """The tables that one query stages in the shared folder; close() deletes all but those that its lazy result reads (keep)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.own: dict[str, str] = {}  # path -> table or ""

    def staged(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), keep: bool = False) -> DataFrame:
        """Write df once and read it back: the lineage ends, and lost executors cost no rerun of df."""
        path = self.path(name, keep=keep)
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str, table: str = "", keep: bool = False) -> str:
        path = fresh_path(self.spark, name)
        if keep:
            _HELD.append((self.spark, path, table))
        else:
            self.own[path] = table
        return path

    def drop(self, path: str) -> None:
        table = self.own.pop(path)
        if table:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(self.spark, path)

    def keep(self) -> None:
        """Leave all tables to release()."""
        _HELD.extend((self.spark, path, table) for path, table in self.own.items())
        self.own.clear()

    def close(self) -> None:
        for path in list(self.own):
            self.drop(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """wanted, each with underscores added until df has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def set_aside(df: DataFrame, inner: Sequence[str], results: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """df without the columns that results will replace, and with those that share a name with inner columns renamed; the way back."""
    taken = {n.lower() for n in inner}
    out = df.drop(*[c for c in df.columns if c.lower() in {r.lower() for r in results}])
    clash = [c for c in out.columns if c.lower() in taken]
    away = dict(zip(clash, free_names(out, *[f"{c}_" for c in clash]), strict=True))
    return out.withColumnsRenamed(away), {v: k for k, v in away.items()}


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salted_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Join rows to lookup, which has one row for each key, so that a key with a third of all rows is spread over `salts` tasks.

    lookup is repeated once for each salt; it holds a row for a key, not for a document, so the copies stay small.
    """
    (salt,) = free_names(rows.select("*", *[F.lit(0).alias(c) for c in lookup.columns if c not in rows.columns]), "_salt")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys]), F.lit(salts)).cast("int"))
    spread = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, [*keys, salt], how).drop(salt)


def smallest_hashes(df: DataFrame, order: str, total: int, rows: int) -> DataFrame:
    """About the `rows` rows of df, which has `total`, with the smallest hashes in the column order.

    A cut on the hash comes first, so that no task passes on more than its share of them.
    """
    share = min(1.0, 1.25 * rows / max(total, 1))
    return df if share == 1.0 else df.where(F.col(order) < F.lit(int(-(2**63) + share * 2**64)))


# ---------------------------------------------------------------------------------------------
# Word hashing, inside tasks


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over all 64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """64 bits for each word: two checksums with different starts, mixed."""
    n = len(words)
    low = np.fromiter(map(zlib.crc32, words), np.uint64, n)
    high = np.fromiter(map(zlib.adler32, words), np.uint64, n)
    return mix64(low | (high << np.uint64(32)))


_POWERS: dict[int, np.ndarray] = {}


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k words, mixed; empty when there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    if k not in _POWERS:
        _POWERS[k] = np.array([pow(base, k - 1 - j, 1 << 64) for j in range(k)], np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n] * _POWERS[k][0]
        for j in range(1, k):
            out += words[j : n + j] * _POWERS[k][j]
    return mix64(out)
