"""Stored tables and files: partitioned cells with pruning, file listings, CSV manifests with bad rows told apart, and safe commits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.schema import read_cells
from pelagia.staging import checkpointed

TILE = 64


# ------------------------------------------------------------------------------------- cells


def write_cells(cells: DataFrame, path: str, by: Sequence[str] = ("variable", "year"), mode: str = "errorifexists") -> None:
    """The cell table, a folder for each value of `by`; year comes from time where cells don't have it.

    Rows are dealt by folder and tile, each cell's neighbours together; what is larger than Spark's advisory size of a partition is shared
    out over several tasks, so that no task's memory grows with a folder or tile.  mode overwrite replaces only the folders that cells have.
    """
    if "year" in by and "year" not in cells.columns:
        cells = cells.withColumn("year", F.year("time"))
    tile = F.floor(F.col("iy") / TILE) * 1000 + F.floor(F.col("ix") / TILE)
    dealt = cells.withColumn("_tile", tile).hint("rebalance", *[F.col(c) for c in (*by, "_tile")]).sortWithinPartitions(*by, "iz", "iy", "ix").drop("_tile")
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def calendar(windows: DataFrame) -> DataFrame:
    """window, year: every year that a window (window, start, end) has a day in."""
    return windows.select("window", F.explode(F.sequence(F.year("start"), F.year("end"))).alias("year"))


def read_window_years(spark: SparkSession, path: str, variable: str, years: DataFrame) -> DataFrame:
    """The cells of a variable in the years of a small table (window, year), once for each window that has the year.

    The variable is a folder that is chosen before anything is read; a filter on years (`years.where("window = 'futB'")` of a stored
    table) chooses the year folders when the query runs.
    """
    return read_cells(spark, path, variable).join(years, "year")


# ------------------------------------------------------------------------------------- files


def list_files(spark: SparkSession, root: str, name_glob: str = "*", content: bool = False) -> DataFrame:
    """path (below root), name, length and modified of all files under root whose names match; their bytes are read only with content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob).load(root)
    below = F.regexp_replace(F.col("path"), r"^.*?\Q" + root.split(":", 1)[-1].lstrip("/").rstrip("/") + r"\E/*", "")
    return files.select(below.alias("path"), F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"), *(["content"] if content else []))


def month_steps(files: DataFrame, keys: Sequence[str], step: str = "auto") -> DataFrame:
    """keys, month, n_files, source_step: a month with one file holds monthly values, one with more daily ones.

    files: keys (from the path), year and month as numbers, a row a file.  step daily or monthly overrides what the files say; more
    than one file in a month that is said to be monthly is an error, for only one of them would be read.
    """
    if step not in ("auto", "daily", "monthly"):
        raise ValueError(f"no step {step}")
    months = files.groupBy(*keys, F.make_date("year", "month", F.lit(1)).alias("month")).agg(F.count("*").alias("n_files"))
    kind = F.when(F.col("n_files") == 1, "monthly").otherwise("daily") if step == "auto" else F.lit(step)
    if step == "monthly":
        kind = F.when(F.col("n_files") > 1, F.raise_error(F.lit("a month said to be monthly has several files")).cast("string")).otherwise(kind)
    return months.withColumn("source_step", kind)


# ------------------------------------------------------------------------------------- manifests


def read_manifest(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV manifest under a schema, and the rows that don't fit it (bad_row).

    Quoted values may hold line breaks, separators and doubled quotes.  Rows with too few or too many values, or with values of another
    type, are reported whole and are no rows of the manifest.
    """
    read = spark.read.schema(f"{schema}, _bad string").option("header", header).option("multiLine", True).option("quote", '"').option("escape", '"')
    rows = checkpointed(read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").csv(path))  # parsed once, all columns
    return rows.where("_bad IS NULL").drop("_bad"), rows.where("_bad IS NOT NULL").select(F.col("_bad").alias("bad_row"))


# ------------------------------------------------------------------------------------- commits


class Store:
    """Datasets (told by keys, none of them null) under one folder, with a manifest for each version of the whole.

    Parts are written first, under names that nothing refers to; a commit writes the manifest of the next version beside the others and
    renames it into its place.  Readers see the newest whole version.  A run that dies before its commit leaves only parts that no
    manifest names; one that dies in the middle of it, a manifest that has no version yet.  Two runs that commit the same version: the
    second fails, and what it staged can be committed again.  The folder's file system must rename whole folders at once.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)

    def _at(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at, system = self._at(f"{self.root}/versions")
        names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """keys, part, rows: a row for each dataset of a version, the newest by default; None before the first."""
        known = self.versions()
        if not known:
            return None
        return self.spark.read.parquet(f"{self.root}/versions/v{known[-1] if version is None else version:06d}")

    def missing(self, wanted: DataFrame, overwrite: bool = False) -> DataFrame:
        """Of the datasets wanted (keys) those that the newest version lacks; all with overwrite."""
        held = self.manifest()
        return wanted if overwrite or held is None else wanted.join(held.select(*self.keys), self.keys, "left_anti")

    def stage(self, rows: DataFrame) -> str:
        """Write datasets under a new name; nobody sees them before the commit."""
        part = uuid.uuid4().hex
        self.spark.createDataFrame([(rows.schema.json(),)], "value string").coalesce(1).write.text(f"{self.root}/schemas/{part}")
        rows.write.partitionBy(*self.keys).parquet(f"{self.root}/parts/{part}")
        return part

    def _part(self, part: str) -> DataFrame:
        """A part with the keys as the table has them: folder names would turn texts of digits into numbers."""
        schema = self.spark.read.text(f"{self.root}/schemas/{part}").first()[0]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.root}/parts/{part}")

    def commit(self, *parts: str) -> int:
        """A new version, in which the datasets of these parts replace those of the same keys.  The new version's number."""
        held, number = self.manifest(), (self.versions() or [0])[-1] + 1
        new = [self._part(p).groupBy(*self.keys).agg(F.count("*").alias("rows")).withColumn("part", F.lit(p)) for p in parts]
        rows = new[0]
        for n in new[1:]:  # of two parts with the same dataset the later counts
            rows = rows.join(n.select(*self.keys), self.keys, "left_anti").unionByName(n)
        rows = rows.select(*self.keys, "part", "rows")
        if held is not None:
            rows = held.join(rows.select(*self.keys), self.keys, "left_anti").unionByName(rows)
        temporary, _ = self._at(f"{self.root}/versions/.{uuid.uuid4().hex}")
        rows.coalesce(1).write.parquet(temporary.toString())  # a row a dataset
        final, system = self._at(f"{self.root}/versions/v{number:06d}")
        if system.exists(final) or not system.rename(temporary, final):
            system.delete(temporary, True)
            raise RuntimeError(f"version {number} was committed by another run")
        return number

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame | None:
        """The rows of a version; where chooses datasets by their keys before anything is read."""
        held = self.manifest(version)
        if held is None:
            return None
        held = held if where is None else held.where(where)
        out = None
        for part in sorted(r["part"] for r in held.select("part").distinct().collect()):  # one a commit
            own = self._part(part).join(F.broadcast(held.where(F.col("part") == part).select(*self.keys)), self.keys, "left_semi")
            out = own if out is None else out.unionByName(own)
        return out

    def sweep(self) -> int:
        """Delete the parts and unfinished manifests that no version names; call it when no run is under way.  How many went."""
        named = {r["part"] for v in self.versions() for r in self.manifest(v).select("part").distinct().collect()}
        gone = 0
        for folder, kept in (("parts", lambda n: n in named), ("schemas", lambda n: n in named), ("versions", lambda n: not n.startswith("."))):
            at, system = self._at(f"{self.root}/{folder}")
            for s in system.listStatus(at) if system.exists(at) else []:
                if not kept(s.getPath().getName()):
                    system.delete(s.getPath(), True)
                    gone += 1
        return gone
