"""Delivery: export tables, integer encoding, product trees, splits by depth, staging and manifests."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.functions.fields import csv_safe, depth_token, encoded, encoded_dtype
from pelagia.staging import checkpointed


def export_table(cells: DataFrame, provenance: Sequence[str], depth: Column, name: str, drop_missing: bool = True) -> DataFrame:
    """provenance, x, y, depth and the value under its delivery name, as written to Parquet or CSV."""
    rows = cells.where("value IS NOT NULL") if drop_missing else cells
    return rows.select(*provenance, F.col("lon").alias("x"), F.col("lat").alias("y"), depth.alias("depth"), F.col("value").alias(name))


def write_export(table: DataFrame, path: str, provenance: Sequence[str], kind: str = "parquet", overwrite: bool = False) -> None:
    """One partition folder for each dataset; overwrite replaces only the partitions that table has.

    In CSV every text is quoted, quotes in one are doubled, and line breaks inside one become blanks.
    """
    if kind == "csv":
        table = table.withColumns({c: csv_safe(F.col(c)) for c, t in table.dtypes if t == "string" and c not in provenance})
    out = table.write.partitionBy(*provenance).mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "dynamic")
    out.option("header", True).option("quoteAll", True).option("escape", chr(34)).csv(path) if kind == "csv" else out.parquet(path)


def not_done(wanted: DataFrame, existing: DataFrame, keys: Sequence[str], overwrite: bool = False) -> DataFrame:
    """The datasets still to compute: all when overwriting, else those that don't exist yet."""
    return wanted if overwrite else wanted.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def encode_integer(cells: DataFrame, dataset: Sequence[str], scale: Column) -> DataFrame:
    """cells with stored_value, encoded_dtype and nodata: the type is chosen for each dataset by its encoded range."""
    coded = cells.withColumns({"scale_factor": scale, "_code": encoded(F.col("value"), scale)})
    kinds = coded.groupBy(*dataset).agg(encoded_dtype(F.min("_code"), F.max("_code")).alias("encoded_dtype"))
    nodata = F.when(F.col("encoded_dtype") == "int16", -32768).otherwise(-2147483648)
    out = coded.join(kinds, list(dataset)).withColumn("nodata", nodata)
    return out.withColumn("stored_value", F.coalesce(F.col("_code").cast("int"), F.col("nodata"))).drop("_code")


def decoded(stored: Column, nodata: Column, scale: Column) -> Column:
    return F.when(stored != nodata, stored / scale)


def encode_manifest(coded: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """One row for each encoded dataset: scale, type, nodata and the ranges before and after."""
    real, stored = F.col("value"), F.when(F.col("value").isNotNull(), F.col("stored_value"))
    return coded.groupBy(*dataset, "scale_factor", "encoded_dtype", "nodata").agg(F.lit(0).alias("offset"), F.min(real).alias("min_real"), F.max(real).alias("max_real"), F.min(stored).alias("min_encoded"), F.max(stored).alias("max_encoded"))


def numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """rows with their place by a column, from 1: ranges of it are numbered side by side, each from where the one before ends."""
    parts = checkpointed(rows.repartitionByRange(by).withColumn("_range", F.spark_partition_id()))  # the ranges must not be drawn twice
    counts = parts.groupBy("_range").agg(F.count("*").alias("_count"))
    ahead = counts.withColumn("_ahead", F.sum("_count").over(W.orderBy("_range")) - F.col("_count"))  # a row a range
    within = F.row_number().over(W.partitionBy("_range").orderBy(by))
    return parts.join(F.broadcast(ahead.drop("_count")), "_range").withColumn(name, (within + F.col("_ahead")).cast("int")).drop("_range", "_ahead")


def merge_manifests(old: DataFrame, new: DataFrame, key: Column, position: str = "pos") -> DataFrame:
    """The union of both with all columns of either; a key of both keeps its new row, in the place it had first."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True).withColumn("_key", key)
    w = W.partitionBy("_key")
    ranked = both.withColumns({"_rank": F.row_number().over(w.orderBy(F.desc("_new"), F.desc(position))), "_first": F.min(F.struct("_new", position)).over(w)})
    return numbered(ranked.where("_rank = 1"), "_first", "order").drop("_new", "_key", "_rank", "_first", position)


def preferred(sources: DataFrame, key: Sequence[str], rank: Column, order: Sequence[str]) -> DataFrame:
    """The first source of each key by rank, then order."""
    w = W.partitionBy(*key).orderBy(rank, *order)
    return sources.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def curate(future: DataFrame, legacy: DataFrame, baseline: DataFrame, filled: DataFrame) -> DataFrame:
    """The product tree as rows: kind, variable, model, realization, scenario, window, resolution, path.

    A legacy future product is used only where the new layout has none for its variable and window; a coastal-filled baseline
    goes before the original.
    """
    names = ["variable", "model", "realization", "scenario", "window", "resolution", "path"]
    old = legacy.join(future.select("variable", "window").distinct(), ["variable", "window"], "left_anti")
    ahead = future.select(*names).unionByName(old.select(*names)).withColumn("kind", F.lit("future"))
    base = filled.withColumn("_rank", F.lit(0)).unionByName(baseline.withColumn("_rank", F.lit(1)))
    base = preferred(base, ["variable", "resolution"], F.col("_rank"), ["path"]).drop("_rank").withColumn("kind", F.lit("baseline"))
    return ahead.unionByName(base, allowMissingColumns=True).withColumn("destination", F.concat_ws("/", "kind", F.when(F.col("kind") == "future", F.concat_ws("/", "model", "realization", "scenario")), "variable", "window", "resolution"))


def split_by_depth(cells: DataFrame, dataset: Sequence[str], max_depth: float | None = None) -> DataFrame:
    """cells with the token of the single-depth dataset they go to; 2-D cells have none; two levels with one token are an error."""
    kept = cells if max_depth is None else cells.where(F.col("depth").isNull() | (F.col("depth") <= max_depth))
    named = kept.withColumn("depth_token", depth_token(F.col("depth")))
    shared = named.groupBy(*dataset, "depth_token").agg(F.min("iz").alias("_a"), F.max("iz").alias("_b"))
    check = shared.withColumn("_ok", F.when(F.col("_a") < F.col("_b"), F.raise_error(F.lit("two levels have the same depth token")).cast("boolean")).otherwise(F.lit(True)))
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in (*dataset, "depth_token")]
    return named.alias("c").join(check.alias("t"), on).where("_ok").select("c.*")


def stage_first_realization(products: DataFrame, resolution: str) -> DataFrame:
    """The delivery view: one resolution; of each future product the first realization by name; staged paths and provenance."""
    key = ["product_type", "model", "scenario", "variable", "window", "resolution"]
    first = F.min("realization").over(W.partitionBy(*key))
    some = products.where(F.col("resolution") == resolution)
    ahead = some.where("kind = 'future'").withColumn("_first", first).where("realization = _first").drop("_first")
    ahead = ahead.withColumn("staged_relative_path", F.concat_ws("/", "product_type", F.lit("future"), "scenario", "variable", "window", "resolution", "file_name"))
    base = some.where("kind = 'baseline'").withColumn("staged_relative_path", F.concat_ws("/", "product_type", F.lit("baseline"), "variable", "resolution", "file_name"))
    return ahead.unionByName(base)


def raster_blocks(coded: DataFrame, dataset: Sequence[str], block: int = 256) -> DataFrame:
    """Integer rasters (dataset, row, col, stored_value, nodata) as blocks: dataset, block_row, block_col, nodata, height, width, values.

    values are block x block numbers row by row; places without a cell, and those past the raster's edge, hold nodata.  height and width
    are those of the whole raster, so the edge can be told.  A group is one block, at most block x block rows.
    """
    size = coded.groupBy(*dataset).agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))  # a row a raster
    at = lambda c: F.floor(F.col(c) / block).cast("int")
    place = F.pmod("row", F.lit(block)) * block + F.pmod("col", F.lit(block))
    cells = coded.select(*dataset, "nodata", at("row").alias("block_row"), at("col").alias("block_col"), place.cast("int").alias("_place"), "stored_value")
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    keys = [*dataset, "nodata", "block_row", "block_col"]
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "values array<int>"])

    def fill(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = np.full(block * block, key[len(dataset)], np.int32)
        values[group["_place"].to_numpy()] = group["stored_value"].to_numpy()
        return pd.DataFrame([[*key, values]], columns=[*keys, "values"])

    return cells.groupBy(*keys).applyInPandas(fill, schema).join(size, list(dataset)).select(*keys, "height", "width", "values")


def unblocked(blocks: DataFrame, dataset: Sequence[str], block: int = 256) -> DataFrame:
    """The cells of raster_blocks again, by arithmetic: dataset, row, col, stored_value; places that hold nodata have no row."""
    out = blocks.select(*dataset, "nodata", "height", "width", "block_row", "block_col", F.posexplode("values").alias("_place", "stored_value"))
    row, col = F.col("block_row") * block + F.floor(F.col("_place") / block), F.col("block_col") * block + F.pmod("_place", F.lit(block))
    out = out.withColumns({"row": row.cast("int"), "col": col.cast("int")})
    return out.where((F.col("stored_value") != F.col("nodata")) & (F.col("row") < F.col("height")) & (F.col("col") < F.col("width"))).select(*dataset, "row", "col", "stored_value")
