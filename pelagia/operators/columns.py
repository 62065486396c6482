"""Operators along a water column: filling from above, layer bounds, vertical interpolation and depth bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fill_top(cells: DataFrame, column: Sequence[str], level: str = "iz") -> DataFrame:
    """Missing levels above a column's first valid one take its value; gaps below stay.  filled_top marks them.

    Data without levels (a null level) are left alone.
    """
    w = W.partitionBy(*column).orderBy(level)
    above = F.count("value").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)) == 0
    first = F.first("value", ignorenulls=True).over(w.rowsBetween(W.currentRow, W.unboundedFollowing))
    mark = above & first.isNotNull() & F.col(level).isNotNull()
    return cells.withColumns({"_first": first, "filled_top": mark}).withColumn("value", F.when(F.col("filled_top"), F.col("_first")).otherwise(F.col("value"))).drop("_first")


def replace_top(cells: DataFrame, column: Sequence[str], source_level: int = 4) -> DataFrame:
    """Every level above source_level takes that level's value, whatever it held."""
    source = F.max(F.when(F.col("iz") == source_level, F.col("value"))).over(W.partitionBy(*column))
    return cells.withColumn("value", F.when(F.col("iz") < source_level, source).otherwise(F.col("value")))


def layer_bounds(levels: DataFrame, axis: Sequence[str] = ("axis_id",)) -> DataFrame:
    """lower, upper and thickness of every level, from given bounds or else from the midpoints between centres.

    The first layer reaches as far up as down, but not above 0; the last as far down as up; a single level has
    [max(0, d / 2), d + max(d - top, 1)].  A layer without thickness is an error.
    """
    w = W.partitionBy(*axis).orderBy("iz")
    d = F.col("depth")
    before, after = F.lag("depth").over(w), F.lead("depth").over(w)
    up, down = (before + d) / 2, (d + after) / 2
    alone = F.greatest(F.lit(0.0), d / 2)
    low = F.when(before.isNull() & after.isNull(), alone).when(before.isNull(), F.greatest(F.lit(0.0), d - (down - d))).otherwise(up)
    high = F.when(before.isNull() & after.isNull(), d + F.greatest(d - alone, F.lit(1.0))).when(after.isNull(), d + (d - up)).otherwise(down)
    given = "lower" in levels.columns
    out = levels.withColumns({"_low": low, "_high": high})
    if given:
        both = F.col("lower").isNotNull() & F.col("upper").isNotNull()
        out = out.withColumns({"_source": F.when(both, "bounds").otherwise("midpoints"), "_low": F.when(both, F.least("lower", "upper")).otherwise(F.col("_low")), "_high": F.when(both, F.greatest("lower", "upper")).otherwise(F.col("_high"))})
    else:
        out = out.withColumn("_source", F.lit("midpoints"))
    thick = F.col("upper") - F.col("lower")
    checked = F.when(thick > 0, thick).otherwise(F.raise_error(F.lit("a layer has no thickness")).cast("double"))
    return out.drop("lower", "upper").withColumnsRenamed({"_low": "lower", "_high": "upper", "_source": "bounds_source"}).withColumn("thickness", checked)


def depth_bins(cells: DataFrame, layers: DataFrame, bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Thickness-weighted means over depth bins.

    layers: iz, depth, thickness (one axis, broadcast); bins: label, lower, upper.  A level belongs to the bin that holds its
    centre, with its whole thickness; bins without levels give no rows; a bin of one level is that level.
    """
    levels = layers.select("iz", F.col("depth").alias("centre"), "thickness")
    held = levels.join(F.broadcast(bins), (F.col("centre") >= F.col("lower")) & (F.col("centre") < F.col("upper")))
    there = F.when(F.col("value").isNotNull(), F.col("thickness"))
    grouped = cells.join(F.broadcast(held), "iz").groupBy(*keys, "label", "lower", "upper")
    out = grouped.agg((F.sum(F.col("value") * F.col("thickness")) / F.sum(there)).alias("value"), F.count_distinct("iz").alias("levels"))
    return out.withColumn("method", F.when(F.col("levels") == 1, "single_level").otherwise("thickness_weighted_mean"))


def vertical_weights(source: DataFrame, target: DataFrame, z_scale: Column | float = 1.0, axis: Sequence[str] = ()) -> DataFrame:
    """axis, iz_out, depth_out and up to two (iz, w): the source levels around each target depth.

    Depths outside the source's range get no row.  source: axis, iz, depth; target: iz, depth.  axis names columns that tell source axes
    apart, none where there is one; z_scale may depend on them.
    """
    w = W.partitionBy(*axis).orderBy("depth")  # a vertical axis is a handful of levels
    factor = F.lit(z_scale) if isinstance(z_scale, float) else z_scale
    # A factor leaves digits that a level at the very depth of a target doesn't have.
    s = source.select(*axis, "iz", F.when(factor == 1.0, F.col("depth")).otherwise(F.round(F.col("depth") * factor, 9)).alias("depth"))
    pair = s.select(*axis, F.col("iz").alias("iz0"), F.col("depth").alias("d0"), F.lead("iz").over(w).alias("iz1"), F.lead("depth").over(w).alias("d1"))
    t = target.select(F.col("iz").alias("iz_out"), F.col("depth").alias("depth_out"))
    inside = (F.col("depth_out") >= F.col("d0")) & ((F.col("depth_out") < F.col("d1")) | (F.col("d1").isNull() & (F.col("depth_out") == F.col("d0"))))
    hit = F.broadcast(t).join(pair, inside)
    part = F.when(F.col("d1").isNull(), 0.0).otherwise((F.col("depth_out") - F.col("d0")) / (F.col("d1") - F.col("d0")))
    both = F.array(F.struct(F.col("iz0").alias("iz"), (1 - part).alias("w")), F.struct(F.col("iz1").alias("iz"), part.alias("w")))
    return hit.select(*axis, "iz_out", "depth_out", F.inline(both)).where("w > 0")


def vertical_interp(cells: DataFrame, weights: DataFrame, keys: Sequence[str], axis: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation to the target depths.  With one neighbour missing the other is used if its weight is at least 0.5.

    cells carry the axis columns of their own axis where the weights have any.
    """
    there = F.col("value").isNotNull()
    grouped = cells.select(*keys, *[a for a in axis if a not in keys], "iz", "value").join(F.broadcast(weights), [*axis, "iz"]).groupBy(*keys, "iz_out", "depth_out")
    out = grouped.agg(F.sum(F.when(there, F.col("w") * F.col("value"))).alias("_sum"), F.sum(F.when(there, F.col("w"))).alias("_w"))
    return out.select(*keys, F.col("iz_out").alias("iz"), F.col("depth_out").alias("depth"), F.when(F.col("_w") >= 0.5, F.col("_sum") / F.col("_w")).alias("value"))


def axis_registry(cells: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The vertical axes that occur among datasets (keys): keys, axis_id; and axis_id, iz, depth of each axis once.

    An axis's id is a digest of its levels' numbers and depths, so datasets with the same levels share it.  Cells are reduced to a row for
    each level of each dataset first.  Two depths of one level are an error.
    """
    levels = cells.where("iz IS NOT NULL").groupBy(*keys, "iz").agg(F.min("depth").alias("depth"), F.max("depth").alias("_most"))
    depth = F.when(F.col("depth") < F.col("_most"), F.raise_error(F.lit("a level has two depths")).cast("double")).otherwise(F.col("depth"))
    axes = levels.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("iz", depth.alias("depth")))).alias("_levels"))
    axes = axes.withColumn("axis_id", F.sha2(F.to_json("_levels"), 256).substr(1, 16))
    return axes.select(*keys, "axis_id"), axes.groupBy("axis_id").agg(F.first("_levels").alias("_l")).select("axis_id", F.inline("_l"))


def axis_spacing(points: DataFrame, axis: Sequence[str], value: str, rtol: float = 1e-4, atol: float = 1e-8) -> DataFrame:
    """The median step of each axis and whether all its steps agree with it; fewer than two values are an error."""
    step = F.col(value) - F.lag(value).over(W.partitionBy(*axis).orderBy(value))
    steps = points.select(*axis, value).distinct().withColumn("_step", F.abs(step))
    out = steps.groupBy(*axis).agg(F.count("*").alias("size"), F.min(value).alias("first"), F.max(value).alias("last"), F.percentile("_step", F.lit(0.5)).alias("step"), F.max("_step").alias("_most"), F.min("_step").alias("_least"))
    near = lambda x: F.abs(F.col(x) - F.col("step")) <= atol + rtol * F.abs(F.col("step"))
    checked = F.when(F.col("size") >= 2, near("_most") & near("_least")).otherwise(F.raise_error(F.lit("an axis needs two values")).cast("boolean"))
    return out.withColumn("is_even", checked).drop("_most", "_least")
