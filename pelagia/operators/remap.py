"""Horizontal remapping through tables of weights.

A weights table has dst_iy, dst_ix, src_iy, src_ix, w; it is built once for each pair of grids and serves every field on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.staging import bucketed, checkpointed


@dataclass(frozen=True)
class Grid:
    """A regular longitude-latitude grid."""

    xsize: int
    ysize: int
    xfirst: float
    xinc: float
    yfirst: float
    yinc: float

    def cells(self, spark: SparkSession) -> DataFrame:
        """iy, ix, lat, lon of every cell."""
        y = spark.range(self.ysize).select(F.col("id").cast("int").alias("iy"))
        cells = y.withColumn("ix", F.explode(F.sequence(F.lit(0), F.lit(self.xsize - 1))))
        return cells.select("iy", "ix", (F.lit(self.yfirst) + F.col("iy") * self.yinc).alias("lat"), (F.lit(self.xfirst) + F.col("ix") * self.xinc).alias("lon"))

    @property
    def wraps(self) -> bool:
        return abs(self.xsize * self.xinc - 360) < 1e-6


def resolve_method(grids: DataFrame, gridtype: str = "gridtype") -> DataFrame:
    """grids with the remap method that its type calls for."""
    return grids.withColumn("method", F.when(F.lower(gridtype).isin("curvilinear", "unstructured"), "distance_weighted").otherwise("bilinear"))


def bilinear_weights(spark: SparkSession, source: Grid, target: DataFrame) -> DataFrame:
    """The four corners around each target cell (iy, ix, lat, lon) on a regular source grid, by index arithmetic.

    Longitudes wrap where the source goes round the globe; targets outside the source get no row.
    """
    fy = (F.col("lat") - source.yfirst) / source.yinc
    raw = (F.col("lon") - source.xfirst) / source.xinc
    fx = raw - F.floor(raw / source.xsize) * source.xsize if source.wraps else raw
    at = target.select(F.col("iy").alias("dst_iy"), F.col("ix").alias("dst_ix"), fy.alias("fy"), fx.alias("fx"))
    inside = F.col("fy").between(0, source.ysize - 1)
    if not source.wraps:
        inside = inside & F.col("fx").between(0, source.xsize - 1)
    at = at.where(inside).withColumns({"y0": F.floor("fy").cast("int"), "x0": F.floor("fx").cast("int")}).withColumns({"ty": F.col("fy") - F.col("y0"), "tx": F.col("fx") - F.col("x0")})

    def corner(dy: int, dx: int) -> Column:
        x = F.col("x0") + dx
        return F.struct((F.col("y0") + dy).alias("src_iy"), (F.pmod(x, F.lit(source.xsize)) if source.wraps else x).cast("int").alias("src_ix"), ((F.col("ty") if dy else 1 - F.col("ty")) * (F.col("tx") if dx else 1 - F.col("tx"))).alias("w"))

    return at.select("dst_iy", "dst_ix", F.inline(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)]))).where("w > 0")


def _point(lat: str, lon: str) -> list[Column]:
    """Coordinates on the unit sphere."""
    a, b = F.radians(lat), F.radians(lon)
    return [(F.cos(a) * F.cos(b)), (F.cos(a) * F.sin(b)), F.sin(a)]


_XYZ = ("x", "y", "z")
#: Boxes of one level are so many times as wide as those of the next.
_RATIO = 4


def _boxes(points: DataFrame, prefix: str, side: float) -> DataFrame:
    """<prefix>b?: the boxes that hold points, with what they span (<prefix>lo?, <prefix>hi?) and how many there are (<prefix>n)."""
    at = [F.floor(F.col(f"{prefix}{c}") / side).cast("int").alias(f"{prefix}b{c}") for c in _XYZ]
    spans = [f(f"{prefix}{c}").alias(f"{prefix}{n}{c}") for c in _XYZ for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return points.groupBy(*at).agg(*spans, F.count("*").alias(f"{prefix}n"))


def _wider(boxes: DataFrame, prefix: str) -> DataFrame:
    """The boxes of the level above."""
    at = [F.floor(F.col(f"{prefix}b{c}") / _RATIO).cast("int").alias(f"{prefix}b{c}") for c in _XYZ]
    spans = [f(f"{prefix}{n}{c}").alias(f"{prefix}{n}{c}") for c in _XYZ for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return boxes.groupBy(*at).agg(*spans, F.sum(f"{prefix}n").alias(f"{prefix}n"))


def _box_pairs(source: DataFrame, target: DataFrame, side: float, k: int) -> DataFrame:
    """tb?, sb?: for each box of targets the boxes of sources that may hold one of the k nearest of any of its targets.

    Levels go from boxes that span the sphere to those of the given side.  At each a box of targets has k sources within the smallest
    distance that so many sources' boxes lie within altogether (farthest corners); boxes whose nearest corners are farther are out,
    and so is all inside them.
    """
    levels = [(checkpointed(_boxes(source, "s", side)), checkpointed(_boxes(target, "t", side)))]
    width = side
    while width < 2:
        levels.append((_wider(levels[-1][0], "s"), _wider(levels[-1][1], "t")))
        width *= _RATIO
    pairs = None
    for s, t in reversed(levels):
        if pairs is None:  # at most eight boxes each
            met = t.withColumn("_all", F.lit(0)).join(s.withColumn("_all", F.lit(0)), "_all")
        else:
            up = lambda df, p: df.withColumns({f"_{p}{c}": F.floor(F.col(f"{p}b{c}") / _RATIO).cast("int") for c in _XYZ})
            wide = pairs.select(*[F.col(f"{p}b{c}").alias(f"_{p}{c}") for p in "ts" for c in _XYZ])
            met = up(t, "t").join(wide, [f"_t{c}" for c in _XYZ]).join(up(s, "s"), [f"_s{c}" for c in _XYZ])
        gap = [F.greatest(F.lit(0.0), F.col(f"slo{c}") - F.col(f"thi{c}"), F.col(f"tlo{c}") - F.col(f"shi{c}")) for c in _XYZ]
        reach = [F.greatest(F.col(f"shi{c}") - F.col(f"tlo{c}"), F.col(f"thi{c}") - F.col(f"slo{c}")) for c in _XYZ]
        met = met.withColumns({"_near": F.sqrt(sum((g * g for g in gap), F.lit(0.0))), "_far": F.sqrt(sum((r * r for r in reach), F.lit(0.0)))})
        box = W.partitionBy(*[f"tb{c}" for c in _XYZ])
        met = met.withColumn("_upto", F.sum("sn").over(box.orderBy("_far")))
        bound = F.coalesce(F.min(F.when(F.col("_upto") >= k, F.col("_far"))).over(box), F.max("_far").over(box))
        pairs = met.withColumn("_bound", bound).where(F.col("_near") <= F.col("_bound") + 1e-9).select(*[f"{p}b{c}" for p in "ts" for c in _XYZ])
    return pairs


def nearest_candidates(source: DataFrame, target: DataFrame, tile: float, k: int) -> DataFrame:
    """dst_iy, dst_ix, src_iy, src_ix, d: every target with the sources that may be among its k nearest, and their distances."""
    side = 2 * 3.141592653589793 / 360 * tile
    s = source.select(F.col("iy").alias("src_iy"), F.col("ix").alias("src_ix"), *[c.alias(f"s{n}") for n, c in zip(_XYZ, _point("lat", "lon"), strict=True)])
    t = target.select(F.col("iy").alias("dst_iy"), F.col("ix").alias("dst_ix"), *[c.alias(f"t{n}") for n, c in zip(_XYZ, _point("lat", "lon"), strict=True)])
    inside = lambda df, p: df.withColumns({f"{p}b{c}": F.floor(F.col(f"{p}{c}") / side).cast("int") for c in _XYZ})
    near = inside(t, "t").join(_box_pairs(s, t, side, k), [f"tb{c}" for c in _XYZ]).join(inside(s, "s"), [f"sb{c}" for c in _XYZ])
    d2 = sum(((F.col(f"t{n}") - F.col(f"s{n}")) * (F.col(f"t{n}") - F.col(f"s{n}")) for n in _XYZ), F.lit(0.0))
    return near.select("dst_iy", "dst_ix", "src_iy", "src_ix", F.sqrt(d2).alias("d"))


def distance_weights(source: DataFrame, target: DataFrame, tile: float, k: int = 4) -> DataFrame:
    """The k nearest source cells (iy, ix, lat, lon; any grid) of each target cell, weighted by 1 / distance on the sphere.

    Candidates come from boxes of `tile` degrees of the unit cube around the sphere, found coarse boxes first, so poles and the date
    line need no care, and a target in the middle of land or of a hole meets only the boxes around the hole that may be nearest.
    A few source steps are a good tile.  A source at the very place takes all the weight.
    """
    order = W.partitionBy("dst_iy", "dst_ix").orderBy(F.round("d", 12), "src_iy", "src_ix")
    best = nearest_candidates(source, target, tile, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    exact = F.min("d").over(W.partitionBy("dst_iy", "dst_ix")) < 1e-12
    weight = F.when(exact, F.when(F.col("rank") == 1, 1.0).otherwise(0.0)).otherwise(1 / F.col("d"))
    return best.withColumn("w", weight).where("w > 0").select("dst_iy", "dst_ix", "src_iy", "src_ix", "w")


def bucketed_weights(weights: DataFrame, buckets: int) -> DataFrame:
    """A weights table, written once in buckets of source cells: it meets every field written so (bucketed_field) where it lies."""
    return bucketed(weights, "weights", ["src_iy", "src_ix"], buckets)


def bucketed_field(cells: DataFrame, buckets: int) -> DataFrame:
    """Fields (any keys, iy, ix, value) in the buckets of bucketed_weights; apply_weights takes them as they are."""
    return bucketed(cells.withColumnsRenamed({"iy": "src_iy", "ix": "src_ix"}), "fields", ["src_iy", "src_ix"], buckets)


def apply_weights(cells: DataFrame, weights: DataFrame, keys: Sequence[str], policy: str) -> DataFrame:
    """Fields on the target grid: keys, iy, ix, value.

    all: missing where any corner with weight is missing (bilinear).  renormalise: missing sources are left out (distance).
    Tables of bucketed_weights and bucketed_field with as many buckets are joined without an exchange.
    """
    sources = cells if "src_iy" in cells.columns else cells.withColumnsRenamed({"iy": "src_iy", "ix": "src_ix"})
    sources = sources.select(*keys, "src_iy", "src_ix", "value")
    grouped = weights.join(sources, ["src_iy", "src_ix"]).groupBy(*keys, F.col("dst_iy").alias("iy"), F.col("dst_ix").alias("ix"))
    there = F.col("value").isNotNull()
    total, held = F.sum(F.when(there, F.col("w") * F.col("value"))), F.sum(F.when(there, F.col("w")))
    if policy == "all":
        return grouped.agg(F.when(F.abs(F.coalesce(held, F.lit(0.0)) - 1) < 1e-9, total).alias("value"))
    if policy == "renormalise":
        return grouped.agg((total / held).alias("value"))
    raise ValueError(f"no policy {policy}")


def raster_transform(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Origin and steps of the raster that each dataset's cells make: x ascending, y descending, the origin at the outer corner."""
    out = cells.groupBy(*keys).agg(F.count_distinct("lon").alias("width"), F.count_distinct("lat").alias("height"), F.min("lon").alias("_x0"), F.max("lon").alias("_x1"), F.min("lat").alias("_y0"), F.max("lat").alias("_y1"))
    x, y = (F.col("_x1") - F.col("_x0")) / F.nullif(F.col("width") - 1, F.lit(0)), (F.col("_y1") - F.col("_y0")) / F.nullif(F.col("height") - 1, F.lit(0))
    return out.select(*keys, "width", "height", x.alias("x_step"), (-y).alias("y_step"), (F.col("_x0") - x / 2).alias("x_origin"), (F.col("_y1") + y / 2).alias("y_origin"))


def raster_position(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """cells with row (0 at the largest latitude) and col (0 at the smallest longitude).

    Each dataset's own longitudes and latitudes are ranked, thousands at most, and joined back: no task holds a field.
    """
    col = F.dense_rank().over(W.partitionBy(*keys).orderBy("lon")) - 1
    row = F.dense_rank().over(W.partitionBy(*keys).orderBy(F.desc("lat"))) - 1
    cols = cells.select(*keys, "lon").distinct().withColumn("col", col)
    rows = cells.select(*keys, "lat").distinct().withColumn("row", row)
    return cells.join(cols, [*keys, "lon"]).join(rows, [*keys, "lat"]).select(*cells.columns, "row", "col")
