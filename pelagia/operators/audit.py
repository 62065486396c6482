"""Audits of inputs and products: field statistics, baselines, unit and depth suggestions, statuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.functions.fields import normalize_units
from pelagia.schema import GLORYS, HINDCAST
from pelagia.staging import checkpointed


def first_step_stats(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """field_stats of the first step, without a sort of the cells: the step of each dataset is found first."""
    at = cells.groupBy(*keys).agg(F.min("time").alias("time"))
    return field_stats(cells.join(at, [*keys, "time"], "left_semi"), keys)


def field_stats(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("n"))


def field_mean(cells: DataFrame, keys: Sequence[str], slices: Sequence[str], half_step: float) -> DataFrame:
    """Area-weighted mean of each level and time, then the plain mean over those; area goes with the sines of a cell's edges."""
    area = F.sin(F.radians(F.least(F.col("lat") + half_step, F.lit(90.0)))) - F.sin(F.radians(F.greatest(F.col("lat") - half_step, F.lit(-90.0))))
    there = F.when(F.col("value").isNotNull(), area)
    levels = cells.groupBy(*keys, *slices).agg((F.sum(F.col("value") * area) / F.sum(there)).alias("_mean"))
    return levels.groupBy(*keys).agg(F.avg("_mean").alias("mean"), F.count("_mean").alias("slices"))


def level_stats(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.min("depth").alias("z_min"), F.max("depth").alias("z_max"), F.count_distinct("depth").alias("levels"))


def _axis(points: DataFrame, keys: Sequence[str], low: str, high: str, size: str, inc: str, rtol: float = 1e-4, atol: float = 1e-8) -> DataFrame:
    """keys, size, step and whether a column or row has several coordinates, of points: a row for each index of an axis.

    The step is the median one where all agree with it; an uneven axis and one of a single value have none.
    """
    own = points.select(*keys, F.col(low).alias("_v"), (F.col(low) < F.col(high)).alias("_bent")).groupBy(*keys, "_v").agg(F.bool_or("_bent").alias("_bent"))
    steps = own.withColumn("_step", F.col("_v") - F.lag("_v").over(W.partitionBy(*keys).orderBy("_v")))  # an axis is some thousands of values
    out = steps.groupBy(*keys).agg(F.count("*").alias(size), F.percentile("_step", F.lit(0.5)).alias("_mid"), F.min("_step").alias("_least"), F.max("_step").alias("_most"), F.bool_or("_bent").alias(f"_bent_{size}"))
    near = lambda c: F.abs(F.col(c) - F.col("_mid")) <= atol + rtol * F.abs("_mid")
    return out.withColumn(inc, F.when(near("_least") & near("_most"), F.round("_mid", 9))).drop("_mid", "_least", "_most")


def _grids(by_column: DataFrame, by_row: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, gridtype, sizes and steps, of the columns' and rows' extremes (_lon0, _lon1; _lat0, _lat1)."""
    both = _axis(by_column, keys, "_lon0", "_lon1", "xsize", "xinc").join(_axis(by_row, keys, "_lat0", "_lat1", "ysize", "yinc"), list(keys))
    bent = F.col("_bent_xsize") | F.col("_bent_ysize")
    sizes = by_column.groupBy(*keys).agg(F.count("*").alias("_nx")).join(by_row.groupBy(*keys).agg(F.count("*").alias("_ny")), list(keys))
    straight = lambda c: F.when(~bent, F.col(c))
    return both.join(sizes, list(keys)).select(*keys, F.when(bent, "curvilinear").otherwise("lonlat").alias("gridtype"), F.when(bent, F.col("_nx")).otherwise(F.col("xsize")).alias("xsize"), F.when(bent, F.col("_ny")).otherwise(F.col("ysize")).alias("ysize"), straight("xinc").alias("xinc"), straight("yinc").alias("yinc"))


def grid_summary(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Type, sizes and steps of the grid that each dataset's cells (iy, ix, lat, lon) lie on.

    A grid is curvilinear where a column has several longitudes or a row several latitudes; its sizes are those of its indices and it has
    no steps.  Nor has an uneven axis, or a single row or column.
    """
    by_column = cells.groupBy(*keys, "ix").agg(F.min("lon").alias("_lon0"), F.max("lon").alias("_lon1"))
    by_row = cells.groupBy(*keys, "iy").agg(F.min("lat").alias("_lat0"), F.max("lat").alias("_lat1"))
    return _grids(by_column, by_row, keys)


def product_facts(cells: DataFrame, keys: Sequence[str], half_step: float) -> DataFrame:
    """One row a dataset: grid, ranges, area mean, levels and count, of one scan of the cells (iz, time, iy, ix, depth, lat, lon, value).

    Each slice, row and column of a dataset is summed side by side (grouping sets); all else is told from those.
    """
    area = F.sin(F.radians(F.least(F.col("lat") + half_step, F.lit(90.0)))) - F.sin(F.radians(F.greatest(F.col("lat") - half_step, F.lit(-90.0))))
    cells = cells.select(*keys, "iz", "time", "iy", "ix", "depth", "lat", "lon", "value", area.alias("_area"))
    sets = [[F.col(c) for c in (*keys, *more)] for more in (("iz", "time"), ("iy",), ("ix",))]
    extremes = [f(c).alias(f"_{c}{n}") for c in ("depth", "lat", "lon", "value") for f, n in ((F.min, 0), (F.max, 1))]
    sums = [F.sum(F.col("value") * F.col("_area")).alias("_sum"), F.sum(F.when(F.col("value").isNotNull(), F.col("_area"))).alias("_held"), F.count("value").alias("_n")]
    kind = F.when((F.grouping("iy") == 0), "row").when(F.grouping("ix") == 0, "column").otherwise("slice").alias("_kind")
    parts = checkpointed(cells.groupingSets(sets, *[F.col(c) for c in (*keys, "iz", "time", "iy", "ix")]).agg(kind, *extremes, *sums))
    slices = parts.where("_kind = 'slice'").groupBy(*keys).agg(
        F.min("_value0").alias("min"), F.max("_value1").alias("max"), F.sum("_n").alias("n"), F.avg(F.col("_sum") / F.col("_held")).alias("mean"), F.count(F.col("_sum") / F.col("_held")).alias("slices"),
        F.min("_depth0").alias("z_min"), F.max("_depth1").alias("z_max"), F.count_distinct("_depth0").alias("levels"),
    )
    return slices.join(_grids(parts.where("_kind = 'column'"), parts.where("_kind = 'row'"), keys), list(keys))


def representative(files: DataFrame, keys: Sequence[str], path: str = "path") -> DataFrame:
    """The file of each group that stands for it: the first by path."""
    rest = [c for c in files.columns if c not in keys]
    return files.groupBy(*keys).agg(F.min_by(F.struct(*rest), path).alias("_file")).select(*keys, *[F.col(f"_file.{c}").alias(c) for c in rest])


def baseline_family(variable: Column) -> Column:
    return F.when(variable.isin(*GLORYS), "glorys").when(variable.isin(*HINDCAST), "hindcast").otherwise("none")


def expected_resolution(variable: Column, resolution: Column) -> Column:
    return F.concat_ws(":", baseline_family(variable), resolution).isin("glorys:0p05", "hindcast:0p05", "hindcast:0p25")


def baseline_lookup(products: DataFrame, baselines: DataFrame) -> DataFrame:
    """products with target_family, expected_resolution and the baseline's path, else the fallback's.

    baselines: family, variable, resolution, is_fallback, baseline_path (a row a file, broadcast by size).
    """
    named = products.withColumns({"target_family": baseline_family(F.col("variable")), "expected_resolution": expected_resolution(F.col("variable"), F.col("resolution"))})
    key = ["target_family", "variable", "resolution"]
    side = lambda flag, name: baselines.where(F.col("is_fallback") == flag).select(F.col("family").alias("target_family"), "variable", "resolution", F.col("baseline_path").alias(name))
    both = named.join(side(False, "_primary"), key, "left").join(side(True, "_fallback"), key, "left")
    return both.withColumn("baseline_path", F.coalesce("_primary", "_fallback")).withColumn("baseline_exists", F.col("baseline_path").isNotNull()).drop("_primary", "_fallback")


def grid_match(products: DataFrame, grids: DataFrame, key: Sequence[str]) -> DataFrame:
    """products with grid_matches_baseline: type, sizes and steps all equal, missing values included."""
    fields = ("gridtype", "xsize", "ysize", "xinc", "yinc")
    other = grids.select(*key, *[F.col(f).alias(f"baseline_{f}") for f in fields], F.lit(True).alias("_there"))
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"baseline_{f}"))
    return products.join(other, list(key), "left").withColumn("grid_matches_baseline", F.coalesce("_there", F.lit(False)) & same).drop("_there")


def product_status(expected: Column, baseline: Column, grid: Column, stats: Column) -> Column:
    return F.when(~expected, "unexpected_resolution").when(~baseline, "missing_baseline_for_comparison").when(~grid, "grid_mismatch").when(~stats, "stats_missing_or_review").otherwise("ok")


# Fixed values of the audits below: unit spellings, statuses, suggestions and the ranges they rest on, as reviewers expect them.


def z_scale(units: Column, z_max: Column) -> tuple[Column, Column]:
    """Suggested factor to metres ('' without levels) and why."""
    cm = normalize_units(units).isin("cm", "centimeter", "centimeters")
    big = z_max > 20000
    scale = F.when(cm | F.coalesce(big, F.lit(False)), "0.01").when(z_max.isNull(), "").otherwise("1")
    note = F.when(cm, "depth units are centimetres").when(big, "depths too large for metres").when(z_max.isNull(), "no levels").otherwise("depths look like metres")
    return scale, note


def _units(u: Column) -> Column:
    return F.coalesce(normalize_units(u), F.lit(""))


def variable_scale(variable: Column, source_units: Column, source_max: Column, baseline_units: Column, baseline_max: Column) -> Column:
    """Suggested factor from a source's units to its baseline's: a number, K_to_C, or review.

    Units of oxygen are compared as whole words, so equal ones never suggest a factor.
    """
    su, bu = _units(source_units), _units(baseline_units)
    differ = (su != "") & (bu != "") & (su != bu)
    has = lambda u, *words: F.lit(False) if not words else F.contains(u, F.lit(words[0])) | has(u, *words[1:])
    mol, mmol = ("molm-3", "mol/m3"), ("mmolm-3", "mmol/m3")
    salt = ("0.001", "1e-3")
    rules = [
        ("siconc", (source_max <= 1.5) & (baseline_max > 2), "100"),
        ("siconc", (source_max > 2) & (baseline_max <= 1.5), "0.01"),
        ("thetao", (source_max > 100) & (baseline_max < 100), "K_to_C"),
        ("uo", has(su, "cms-1", "cm/s", "cmsec-1"), "0.01"),
        ("vo", has(su, "cms-1", "cm/s", "cmsec-1"), "0.01"),
        ("o2", su.isin(*mol) & bu.isin(*mmol), "1000"),
        ("o2", su.isin(*mmol) & bu.isin(*mol), "0.001"),
        ("chl", has(su, "kgm-3") & has(bu, "mgm-3", "mg/m3") & ~has(bu, "kgm-3"), "1000000"),
        ("so", differ & ~(su.isin(*salt) & bu.isin(*salt)), "review"),
    ]
    named = ("siconc", "thetao", "uo", "vo", "o2", "chl", "so", "ph")
    out = F.when(~variable.isin(*named) & differ, "review")
    for name, condition, scale in rules:
        out = out.when((variable == name) & F.coalesce(condition, F.lit(False)), scale)
    return out.otherwise("1")


def add_stage(variable: Column, source_units: Column, source_max: Column, baseline_units: Column, baseline_max: Column, target: Column) -> dict[str, Column]:
    """Suggested anomaly scale, output bounds and status for adding a change to its baseline."""
    su, bu = _units(source_units), _units(baseline_units)
    part, whole = ("1", "fraction", "unitless"), ("%", "percent")
    ice = variable == "siconc"
    yes = lambda c: F.coalesce(c, F.lit(False))
    down = ice & ((bu.isin(*part) & su.isin(*whole)) | (~(bu.isin(*whole) & su.isin(*part)) & yes((source_max > 2) & (baseline_max <= 1.5))))
    up = ice & ~down & ((bu.isin(*whole) & su.isin(*part)) | yes((source_max <= 1.5) & (baseline_max > 2)))
    still = ice & ~down & ~up
    floor = variable.isin("mlotst", "so")
    advised = ((variable == "chl") & (target == "hindcast")) | (variable == "o2")
    scale = F.when(down, "0.01").when(up, "100").otherwise("1")
    bounds = F.when(down | (still & bu.isin(*part)), "0:1").when(up | (still & bu.isin(*whole)), "0:100").when(still, "review").when(floor | advised, "0:").otherwise("")
    status = F.when(down | up, "scale_and_bounds_required").when(still & bu.isin(*part, *whole), "bounds_required").when(still, "review_add_stage_scale").when(floor, "bounds_required").when(advised, "bounds_recommended").otherwise("ok")
    return {"suggested_anomaly_scale": scale, "suggested_output_bounds": bounds, "add_stage_status": status}


def input_status(target: Column, baseline_exists: Column, z: Column, scale: Column) -> Column:
    return F.when(target == "none", "delta_only").when(~baseline_exists, "missing_baseline").when(~z.isin("", "1"), "review_depth_units").when(~scale.isin("", "1"), "review_variable_units").otherwise("ok_or_review_metadata")


def unit_depth_audit(groups: DataFrame, baselines: DataFrame) -> DataFrame:
    """One row a group with its suggestions.

    groups: model, member, scenario, variable, source_units, z_units, z_min, z_max, source_min, source_max.
    baselines: variable, baseline_units, baseline_min, baseline_max.
    """
    rows = groups.join(baselines, "variable", "left").withColumn("baseline_target", baseline_family(F.col("variable")))
    c = F.col
    z, z_note = z_scale(c("z_units"), c("z_max"))
    scale = variable_scale(c("variable"), c("source_units"), c("source_max"), c("baseline_units"), c("baseline_max"))
    rows = rows.withColumns({"suggested_z_scale": z, "z_note": z_note, "suggested_var_scale": scale} | add_stage(c("variable"), c("source_units"), c("source_max"), c("baseline_units"), c("baseline_max"), c("baseline_target")))
    return rows.withColumn("status", input_status(c("baseline_target"), c("baseline_max").isNotNull(), c("suggested_z_scale"), c("suggested_var_scale")))
