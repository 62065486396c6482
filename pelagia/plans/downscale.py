"""The composite jobs: from series to downscaled products, as one chain of operators each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.operators.climate import apply_delta, clamp
from pelagia.operators.columns import fill_top
from pelagia.operators.fill import SQUARE, apply_fill, coastal_fill_by_tiles, fill_fallback, fill_weights, force_complete, gap_patterns, nearest_any_donor, wet_mask
from pelagia.operators.remap import apply_weights
from pelagia.staging import checkpointed


def downscale(
    base: DataFrame,
    anomaly: DataFrame,
    *,
    members: Sequence[str] = (),
    mask: DataFrame | None = None,
    mode: str | Column = "additive",
    scale: Column | float = 1.0,
    bounds: dict[str, tuple[float | None, float | None]] | None = None,
    method: str = "distance_weighted",
    max_steps: int = 12,
    power: float = 2.0,
    min_donors: int = 4,
    fill_baseline: bool = False,
    complete: bool = False,
    fallback: float | None = None,
    weights: DataFrame | None = None,
    policy: str = "all",
    out_weights: DataFrame | None = None,
) -> DataFrame:
    """The downscaled product of every member: remap, wet mask, baseline fill, anomaly fill, top fill, completion, fallback, scale,
    apply, top fill, clamp, remap out; in just this order.

    base: variable, iz, iy, ix, depth, lat, lon, value.  anomaly: members, variable, iz, iy, ix, value.  The baseline's cells are the
    product's cells, for each member; anomaly_value and fill_kind are kept for review.
    """
    cell = ["variable", "iz", *SQUARE]
    if weights is not None:
        anomaly = apply_weights(anomaly, weights, [*members, "variable", "iz"], policy)
    wet = wet_mask(base, mask)
    if fill_baseline:
        wet = coastal_fill_by_tiles(checkpointed(wet), ["variable", "iz"], method, max_steps, power, min_donors).drop("filled").withColumn("wet", F.col("wet") | F.col("value").isNotNull())
    every = wet.crossJoin(F.broadcast(anomaly.select(*members).distinct())) if members else wet  # a row a member, not a cell
    key = [*members, *cell]
    domain = checkpointed(every.select(*key, "wet").join(anomaly.select(*key, "value"), key, "left"))  # each round of the fill reads it
    filled = coastal_fill_by_tiles(domain, [*members, "variable", "iz"], method, max_steps, power, min_donors)
    reviewed = _reviewed(filled, members, complete, fallback)
    out = apply_delta(every, reviewed, key, mode, scale)
    return _finished(out, reviewed, members, bounds, out_weights, policy)


def _reviewed(filled: DataFrame, members: Sequence[str], complete: bool, fallback: float | None) -> DataFrame:
    """The filled anomaly after top fill, completion and fallback, staged: it is applied, and kept for review."""
    key = [*members, "variable", "iz", *SQUARE]
    filled = fill_top(filled, [*members, "variable", *SQUARE])
    kind = F.when(F.col("filled"), "filled").when(F.col("filled_top"), "top")
    if complete:
        filled = force_complete(filled.withColumn("_kind", kind), [*members, "variable", "iz"], checkpointed)
        kind = F.when(F.col("_kind").isNotNull(), F.col("_kind")).when(F.col("forced"), "forced")
    if fallback is not None:
        filled = fill_fallback(filled.withColumn("_kind2", kind), fallback)
        kind = F.when(F.col("fallback"), "fallback").otherwise(F.col("_kind2"))
    return checkpointed(filled.withColumn("fill_kind", kind).select(*key, "value", "fill_kind"))


def _finished(out: DataFrame, reviewed: DataFrame, members: Sequence[str], bounds: dict | None, out_weights: DataFrame | None, policy: str) -> DataFrame:
    """The applied field after top fill and clamp, beside its anomaly, on another grid where weights are given."""
    out = clamp(fill_top(out, [*members, "variable", *SQUARE]), bounds or {})
    out = out.join(reviewed.select(*members, "variable", "iz", *SQUARE, F.col("value").alias("anomaly_value"), "fill_kind"), [*members, "variable", "iz", *SQUARE])
    return out if out_weights is None else apply_weights(out, out_weights, [*members, "variable", "iz"], policy)


def ensemble_domain(wet: DataFrame, anomaly: DataFrame, members: Sequence[str], max_members: int = 10_000) -> DataFrame:
    """Every cell of wet (variable, iz, iy, ix, ...) for every member, with the member's anomaly or none.

    The members' values meet once at their cell, as a map from the member's number; the baseline's cells are dealt out once, not once
    a member, and no cell is lost that a member lacks.  More than max_members members are an error: their numbers travel with each cell.
    """
    cell = ["variable", "iz", *SQUARE]
    roster = anomaly.select(*members).distinct().orderBy(*members).limit(max_members + 1).collect()
    if len(roster) > max_members:
        raise ValueError(f"more than {max_members} members")
    schema = ", ".join(f"`{m}` {anomaly.schema[m].dataType.simpleString()}" for m in members)
    numbered = anomaly.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(roster)], f"{schema}, _member int")
    known = F.broadcast(numbered)
    values = anomaly.join(known, list(members)).groupBy(*cell).agg(F.map_from_entries(F.collect_list(F.struct("_member", "value"))).alias("_values"))
    met = wet.drop("value").join(values, cell, "left").withColumn("_member", F.explode(F.sequence(F.lit(0), F.lit(len(roster) - 1)) if roster else F.array().cast("array<int>")))
    return met.withColumn("value", F.try_element_at("_values", F.col("_member"))).drop("_values").join(known, "_member").drop("_member")


def ensemble_downscale(
    base: DataFrame,
    anomaly: DataFrame,
    members: Sequence[str],
    *,
    mask: DataFrame | None = None,
    mode: str | Column = "additive",
    scale: Column | float = 1.0,
    bounds: dict[str, tuple[float | None, float | None]] | None = None,
    method: str = "distance_weighted",
    max_steps: int = 12,
    power: float = 2.0,
    min_donors: int = 4,
    fill_baseline: bool = False,
    complete: bool = False,
    fallback: float | None = None,
    weights: DataFrame | None = None,
    policy: str = "all",
    out_weights: DataFrame | None = None,
) -> DataFrame:
    """downscale() of all members and windows of an ensemble (members: the columns that tell its fields apart) in one job.

    The baseline is prepared once.  Donors are searched once for each pattern of gaps that occurs, however many fields share it, and
    applied to all fields as one sparse product; the rest is as in downscale().
    """
    cell = ["variable", "iz", *SQUARE]
    if weights is not None:
        anomaly = apply_weights(anomaly, weights, [*members, "variable", "iz"], policy)
    wet = wet_mask(base, mask)
    if fill_baseline:
        wet = coastal_fill_by_tiles(checkpointed(wet), ["variable", "iz"], method, max_steps, power, min_donors).drop("filled").withColumn("wet", F.col("wet") | F.col("value").isNotNull())
    wet = checkpointed(wet)  # the domain and the application read it
    domain = checkpointed(ensemble_domain(wet.select(*cell, "wet", "value"), anomaly.select(*members, *cell, "value"), members))
    patterns = checkpointed(gap_patterns(domain, members, ["variable", "iz"]))  # a row a field and level
    pattern_keys = ["variable", "iz", "pattern"]
    shown = patterns.groupBy(*pattern_keys).agg(F.min(F.struct(*members)).alias("_one")).select(*pattern_keys, "_one.*")
    solved = fill_weights(domain.join(shown, [*members, "variable", "iz"]), pattern_keys, method, max_steps, power, min_donors)
    filled = apply_fill(domain.join(patterns, [*members, "variable", "iz"]), solved, members, pattern_keys).drop("pattern")
    reviewed = _reviewed(filled, members, complete, fallback)
    every = wet.join(reviewed.select(*members, *cell), cell)
    out = apply_delta(every, reviewed, [*members, *cell], mode, scale)
    return _finished(out, reviewed, members, bounds, out_weights, policy)


def coast_baseline(base: DataFrame, mask: DataFrame, *, weights: DataFrame | None = None, policy: str = "all", **fill) -> DataFrame:
    """A baseline that covers a mask's coast: remap, gap fill, propagation, then the nearest finite cell for what is left."""
    cells = base if weights is None else apply_weights(base, weights, ["variable", "iz"], policy)
    wet = checkpointed(wet_mask(cells, mask))  # pending cells, donors, both rounds and the result read it
    out = coastal_fill_by_tiles(wet, ["variable", "iz"], **fill)
    out = force_complete(out, ["variable", "iz"], checkpointed)
    return nearest_any_donor(out, ["variable", "iz"])
