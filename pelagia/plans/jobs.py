"""The other composite jobs: monthly preparation, reference levels, delivery, discovery and audits, each a chain of operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.fields import depth_factor
from pelagia.operators import audit, climate, columns, manifest, products, remap
from pelagia.sources.store import Store
from pelagia.staging import checkpointed


def prepare_monthly(cells: DataFrame, keys: Sequence[str], weights: DataFrame | None = None, policy: str = "all") -> DataFrame:
    """Monthly fields of daily or monthly series (keys, time, iy, ix, value), on another grid where weights are given."""
    monthly = climate.as_monthly(cells.select(*keys, "time", "iy", "ix", "value"), keys)
    return monthly if weights is None else remap.apply_weights(monthly, weights, [*keys, "time"], policy)


def to_reference_levels(cells: DataFrame, source: DataFrame, target: DataFrame, keys: Sequence[str], z_scale: float = 1.0) -> DataFrame:
    """Fields on the levels of a reference axis.  source, target: iz, depth; z_scale turns the source's depths into the target's units."""
    return columns.vertical_interp(cells, columns.vertical_weights(source, target, z_scale), keys)


def all_to_reference_levels(cells: DataFrame, target: DataFrame, datasets: Sequence[str], keys: Sequence[str], units: DataFrame | None = None, target_units: str = "m") -> DataFrame:
    """Fields of datasets with axes of their own, all on the levels of a reference axis, in one job.

    Each axis that occurs is registered by its content and weighed once for each unit.  units: datasets, z_units, where not all are in
    target_units; a pair of units without a factor is an error.  keys: what to keep besides, iy and ix among them.
    """
    members, axes = columns.axis_registry(cells, datasets)
    if units is not None:
        members = members.join(units.select(*datasets, "z_units"), list(datasets), "left")
    else:
        members = members.withColumn("z_units", F.lit(target_units))
    members = checkpointed(members.withColumn("z_units", F.coalesce("z_units", F.lit("none"))))  # a row a dataset
    kinds = members.select("axis_id", "z_units").distinct().join(axes, "axis_id")
    weights = columns.vertical_weights(kinds, target, depth_factor(F.col("z_units"), F.lit(target_units)), ["axis_id", "z_units"])
    return columns.vertical_interp(cells.join(members, list(datasets)), weights, [*datasets, *keys], ["axis_id", "z_units"])


def discover(docs: DataFrame, windows: DataFrame, experiments: DataFrame, variables: DataFrame, prefer: Sequence[Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From archive documents to the files to fetch, their coverage checks and the summary by source.

    Flattened, first members flagged, one copy of each title (by prefer; an address of the preferred host first), checked against windows.
    """
    flat = manifest.flag_first_member(manifest.flatten_docs(docs))
    files = manifest.dedup_prefer(flat, ["title"], [manifest.url_preference(F.col("http_url")), *prefer])
    checks = manifest.coverage_checks(files, windows, experiments, variables)
    return files, checks, manifest.coverage_summary(checks)


def deliver(cells: DataFrame, layers: DataFrame, bins: DataFrame, dataset: Sequence[str], scale: Column) -> tuple[DataFrame, DataFrame]:
    """Depth bins of a product as integers, and the manifest of what was stored.  dataset: what an integer type is chosen for."""
    binned = columns.depth_bins(cells, layers, bins, [*[d for d in dataset if d != "label"], "iy", "ix"])
    coded = products.encode_integer(binned.withColumn("value", F.round("value", 6)), dataset, scale)
    return coded, products.encode_manifest(coded, dataset)


def deliver_tree(tree: DataFrame, cells: DataFrame, layers: DataFrame, bins: DataFrame, store: Store, resolution: str, scale: Column) -> DataFrame:
    """From a curated product tree to the staged delivery: chosen products, their depth bins as integers, stored, and the manifest.

    tree: what products.curate gives, with product_type and file_name.  cells: path, variable, iz, iy, ix, depth, value of every product's
    file.  store: keyed by staged_relative_path; products that its newest version has are left out, and all new ones are committed at once,
    so a run that dies or is repeated leaves one whole version.  The manifest has a row for each delivered product and bin.
    """
    staged = products.stage_first_realization(tree, resolution)
    wanted = checkpointed(store.missing(staged.select("staged_relative_path", "path", "kind", "variable")))  # a row a product
    own = cells.drop("variable").join(wanted, "path")
    dataset = ["staged_relative_path", "label"]
    binned = columns.depth_bins(own, layers, bins, ["staged_relative_path", "kind", "variable", "iy", "ix"]).withColumn("value", F.round("value", 6))
    coded = products.encode_integer(binned.withColumn("_scale", scale), dataset, F.col("_scale")).drop("_scale")
    if wanted.limit(1).count():
        store.commit(store.stage(coded))
    return products.encode_manifest(store.read(), ["staged_relative_path", "kind", "variable", "label"])


def audit_inputs(cells: DataFrame, files: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a group (keys, among them variable): its representative file, ranges of the source and its baseline, suggestions and status.

    files: keys, path, source_units, z_units.  base: variable, value and baseline_units of the baselines' cells.
    """
    stats = cells.groupBy(*keys).agg(F.min("value").alias("source_min"), F.max("value").alias("source_max"), F.min("depth").alias("z_min"), F.max("depth").alias("z_max"))
    baselines = base.groupBy("variable").agg(F.max("baseline_units").alias("baseline_units"), F.min("value").alias("baseline_min"), F.max("value").alias("baseline_max"))
    return audit.unit_depth_audit(audit.representative(files, keys).join(stats, list(keys), "left"), baselines)


def audit_products(product_cells: DataFrame, meta: DataFrame, baseline_cells: DataFrame, baselines: DataFrame, keys: Sequence[str], half_step: float) -> DataFrame:
    """One row a product: grid, ranges, area mean, levels, its baseline, whether the grids agree, and its status.

    meta: keys, variable, resolution.  baseline_cells: baseline_path, iy, ix, lat, lon.  baselines: as for audit.baseline_lookup.
    The products' cells are read once.
    """
    rows = meta.join(audit.product_facts(product_cells, keys, half_step), list(keys), "left")
    found = audit.baseline_lookup(rows, baselines)
    matched = audit.grid_match(found, audit.grid_summary(baseline_cells, ["baseline_path"]), ["baseline_path"])
    status = audit.product_status(F.col("expected_resolution"), F.col("baseline_exists"), F.col("grid_matches_baseline"), F.coalesce(F.col("n") > 0, F.lit(False)))
    return matched.withColumn("status", status)
