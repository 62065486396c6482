"""Filling gaps inside a wet mask."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.staging import checkpointed, staged_path

SQUARE = ["iy", "ix"]


def mask_any_depth(mask: DataFrame, keys: Sequence[str] = tuple(SQUARE), strict: bool = False) -> DataFrame:
    """A mask with more dimensions than keys, collapsed: wet where any of it is.  strict: several values at a key are an error."""
    out = mask.groupBy(*keys).agg(F.bool_or(F.col("value").isNotNull()).alias("wet"), F.count("*").alias("_n"))
    return out.withColumn("wet", F.when(F.col("_n") > 1, F.raise_error(F.lit("the mask has more dimensions than the data")).cast("boolean")).otherwise(F.col("wet"))).drop("_n") if strict else out.drop("_n")


def wet_mask(base: DataFrame, mask: DataFrame | None, on: Sequence[str] = tuple(SQUARE)) -> DataFrame:
    """base with wet: finite in the baseline, or in the external mask, which is broadcast over the dimensions it lacks."""
    own = F.col("value").isNotNull()
    if mask is None:
        return base.withColumn("wet", own)
    flags = mask_any_depth(mask, on).withColumnRenamed("wet", "_wet")
    return base.join(flags, list(on), "left").withColumn("wet", own | F.coalesce("_wet", F.lit(False))).drop("_wet")


def offsets(spark: SparkSession, steps: int, power: float) -> DataFrame:
    """dy, dx, rad (Chebyshev), d2 and w = distance^-power of the square of neighbours: a table fixed by steps."""
    side = spark.range(-steps, steps + 1)
    out = side.select(F.col("id").cast("int").alias("dy")).crossJoin(side.select(F.col("id").cast("int").alias("dx"))).where("dy <> 0 OR dx <> 0")
    d2 = F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")
    return out.select("dy", "dx", F.greatest(F.abs("dy"), F.abs("dx")).alias("rad"), d2.alias("d2"), F.pow(F.sqrt(d2.cast("double")), F.lit(-float(power))).alias("w"))


def _donors(pending: DataFrame, donors: DataFrame, slice_keys: Sequence[str], table: DataFrame) -> DataFrame:
    """A row for each pending cell and donor in reach: the pending side is spread over the offsets, then meets donors by key."""
    spread = pending.select(*slice_keys, *SQUARE).crossJoin(F.broadcast(table))
    moved = spread.withColumns({"_y": F.col("iy") + F.col("dy"), "_x": F.col("ix") + F.col("dx")})
    there = donors.select(*slice_keys, F.col("iy").alias("_y"), F.col("ix").alias("_x"), F.col("value").alias("donor"))
    return moved.join(there, [*slice_keys, "_y", "_x"])


def _nearest(pending: DataFrame, donors: DataFrame, slice_keys: Sequence[str], table: DataFrame) -> DataFrame:
    order = F.struct("rad", "d2", "dy", "dx")
    return _donors(pending, donors, slice_keys, table).groupBy(*slice_keys, *SQUARE).agg(F.min_by("donor", order).alias("fill"))


def _weighted(pending: DataFrame, donors: DataFrame, slice_keys: Sequence[str], table: DataFrame, least: int) -> DataFrame:
    """fill, and whether it rests on `least` donors: all donors up to the smallest radius that has so many, else that has any."""
    rings = _donors(pending, donors, slice_keys, table).groupBy(*slice_keys, *SQUARE, "rad").agg(F.count("*").alias("n"), F.sum(F.col("w") * F.col("donor")).alias("wv"), F.sum("w").alias("w"))
    upto = W.partitionBy(*slice_keys, *SQUARE).orderBy("rad")
    grown = rings.select(*slice_keys, *SQUARE, "rad", *[F.sum(c).over(upto).alias(c) for c in ("n", "wv", "w")])
    enough = F.col("n") >= least
    return grown.groupBy(*slice_keys, *SQUARE).agg(F.coalesce(F.min_by(F.col("wv") / F.col("w"), F.when(enough, F.col("rad"))), F.min_by(F.col("wv") / F.col("w"), "rad")).alias("fill"), F.bool_or(enough).alias("enough"))


def coastal_fill(cells: DataFrame, slice_keys: Sequence[str], method: str = "distance_weighted", max_steps: int = 12, power: float = 2.0, min_donors: int = 4, first_steps: int = 3) -> DataFrame:
    """Wet cells without a value take one from wet cells that had one originally, at most max_steps away (no wrap at the edges).

    cells: slice_keys, iy, ix, value, wet.  nearest: the first donor by (Chebyshev radius, distance, dy, dx).
    distance_weighted: the mean, by distance^-power, of all donors up to the smallest radius with min_donors of them, or with any.
    filled marks the cells that were given a value.  Most cells find their donors within first_steps; only the others search on.
    """
    spark = cells.sparkSession
    pending = cells.where("wet AND value IS NULL")
    donors = cells.where("wet AND value IS NOT NULL")
    key = [*slice_keys, *SQUARE]
    near = offsets(spark, min(first_steps, max_steps), power)
    far = offsets(spark, max_steps, power)
    if method == "nearest":
        done = _nearest(pending, donors, slice_keys, near)
        found = done if first_steps >= max_steps else done.unionByName(_nearest(pending.join(done, key, "left_anti"), donors, slice_keys, far.where(F.col("rad") > first_steps)))
    elif method == "distance_weighted":
        done = _weighted(pending, donors, slice_keys, near, min_donors)
        if first_steps < max_steps:
            sure = done.where("enough")
            done = sure.unionByName(_weighted(pending.join(sure, key, "left_anti"), donors, slice_keys, far, min_donors))
        found = done.drop("enough")
    else:
        raise ValueError(f"no fill method {method}")
    both = cells.join(found, key, "left")
    mark = F.col("wet") & F.col("value").isNull() & F.col("fill").isNotNull()
    return both.withColumn("filled", mark).withColumn("value", F.when(F.col("filled"), F.col("fill")).otherwise(F.col("value"))).drop("fill")


def _rings(steps: int, power: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each radius the offsets of its ring, nearest first, then by dy and dx, and their weights."""
    out = []
    for r in range(1, steps + 1):
        ring = sorted((dy * dy + dx * dx, dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1) if max(abs(dy), abs(dx)) == r)
        d2, dy, dx = np.array(ring).T
        out.append((dy, dx, np.sqrt(d2.astype(float)) ** -power))
    return out


def _filled_tile(grid: np.ndarray, y: np.ndarray, x: np.ndarray, rings: list, method: str, least: int) -> np.ndarray:
    """The fill of the places (y, x) of a grid of values (NaN: none), ring by ring; only those without enough donors go on."""
    fill, first = np.full(len(y), np.nan), np.full(len(y), np.nan)
    n, wv, w = np.zeros(len(y), np.int64), np.zeros(len(y)), np.zeros(len(y))
    left = np.arange(len(y))
    for dy, dx, weight in rings:
        near = grid[y[left, None] + dy, x[left, None] + dx]
        there = ~np.isnan(near)
        if method == "nearest":
            held = there.any(1)
            fill[left[held]] = near[held, there[held].argmax(1)]
            left = left[~held]
        else:
            n[left] += there.sum(1)
            wv[left] += np.where(there, near, 0.0) @ weight
            w[left] += there @ weight
            new = left[np.isnan(first[left]) & (n[left] > 0)]
            first[new] = wv[new] / w[new]
            enough = n[left] >= least
            fill[left[enough]] = wv[left[enough]] / w[left[enough]]
            left = left[~enough]
        if not len(left):
            break
    return fill if method == "nearest" else np.where(np.isnan(fill), first, fill)


def coastal_fill_by_tiles(cells: DataFrame, slice_keys: Sequence[str], method: str = "distance_weighted", max_steps: int = 12, power: float = 2.0, min_donors: int = 4, tile: int = 64) -> DataFrame:
    """What coastal_fill gives, tile by tile: a tile with gaps meets the wet cells up to max_steps around it, and sums rings in arrays.

    A cell travels to its own tile and to those it is near to, (1 + 2 * max_steps / tile)^2 rows at most for a cell, where the search by
    offsets deals (2 * max_steps + 1)^2 rows for each gap.  Tiles without gaps stay where they are.  cells are read twice: stage them.
    """
    if method not in ("nearest", "distance_weighted"):
        raise ValueError(f"no fill method {method}")
    key, rings = [*slice_keys, *SQUARE], _rings(max_steps, power)
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in key), "fill double"])
    at = lambda c, d=0: F.floor((F.col(c) + d) / tile).cast("int")
    here = cells.where("wet").select(*key, "value")
    gaps = here.where("value IS NULL").select(*slice_keys, at("iy").alias("_v"), at("ix").alias("_u")).distinct()
    spread = here.withColumn("_v", F.explode(F.sequence(at("iy", -max_steps), at("iy", max_steps)))).withColumn("_u", F.explode(F.sequence(at("ix", -max_steps), at("ix", max_steps))))
    near = spread.join(gaps, [*slice_keys, "_v", "_u"], "left_semi")
    side, names = tile + 2 * max_steps, list(slice_keys)

    def run(group_key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        y = group["iy"].to_numpy() - group_key[-2] * tile + max_steps
        x = group["ix"].to_numpy() - group_key[-1] * tile + max_steps
        grid = np.full((side, side), np.nan)
        grid[y, x] = value = group["value"].to_numpy(np.float64, na_value=np.nan)
        own = np.isnan(value) & (y >= max_steps) & (y < side - max_steps) & (x >= max_steps) & (x < side - max_steps)
        out = group.loc[own, [*names, *SQUARE]].copy()
        out["fill"] = _filled_tile(grid, y[own], x[own], rings, method, min_donors)
        return out[out["fill"].notna()]

    found = near.groupBy(*slice_keys, "_v", "_u").applyInPandas(run, schema)
    both = cells.join(found, key, "left")
    mark = F.col("wet") & F.col("value").isNull() & F.col("fill").isNotNull()
    return both.withColumn("filled", mark).withColumn("value", F.when(F.col("filled"), F.col("fill")).otherwise(F.col("value"))).drop("fill")


def gap_patterns(cells: DataFrame, members: Sequence[str], slice_keys: Sequence[str]) -> DataFrame:
    """members, slice_keys, pattern: slices with the same finite wet cells have the same pattern, whoever's they are.

    cells: members, slice_keys, iy, ix, value, wet.  A pattern is the number of those cells and 128 bits of hashes that don't depend on
    their order.  A row for each field, not for each cell.
    """
    there = F.col("wet") & F.col("value").isNotNull()
    one, other = (F.when(there, F.xxhash64(F.lit(salt), *SQUARE)) for salt in ("a", "b"))
    parts = [F.count_if(there), F.coalesce(F.bit_xor(one), F.lit(0)), F.coalesce(F.sum(F.shiftright(other, 24)), F.lit(0)), F.coalesce(F.bit_xor(other), F.lit(0))]
    return cells.groupBy(*members, *slice_keys).agg(F.concat_ws(":", *[p.cast("string") for p in parts]).alias("pattern"))


def fill_weights(cells: DataFrame, slice_keys: Sequence[str], method: str = "distance_weighted", max_steps: int = 12, power: float = 2.0, min_donors: int = 4, first_steps: int = 3) -> DataFrame:
    """slice_keys, iy, ix, src_iy, src_ix, w: the donors of every pending cell that has any, with weights that sum to one.

    Donors depend on where values are, not on what they are, so one table fills every field with the same gaps.  cells, method and the
    rest as for coastal_fill, which gives the same values one field at a time.
    """
    spark, key = cells.sparkSession, [*slice_keys, *SQUARE]
    pending, donors = cells.where("wet AND value IS NULL"), cells.where("wet AND value IS NOT NULL")
    near, far = offsets(spark, min(first_steps, max_steps), power), offsets(spark, max_steps, power)
    own = W.partitionBy(*key)

    def chosen(pending: DataFrame, table: DataFrame) -> DataFrame:
        pairs = _donors(pending, donors, slice_keys, table)
        if method == "nearest":
            first = F.row_number().over(own.orderBy("rad", "d2", "dy", "dx"))
            return pairs.withColumn("_first", first).where("_first = 1").withColumns({"w": F.lit(1.0), "enough": F.lit(True)})
        upto = F.count("*").over(own.orderBy("rad"))  # of whole rings
        pairs = pairs.withColumn("_n", upto)
        ring = F.coalesce(F.min(F.when(F.col("_n") >= min_donors, F.col("rad"))).over(own), F.min("rad").over(own))
        pairs = pairs.withColumns({"_ring": ring, "enough": F.max("_n").over(own) >= min_donors}).where(F.col("rad") <= F.col("_ring"))
        return pairs.withColumn("w", F.col("w") / F.sum("w").over(own))

    if method not in ("nearest", "distance_weighted"):
        raise ValueError(f"no fill method {method}")
    columns = [*key, F.col("_y").alias("src_iy"), F.col("_x").alias("src_ix"), "w"]
    done = chosen(pending, near).where("enough")
    if first_steps >= max_steps:
        return chosen(pending, far).select(*columns)
    done = checkpointed(done.select(*columns))  # read for itself and for what it leaves
    rest = pending.join(done.select(*key).distinct(), key, "left_anti")
    return done.unionByName(chosen(rest, far).select(*columns))


def apply_fill(cells: DataFrame, weights: DataFrame, fields: Sequence[str], slice_keys: Sequence[str]) -> DataFrame:
    """cells (fields, slice_keys, iy, ix, value, wet) with gaps filled by a weights table; filled marks them.

    fields: what tells fields with the same slices apart, members among them; slice_keys: what the weights are for.
    """
    values = cells.where("wet AND value IS NOT NULL").select(*fields, *slice_keys, F.col("iy").alias("src_iy"), F.col("ix").alias("src_ix"), "value")
    found = weights.join(values, [*slice_keys, "src_iy", "src_ix"]).groupBy(*fields, *slice_keys, *SQUARE).agg(F.sum(F.col("w") * F.col("value")).alias("fill"))
    both = cells.join(found, [*fields, *slice_keys, *SQUARE], "left")
    mark = F.col("wet") & F.col("value").isNull() & F.col("fill").isNotNull()
    return both.withColumn("filled", mark).withColumn("value", F.when(F.col("filled"), F.col("fill")).otherwise(F.col("value"))).drop("fill")


def _tile_components(group: pd.DataFrame) -> list[str]:
    """For each cell of one tile the name of its 8-connected component: its first cell in row-major order."""
    todo = set(zip(group["iy"].tolist(), group["ix"].tolist(), strict=True))
    name: dict[tuple[int, int], str] = {}
    for start in sorted(todo):
        if start in name:
            continue
        name[start], stack = f"{start[0]:08d}:{start[1]:08d}", [start]
        while stack:
            y, x = stack.pop()
            for c in ((y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
                if c in todo and c not in name:
                    name[c] = name[start]
                    stack.append(c)
    return [name[c] for c in zip(group["iy"].tolist(), group["ix"].tolist(), strict=True)]


def pending_components(cells: DataFrame, slice_keys: Sequence[str], checkpoint=None, tile: int = 64) -> DataFrame:
    """slice_keys, iy, ix, component of the wet cells without a value, by 8-neighbour connection.

    Tiles are labelled on their own first; then the smallest name spreads over the graph of tile components that touch, which
    is small.  checkpoint (DataFrame -> DataFrame) cuts the lineage between rounds.
    """
    keep = checkpoint or checkpointed
    key, kinds = [*slice_keys, *SQUARE], {f.name: f.dataType.simpleString() for f in cells.schema}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in key), "component string"])
    pending = cells.where("wet AND value IS NULL").select(*key)

    def label(group: pd.DataFrame) -> pd.DataFrame:
        return group[key].assign(component=_tile_components(group))

    labels = keep(pending.groupBy(*slice_keys, F.floor(F.col("iy") / tile).alias("_v"), F.floor(F.col("ix") / tile).alias("_u")).applyInPandas(label, schema))
    ring = F.broadcast(offsets(cells.sparkSession, 1, 1.0).select("dy", "dx"))
    rim = labels.where(F.pmod("iy", F.lit(tile)).isin(0, tile - 1) | F.pmod("ix", F.lit(tile)).isin(0, tile - 1))
    moved = rim.crossJoin(ring).select(*slice_keys, (F.col("iy") + F.col("dy")).alias("iy"), (F.col("ix") + F.col("dx")).alias("ix"), F.col("component").alias("other"))
    touch = keep(moved.join(rim, key).where("component <> other").select(*slice_keys, "component", "other").distinct())
    names = keep(labels.select(*slice_keys, "component").distinct().withColumn("root", F.col("component")))
    while touch.limit(1).count():
        near = touch.join(names.select(*slice_keys, F.col("component").alias("other"), F.col("root").alias("low")), [*slice_keys, "other"]).groupBy(*slice_keys, "component").agg(F.min("low").alias("low"))
        step = names.join(near, [*slice_keys, "component"], "left").select(*slice_keys, "component", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        jump = names.select(*slice_keys, F.col("component").alias("root"), F.col("root").alias("jump"))
        new = keep(step.join(jump, [*slice_keys, "root"], "left").select(*slice_keys, "component", "old", F.least("root", "jump").alias("root")))
        names = new.select(*slice_keys, "component", "root")
        if new.where("old <> root").limit(1).count() == 0:
            break
    return labels.join(names, [*slice_keys, "component"]).select(*key, F.col("root").alias("component"))


def propagate(group: pd.DataFrame) -> pd.DataFrame:
    """First-in first-out propagation into one component; rows with pending False are the finite wet cells around it.

    Begins with the pending cells, in row-major order, that touch a finite wet cell; a cell takes the mean of its finite wet
    neighbours when its turn comes, earlier fills among them.
    """
    value = {(y, x): v for y, x, v, p in group[["iy", "ix", "value", "pending"]].itertuples(index=False) if not p}
    todo = sorted((y, x) for y, x, p in group[["iy", "ix", "pending"]].itertuples(index=False) if p)
    wanted, around = set(todo), [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]
    queue = [c for c in todo if any((c[0] + a, c[1] + b) in value for a, b in around)]
    queued, out, at = set(queue), [], 0
    while at < len(queue):
        y, x = queue[at]
        at += 1
        near = [value[y + a, x + b] for a, b in around if (y + a, x + b) in value]
        value[y, x] = float(np.mean(near))
        out.append((y, x, value[y, x]))
        for a, b in around:
            c = (y + a, x + b)
            if c in wanted and c not in queued and c not in value:
                queued.add(c)
                queue.append(c)
    return pd.DataFrame(out, columns=["iy", "ix", "fill"])


_AROUND = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]


def component_sizes(parts: DataFrame, slice_keys: Sequence[str], large: int = 200_000) -> DataFrame:
    """slice_keys, component, cells, is_large: what to look at before a long run.  parts: as pending_components gives them."""
    return parts.groupBy(*slice_keys, "component").agg(F.count("*").alias("cells")).withColumn("is_large", F.col("cells") > large)


def _tile_rounds(state: DataFrame, slice_keys: Sequence[str], tile: int, column: str, step, keep) -> DataFrame:
    """state (slice_keys, iy, ix, pending, column, ...) with `step` applied to each tile and its rim of neighbours until nothing changes.

    step: (grids of pending, of column, and of the other columns; by the place in a tile with a rim of one) -> the grid of column.  A round
    moves values by a tile at most, so there are about as many rounds as tiles on the longest way.
    """
    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    names = list(state.columns)
    others = [c for c in names if c not in (*slice_keys, *SQUARE, "pending", column)]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in state.columns), "_changed boolean"])
    side = tile + 2

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        top, left = key[-2] * tile - 1, key[-1] * tile - 1
        y, x = group["iy"].to_numpy() - top, group["ix"].to_numpy() - left
        grids = []
        for c in ("pending", column, *others):
            grid = np.zeros((side, side), bool) if c == "pending" else np.full((side, side), np.nan)
            grid[y, x] = group[c].to_numpy(bool if c == "pending" else np.float64, na_value=False if c == "pending" else np.nan)
            grids.append(grid)
        old = grids[1].copy()
        new = step(*grids)
        own = group["_own"].to_numpy(bool)
        out = group[own][names].copy()
        y, x = y[own], x[own]
        out[column] = new[y, x]
        if not kinds[column].startswith("double"):
            out[column] = out[column].astype("Int64")
        out["_changed"] = (new[y, x] != old[y, x]) & ~(np.isnan(new[y, x]) & np.isnan(old[y, x]))
        return out

    at = lambda c, d: F.floor((F.col(c) + d) / tile).cast("int")
    tiles = F.array_distinct(F.array(*[F.struct(at("iy", a).alias("v"), at("ix", b).alias("u")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    while True:
        spread = state.withColumn("_t", F.explode(tiles)).select(*state.columns, F.col("_t.v").alias("_v"), F.col("_t.u").alias("_u"))
        spread = spread.withColumn("_own", (F.col("_v") == at("iy", 0)) & (F.col("_u") == at("ix", 0)))
        done = keep(spread.groupBy(*slice_keys, "_v", "_u").applyInPandas(run, schema))
        state = done.drop("_changed")
        if done.where("_changed").limit(1).count() == 0:
            return state


def _levels_of_tile(pending: np.ndarray, level: np.ndarray, *_: np.ndarray) -> np.ndarray:
    """Steps from the first cells of the queue, through pending cells."""
    grid = np.where(np.isnan(level), np.inf, level)
    while True:
        around = np.pad(grid, 1, constant_values=np.inf)
        best = np.min([around[1 + a : 1 + a + len(grid), 1 + b : 1 + b + len(grid)] for a, b in _AROUND], axis=0) + 1
        new = np.where(pending, np.minimum(grid, best), grid)
        if (new == grid).all():
            return np.where(np.isinf(new), np.nan, new)
        grid = new


def _values_of_tile(pending: np.ndarray, value: np.ndarray, level: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Cells of the queue in its order, as far as all before them that touch them are known: the mean of those."""
    value, last = value.copy(), len(value) - 1
    todo = np.argwhere(pending & np.isnan(value) & ~np.isnan(level))
    todo = todo[((todo > 0) & (todo < last)).all(1)]
    for y, x in todo[np.lexsort((rank[tuple(todo.T)], level[tuple(todo.T)]))].tolist():
        near, ready = [], True
        for a, b in _AROUND:
            j, i = y + a, x + b
            if pending[j, i] and not np.isnan(level[j, i]) and (level[j, i], rank[j, i]) < (level[y, x], rank[y, x]):
                ready = ready and not np.isnan(value[j, i])
            if not np.isnan(value[j, i]):
                near.append(value[j, i])
        if ready:
            value[y, x] = float(np.mean(near))
    return value


def _queue_ranks(levelled: DataFrame, slice_keys: Sequence[str], keep) -> DataFrame:
    """levelled (slice_keys, iy, ix, level) with rank: the order of a level's cells in one first-in first-out queue.

    The first level is in row-major order.  A later cell comes when the first of its neighbours in the level before takes its turn, and
    that one's neighbours come in row-major order: by (its rank, place among its neighbours).  Those pairs are numbers that grow by a
    digit a level, until they are numbered anew.  Each level reads its own cells alone.
    """
    from pelagia.operators.products import numbered

    spark, key = levelled.sparkSession, [*slice_keys, *SQUARE]
    path = staged_path(spark, "queue_levels")
    levelled.where("level IS NOT NULL").write.partitionBy("level").parquet(path)
    stored = spark.read.schema(levelled.schema).parquet(path)
    last = stored.agg(F.max("level")).first()[0]
    if last is None:
        return levelled.withColumn("rank", F.lit(None).cast("long"))
    ring = F.broadcast(offsets(spark, 1, 1.0).select("dy", "dx", ((F.col("dy") + 1) * 3 + F.col("dx") + 1).alias("_o")))
    front = keep(numbered(stored.where("level = 0").withColumn("_by", F.struct(*key)), "_by", "rank").select(*key, F.col("rank").cast("long")))
    out, digits = [front.withColumn("level", F.lit(0))], 10
    for level in range(1, last + 1):
        first = front.crossJoin(ring).select(*slice_keys, (F.col("iy") + F.col("dy")).alias("iy"), (F.col("ix") + F.col("dx")).alias("ix"), (F.col("rank") * 9 + F.col("_o")).alias("_rank"))
        front = stored.where(F.col("level") == level).select(*key).join(first, key).groupBy(*key).agg(F.min("_rank").alias("rank"))
        digits += 1
        if digits > 18:
            front, digits = numbered(front.withColumn("_by", F.col("rank")).drop("rank"), "_by", "rank").select(*key, F.col("rank").cast("long")), 10
        front = keep(front)
        out.append(front.withColumn("level", F.lit(level)))
    while len(out) > 1:  # a balanced tree of unions
        out = [out[i].unionByName(out[i + 1]) if i + 1 < len(out) else out[i] for i in range(0, len(out), 2)]
    return levelled.join(out[0].select(*key, "rank"), key, "left")


def propagate_by_tiles(pending: DataFrame, halo: DataFrame, slice_keys: Sequence[str], checkpoint=None, tile: int = 64) -> DataFrame:
    """slice_keys, iy, ix, fill: what one queue over each component of pending cells gives, with no task that holds more than a tile.

    The order of the queue depends on the mask alone: the number of steps from its first cells (tile by tile, until nothing changes),
    then the order within each number of steps.  With that known a cell is the mean of what is finite before it among its neighbours, which
    tiles work out side by side, as far as their neighbours are done, in as many rounds as the longest chain crosses tiles.
    """
    keep, key = checkpoint or checkpointed, [*slice_keys, *SQUARE]
    ring = F.broadcast(offsets(pending.sparkSession, 1, 1.0).select("dy", "dx"))
    touched = halo.crossJoin(ring).select(*slice_keys, (F.col("iy") + F.col("dy")).alias("iy"), (F.col("ix") + F.col("dx")).alias("ix")).distinct().withColumn("level", F.lit(0))
    cells = pending.select(*key).join(touched, key, "left").withColumn("pending", F.lit(True))
    levelled = _tile_rounds(keep(cells), slice_keys, tile, "level", _levels_of_tile, keep).select(*key, "level")
    ranked = keep(_queue_ranks(levelled, slice_keys, keep))
    known = halo.select(*key, F.lit(False).alias("pending"), "value", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("rank"))
    state = ranked.select(*key, F.lit(True).alias("pending"), F.lit(None).cast("double").alias("value"), "level", "rank").unionByName(known)
    return _tile_rounds(keep(state), slice_keys, tile, "value", _values_of_tile, keep).where("pending AND value IS NOT NULL").select(*key, F.col("value").alias("fill"))


def force_complete(cells: DataFrame, slice_keys: Sequence[str], checkpoint=None, tile: int = 64, large: int = 200_000) -> DataFrame:
    """Fill every wet cell that connects to a finite one, by propagation; `forced` marks them.

    A group is one component of pending cells with the finite cells that touch it, so no task holds a slice; components of more than
    `large` cells are worked out tile by tile in the same order (component_sizes tells them beforehand).
    """
    key = [*slice_keys, *SQUARE]
    keep = checkpoint or checkpointed
    cells = keep(cells)  # the labels, the halo and the result read it
    parts = keep(pending_components(cells, slice_keys, checkpoint, tile))
    ring = F.broadcast(offsets(cells.sparkSession, 1, 1.0).select("dy", "dx"))
    giants = keep(component_sizes(parts, slice_keys, large).where("is_large").select(*slice_keys, "component"))
    finite = cells.where("wet AND value IS NOT NULL").select(*key, "value")

    def halo(parts: DataFrame, *more: str) -> DataFrame:
        edge = parts.crossJoin(ring).select(*slice_keys, (F.col("iy") + F.col("dy")).alias("iy"), (F.col("ix") + F.col("dx")).alias("ix"), *more).distinct()
        return finite.join(edge, key)

    several = giants.limit(1).count() > 0
    small = parts.join(giants, [*slice_keys, "component"], "left_anti") if several else parts
    rows = small.withColumns({"value": F.lit(None).cast("double"), "pending": F.lit(True)}).unionByName(halo(small, "component").withColumn("pending", F.lit(False)))
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in slice_keys), "component string", "iy int", "ix int", "fill double"])
    names = [*slice_keys, "component"]

    def run(group_key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = propagate(group)
        for n, v in zip(names, group_key, strict=True):
            out[n] = v
        return out[[*names, "iy", "ix", "fill"]]

    done = rows.groupBy(*names).applyInPandas(run, schema).drop("component")
    if several:
        giant = keep(parts.join(giants, [*slice_keys, "component"]).select(*key))
        done = done.unionByName(propagate_by_tiles(giant, keep(halo(giant)), slice_keys, keep, tile))
    both = cells.join(done, key, "left")
    return both.withColumn("forced", F.col("wet") & F.col("value").isNull() & F.col("fill").isNotNull()).withColumn("value", F.when(F.col("forced"), F.col("fill")).otherwise(F.col("value"))).drop("fill")


def fill_fallback(cells: DataFrame, constant: float = 0.0) -> DataFrame:
    """Wet cells that still have no value take a constant; fallback marks them."""
    mark = F.col("wet") & F.col("value").isNull()
    return cells.withColumn("fallback", mark).withColumn("value", F.when(F.col("fallback"), F.lit(constant)).otherwise(F.col("value")))


def _near_tiles(pending: DataFrame, donors: DataFrame, slice_keys: Sequence[str], tiles: Sequence[int]) -> DataFrame:
    """slice_keys, _pv, _pu, _dv, _du: for each tile of pending cells the tiles that may hold the nearest donor of one of them.

    Sizes go from coarse to fine.  A tile with donors has one within the distance of the two tiles' farthest corners; tiles whose
    nearest corners are beyond the least of those distances are out, and so are the finer tiles inside them.
    """
    before, out = 0, None
    for t in tiles:
        at = lambda c, n=t: F.floor(F.col(c) / n).cast("int")
        p = pending.select(*slice_keys, at("iy").alias("_pv"), at("ix").alias("_pu")).distinct()
        d = donors.select(*slice_keys, at("iy").alias("_dv"), at("ix").alias("_du")).distinct()
        if out is None:
            pairs = p.join(d, list(slice_keys))
        else:
            up = lambda c, n=before // t: F.floor(F.col(c) / n).cast("int")
            wide = out.select(*slice_keys, *[F.col(c).alias(f"_up{c}") for c in ("_pv", "_pu", "_dv", "_du")])
            p = p.withColumns({"_up_pv": up("_pv"), "_up_pu": up("_pu")})
            d = d.withColumns({"_up_dv": up("_dv"), "_up_du": up("_du")})
            pairs = p.join(wide, [*slice_keys, "_up_pv", "_up_pu"]).join(d, [*slice_keys, "_up_dv", "_up_du"]).select(*slice_keys, "_pv", "_pu", "_dv", "_du")
        steps = [F.abs(F.col("_pv") - F.col("_dv")).cast("long"), F.abs(F.col("_pu") - F.col("_du")).cast("long")]
        near = sum((F.when(n > 0, (n - 1) * t + 1).otherwise(0) * F.when(n > 0, (n - 1) * t + 1).otherwise(0) for n in steps), F.lit(0))
        far = sum((((n + 1) * t - 1) * ((n + 1) * t - 1) for n in steps), F.lit(0))
        bound = F.min("_far").over(W.partitionBy(*slice_keys, "_pv", "_pu"))
        out, before = pairs.withColumns({"_near": near, "_far": far}).withColumn("_bound", bound).where("_near <= _bound").select(*slice_keys, "_pv", "_pu", "_dv", "_du"), t
    return out


def nearest_any_donor(cells: DataFrame, slice_keys: Sequence[str], tiles: Sequence[int] = (512, 32), strict: bool = True) -> DataFrame:
    """Wet cells that still have no value take the nearest finite cell's, wet or not, by (distance, iy, ix).

    Only tiles that may hold the nearest donor are searched (each size divides the one before).  A slice without any finite cell is an
    error; with strict off it keeps its gaps.  The pending side holds few rows: what all other fills have left.
    """
    key, t = [*slice_keys, *SQUARE], tiles[-1]
    cells = checkpointed(cells)  # tiles, donors and the result read it
    pending, donors = cells.where("wet AND value IS NULL").select(*key), cells.where("value IS NOT NULL")
    at = lambda c: F.floor(F.col(c) / t).cast("int")
    there = donors.select(*slice_keys, at("iy").alias("_dv"), at("ix").alias("_du"), F.col("iy").alias("_y"), F.col("ix").alias("_x"), F.col("value").alias("donor"))
    asks = pending.withColumns({"_pv": at("iy"), "_pu": at("ix")}).join(_near_tiles(pending, donors, slice_keys, tiles), [*slice_keys, "_pv", "_pu"])
    dy, dx = (F.col("_y") - F.col("iy")).cast("long"), (F.col("_x") - F.col("ix")).cast("long")
    found = asks.join(there, [*slice_keys, "_dv", "_du"]).groupBy(*key).agg(F.min_by("donor", F.struct(dy * dy + dx * dx, "_y", "_x")).alias("fill"))
    both = cells.join(found, key, "left").withColumn("nearest", F.col("wet") & F.col("value").isNull() & F.col("fill").isNotNull())
    none = F.col("wet") & F.col("value").isNull() & F.col("fill").isNull()
    fill = F.when(none, F.raise_error(F.lit("a slice has no finite cell at all")).cast("double")).otherwise(F.col("fill")) if strict else F.col("fill")
    return both.withColumn("value", F.coalesce("value", F.when(F.col("wet"), fill))).drop("fill")


def fill_report(cells: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """For each dataset the cells that each flag marks, valid and missing wet cells."""
    counts = [F.count_if(F.col(f)).alias(f"n_{f}") for f in flags]
    return cells.groupBy(*keys).agg(F.count("*").alias("cells"), F.count_if("wet").alias("wet_cells"), F.count("value").alias("valid"), F.count_if(F.col("wet") & F.col("value").isNull()).alias("remaining"), *counts)


def review_report(product: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each dataset of a downscaled product: cells by how their anomaly came about, cells that a bound cut, and those without a value."""
    kinds = [F.count_if(F.col("fill_kind") == k).alias(f"n_{k}") for k in ("filled", "top", "forced", "fallback")]
    sides = [F.count_if(F.col("clipped") == k).alias(f"n_{k}") for k in ("below", "above")]
    return product.groupBy(*keys).agg(F.count("*").alias("cells"), F.count("value").alias("valid"), *kinds, *sides)
