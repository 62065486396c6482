"""A component that is too large for one task: the queue's order and values tile by tile against one queue."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators import fill
from pelagia.staging import checkpointed
from tests.test_operators import field


def one_queue(a, wet):
    """First in, first out, over the whole field."""
    v, (ny, nx) = a.copy(), a.shape
    near = lambda y, x: [(y + b, x + c) for b in (-1, 0, 1) for c in (-1, 0, 1) if (b or c) and 0 <= y + b < ny and 0 <= x + c < nx]
    queue = [(y, x) for y in range(ny) for x in range(nx) if wet[y, x] and np.isnan(a[y, x]) and any(wet[c] and not np.isnan(a[c]) for c in near(y, x))]
    seen, order = set(queue), {}
    for y, x in queue:
        order[y, x] = len(order)
        v[y, x] = np.mean([v[c] for c in near(y, x) if wet[c] and not np.isnan(v[c])])
        for c in near(y, x):
            if wet[c] and np.isnan(v[c]) and c not in seen:
                seen.add(c)
                queue.append(c)
    return v, order


def fields():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(21, 26))
    wet = rng.random(a.shape) < 0.85
    a[4:19, 3:24] = np.nan  # one gap over many tiles
    a[9, 12] = 2.0
    spiral = np.full((13, 13), np.nan)  # a way that crosses tiles again and again
    road = np.zeros_like(spiral, bool)
    for r in range(0, 13, 2):
        road[r, :] = True
        road[min(r + 1, 12), 12 if r % 4 == 0 else 0] = True
    spiral[0, 0] = 1.0
    lonely = np.full((6, 6), np.nan)
    return [(a, wet), (spiral, road), (lonely, np.ones_like(lonely, bool))]


@pytest.mark.parametrize("case", [0, 1, 2])
def test_tiles_give_what_one_queue_gives(spark, case):
    a, wet = fields()[case]
    a = np.where(wet, a, np.nan)
    want, _ = one_queue(a, wet)
    got = fill.force_complete(field(spark, a, wet), ["iz"], checkpointed, tile=5, large=3)
    values = {(r.iy, r.ix): r.value for r in got.collect()}
    for (y, x), v in values.items():
        assert (v is None and np.isnan(want[y, x])) or abs(v - want[y, x]) < 1e-12, (y, x)
    assert got.where("forced").count() == int((~np.isnan(want)).sum() - (~np.isnan(a)).sum())


def test_the_order_is_the_queues(spark):
    a, wet = fields()[0]
    a = np.where(wet, a, np.nan)
    _, order = one_queue(a, wet)
    cells = field(spark, a, wet)
    pending = cells.where("wet AND value IS NULL").select("iz", "iy", "ix")
    halo = cells.where("wet AND value IS NOT NULL").select("iz", "iy", "ix", "value")
    touched = halo.crossJoin(fill.offsets(spark, 1, 1.0)).select("iz", (F.col("iy") + F.col("dy")).alias("iy"), (F.col("ix") + F.col("dx")).alias("ix")).distinct().withColumn("level", F.lit(0))
    start = pending.join(touched, ["iz", "iy", "ix"], "left").withColumn("pending", F.lit(True))
    levelled = fill._tile_rounds(start, ["iz"], 5, "level", fill._levels_of_tile, checkpointed).select("iz", "iy", "ix", "level")
    rows = [r for r in fill._queue_ranks(levelled, ["iz"], checkpointed).collect() if r.level is not None]
    ours = [(r.iy, r.ix) for r in sorted(rows, key=lambda r: (r.level, r.rank))]
    assert ours == sorted(order, key=order.get) and max(r.level for r in rows) >= 5


def test_no_group_is_larger_than_a_tile_with_its_rim(spark, monkeypatch):
    a, wet = fields()[0]
    cells = field(spark, np.where(wet, a, np.nan), wet)
    sizes = fill.component_sizes(fill.pending_components(cells, ["iz"], checkpointed, 5), ["iz"], 40).collect()
    assert sum(r.is_large for r in sizes) == 1 and max(r.cells for r in sizes) > 200
    alone = fill.propagate
    monkeypatch.setattr(fill, "propagate", lambda group: alone(group) if group["pending"].sum() <= 40 else 1 / 0)
    fill.force_complete(cells, ["iz"], checkpointed, tile=5, large=40).count()
