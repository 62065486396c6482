"""Raster blocks there and back, one-pass product facts against separate passes, grid types and steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators import audit, products


@pytest.mark.parametrize("block", [4, 7, 256])
def test_blocks_decode_to_the_cells(spark, block):
    rng = np.random.default_rng(2)
    rows = [(d, r, c, int(rng.integers(-30000, 30000)), -32768) for d, (h, w) in (("a", (9, 13)), ("b", (1, 1)), ("c", (8, 8))) for r in range(h) for c in range(w) if d != "a" or rng.random() < 0.8 or (r, c) == (8, 12)]
    rows += [("d", 0, 0, -32768, -32768), ("d", 0, 1, 5, -32768)]
    coded = spark.createDataFrame(rows, "dataset string, row int, col int, stored_value int, nodata int")
    blocks = products.raster_blocks(coded, ["dataset"], block)
    for b in blocks.collect():
        assert len(b["values"]) == block * block
        held = {(r, c): v for d, r, c, v, _ in rows if d == b.dataset}
        for i, v in enumerate(b["values"]):
            assert v == held.get((b.block_row * block + i // block, b.block_col * block + i % block), -32768)
    assert blocks.where("dataset = 'a'").select("height", "width").distinct().collect() == [(9, 13)]
    assert sorted(map(tuple, products.unblocked(blocks, ["dataset"], block).collect())) == sorted(r[:4] for r in rows if r[3] != -32768)
    assert products.raster_blocks(coded.limit(0), ["dataset"], block).count() == 0


def cells(spark):
    """Two products: an even grid, and one with an uneven axis and gaps; levels, times."""
    rows = spark.range(2 * 3 * 2 * 5 * 6).selectExpr("int(id % 2) AS p", "int(id div 2 % 3) AS iz", "int(id div 6 % 2) AS t", "int(id div 12 % 5) AS iy", "int(id div 60 % 6) AS ix")
    lon = F.when((F.col("p") == 1) & (F.col("ix") == 5), 71.0).otherwise(F.col("ix") * 10.0 + 20)
    out = rows.select(F.concat(F.lit("p"), "p").alias("product"), "iz", F.date_add(F.lit("2001-01-01").cast("date"), F.col("t") * 31).alias("time"), "iy", "ix", (F.col("iz") * 7.0 + 0.5).alias("depth"), (F.col("iy") * 20.0 - 40).alias("lat"), lon.alias("lon"))
    return out.withColumn("value", F.when(F.expr("(ix + iy + iz) % 4 > 0 OR product = 'p0'"), F.sin(F.col("ix") * 3.0 + F.col("iy") + F.col("iz"))))


def test_facts_of_one_pass_are_those_of_four(spark):
    c = cells(spark)
    got = {r["product"]: r.asDict() for r in audit.product_facts(c, ["product"], 10.0).collect()}
    keys = ["product"]
    parts = [audit.field_stats(c, keys), audit.field_mean(c, keys, ["iz", "time"], 10.0), audit.level_stats(c, keys), audit.grid_summary(c, keys)]
    for part in parts:
        for r in part.collect():
            for k, v in r.asDict().items():
                mine = got[r["product"]][k]
                assert mine == v or abs(mine - v) < 1e-12, (k, mine, v)
    assert got["p0"]["xinc"] == 10.0 and got["p1"]["xinc"] is None and got["p1"]["yinc"] == 20.0


def test_facts_read_the_cells_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(audit, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df.checkpoint())
    audit.product_facts(cells(spark), ["product"], 10.0).count()
    assert len(plans) == 1 and plans[0].count("Range (") == 1 and "Expand" in plans[0]


def test_types_and_steps_of_grids(spark):
    rows = [("even", y, x, y * 2.0, x * 0.1) for y in range(3) for x in range(5)]
    rows += [("uneven", y, x, y * 2.0, [0.0, 1.0, 5.0, 9.0][x]) for y in range(2) for x in range(4)]
    rows += [("bent", y, x, y * 2.0 + x * 0.01, x + y * 0.5) for y in range(3) for x in range(4)]
    rows += [("point", 0, 0, 1.0, 1.0)]
    got = {r.d: (r.gridtype, r.xsize, r.ysize, r.xinc, r.yinc) for r in audit.grid_summary(spark.createDataFrame(rows, "d string, iy int, ix int, lat double, lon double"), ["d"]).collect()}
    assert got == {"even": ("lonlat", 5, 3, 0.1, 2.0), "uneven": ("lonlat", 4, 2, None, 2.0), "bent": ("curvilinear", 4, 3, None, None), "point": ("lonlat", 1, 1, None, None)}
