"""Shared fill weights against one search a field, the ensemble job against the job of one field at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators import fill
from pelagia.plans.downscale import downscale, ensemble_domain, ensemble_downscale
from tests.test_operators import NX, NY, array, field, sample  # noqa: F401


@pytest.mark.parametrize("method", ["nearest", "distance_weighted"])
@pytest.mark.parametrize("first_steps", [1, 2, 5])
def test_weights_give_what_the_search_gives(spark, sample, method, first_steps):  # noqa: F811
    a, wet = sample
    cells = field(spark, a, wet)
    table = fill.fill_weights(cells, ["iz"], method, max_steps=5, first_steps=first_steps)
    got, want = (array(x) for x in (fill.apply_fill(cells, table, [], ["iz"]), fill.coastal_fill(cells, ["iz"], method, max_steps=5)))
    assert np.allclose(got, want, equal_nan=True) and np.isfinite(want).sum() > np.isfinite(a).sum()
    sums = table.groupBy("iy", "ix").agg(F.sum("w").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1) < 1e-12 for r in sums)


def members_of(spark, a, wet, n):
    """n fields with the gaps of a, one with gaps of its own, and one without any value."""
    rng = np.random.default_rng(3)
    other = np.where(rng.random(a.shape) < 0.4, np.nan, rng.normal(size=a.shape))
    arrays = {f"r{i}": a + i for i in range(n)} | {"own": other, "empty": np.full(a.shape, np.nan)}
    frames = [field(spark, v).drop("wet").withColumns({"member": F.lit(k), "window": F.lit(w), "variable": F.lit("thetao")}) for k, v in arrays.items() for w in ("near", "far")]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_fields_with_the_same_gaps_share_a_pattern(spark, sample):  # noqa: F811
    a, wet = sample
    domain = ensemble_domain(field(spark, np.where(wet, 1.0, np.nan), wet).withColumn("variable", F.lit("thetao")), members_of(spark, a, wet, 3), ["member", "window"])
    assert domain.count() == NY * NX * 10
    patterns = {(r["member"], r["window"]): r["pattern"] for r in fill.gap_patterns(domain, ["member", "window"], ["variable", "iz"]).collect()}
    assert len(patterns) == 10 and len(set(patterns.values())) == 3
    assert len({patterns[f"r{i}", w] for i in range(3) for w in ("near", "far")}) == 1


@pytest.mark.parametrize("complete", [False, True])
def test_the_ensemble_is_every_field_on_its_own(spark, sample, complete):  # noqa: F811
    a, wet = sample
    base = field(spark, np.where(wet, 10.0, np.nan)).drop("wet").withColumns({"variable": F.lit("thetao"), "depth": F.lit(0.5), "lat": F.lit(0.0), "lon": F.lit(0.0)})
    anomaly = members_of(spark, a, wet, 2).where("NOT (member = 'r1' AND iy = 3)")
    options = {"max_steps": 3, "complete": complete, "fallback": 0.0, "scale": 2.0, "bounds": {"thetao": (8.0, 12.0)}}
    names = ["member", "window", "iy", "ix", "value", "anomaly_value", "fill_kind", "clipped", "depth"]
    got, want = (sorted(map(tuple, f(base, anomaly, members=["member", "window"], **options).select(*names).collect()), key=repr) for f in (ensemble_downscale, downscale))
    assert len(got) == len(want) == 8 * NY * NX
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and g[6:] == w[6:] and all(x == y or abs(x - y) < 1e-12 for x, y in zip(g[4:6], w[4:6], strict=True))


def test_donors_are_searched_once(spark, sample, monkeypatch):  # noqa: F811
    a, wet = sample
    asked = []
    search = fill._donors
    monkeypatch.setattr(fill, "_donors", lambda pending, *rest: asked.append(pending.select("pattern", "iy", "ix").count()) or search(pending, *rest))
    base = field(spark, np.where(wet, 10.0, np.nan)).drop("wet").withColumns({"variable": F.lit("thetao"), "depth": F.lit(0.5), "lat": F.lit(0.0), "lon": F.lit(0.0)})
    one, many = (members_of(spark, a, wet, n).where("member LIKE 'r%'") for n in (1, 6))
    ensemble_downscale(base, one, ["member", "window"], max_steps=5).count()
    few = list(asked)
    asked.clear()
    ensemble_downscale(base, many, ["member", "window"], max_steps=5).count()
    assert asked == few and len(few) == 2  # near rings, then the others


def test_too_many_members_and_none(spark, sample):  # noqa: F811
    a, wet = sample
    base = field(spark, a, wet).withColumn("variable", F.lit("thetao"))
    change = members_of(spark, a, wet, 2)
    with pytest.raises(ValueError):
        ensemble_domain(base, change, ["member"], max_members=2)
    assert ensemble_domain(base, change.limit(0), ["member", "window"]).count() == 0


@pytest.mark.parametrize("method", ["nearest", "distance_weighted"])
@pytest.mark.parametrize(("tile", "steps"), [(4, 3), (5, 7), (64, 12)])
def test_tiles_fill_as_the_search_by_offsets(spark, sample, method, tile, steps):  # noqa: F811
    a, wet = sample
    cells = field(spark, a, wet).unionByName(field(spark, a * 2, wet).withColumn("iz", F.lit(1)))
    tiles, offsets = (f(cells, ["iz"], method, max_steps=steps, **more) for f, more in ((fill.coastal_fill_by_tiles, {"tile": tile}), (fill.coastal_fill, {})))
    for z in (0, 1):
        assert np.allclose(array(tiles.where(F.col("iz") == z)), array(offsets.where(F.col("iz") == z)), equal_nan=True, rtol=1e-12)
    assert tiles.where("filled").count() == offsets.where("filled").count() > 0
    with pytest.raises(ValueError):
        fill.coastal_fill_by_tiles(cells, ["iz"], "other")


def test_tiles_move_fewer_rows(spark):
    """A field of 200 x 200 with scattered gaps of a fifth of its cells: rows that travel, by both ways."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(200, 200))
    a[rng.random(a.shape) < 0.2] = np.nan
    cells = field(spark, a).cache()
    pending = cells.where("value IS NULL")
    by_offsets = pending.count() * 48  # the first search, three steps; more where donors are few
    at = lambda c, d: F.floor((F.col(c) + d) / 64)
    by_tiles = cells.withColumn("_v", F.explode(F.sequence(at("iy", -12), at("iy", 12)))).withColumn("_u", F.explode(F.sequence(at("ix", -12), at("ix", 12)))).count()
    assert by_tiles < 2.1 * 40_000 and by_tiles < by_offsets / 4
    assert fill.coastal_fill_by_tiles(cells, ["iz"]).where("value IS NULL").count() == 0
