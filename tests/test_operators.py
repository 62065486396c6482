"""Operators against loops over small arrays, and the traps that their semantics hold."""

import datetime
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pelagia import schema
from pelagia.functions import fields as fx
from pelagia.operators import audit, climate, columns, fill, manifest, products, remap
from pelagia.plans.downscale import coast_baseline, downscale
from pelagia.staging import checkpointed

NY, NX = 12, 17


def field(spark, a, wet=None):
    """Cells of an array (NaN: none), with z = 0."""
    rows = [(0, y, x, None if math.isnan(a[y, x]) else float(a[y, x]), bool(wet[y, x]) if wet is not None else True) for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, "iz int, iy int, ix int, value double, wet boolean")


def array(df, shape=(NY, NX)):
    out = np.full(shape, np.nan)
    for r in df.select("iy", "ix", "value").collect():
        out[r.iy, r.ix] = np.nan if r.value is None else r.value
    return out


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(NY, NX))
    wet = rng.random((NY, NX)) < 0.8
    gaps = rng.random((NY, NX)) < 0.5
    gaps[2:9, 3:12] = True
    return np.where(gaps | ~wet, np.nan, a), wet


def donors(a, wet, y, x, steps):
    return [(max(abs(j - y), abs(i - x)), (j - y) ** 2 + (i - x) ** 2, j - y, i - x, a[j, i]) for j in range(NY) for i in range(NX) if wet[j, i] and not np.isnan(a[j, i]) and max(abs(j - y), abs(i - x)) <= steps]


@pytest.mark.parametrize("first_steps", [1, 12])
def test_coastal_fill_nearest(spark, sample, first_steps):
    a, wet = sample
    want = a.copy()
    for y, x in zip(*np.where(wet & np.isnan(a)), strict=True):
        near = sorted(donors(a, wet, y, x, 5))
        want[y, x] = near[0][-1] if near else np.nan
    got = fill.coastal_fill(field(spark, a, wet), ["iz"], "nearest", max_steps=5, first_steps=first_steps)
    np.testing.assert_array_equal(array(got), want)


@pytest.mark.parametrize("first_steps", [1, 12])
def test_coastal_fill_distance_weighted(spark, sample, first_steps):
    a, wet = sample
    want = a.copy()
    for y, x in zip(*np.where(wet & np.isnan(a)), strict=True):
        near = donors(a, wet, y, x, 5)
        radii = sorted({d[0] for d in near})
        pick = next((r for r in radii if sum(d[0] <= r for d in near) >= 4), radii[0] if radii else None)
        used = [d for d in near if pick is not None and d[0] <= pick]
        want[y, x] = sum(d[-1] / d[1] for d in used) / sum(1 / d[1] for d in used) if used else np.nan
    got = fill.coastal_fill(field(spark, a, wet), ["iz"], max_steps=5, first_steps=first_steps)
    np.testing.assert_allclose(array(got), want, rtol=1e-12)
    assert got.where("filled AND NOT wet").count() == 0
    with pytest.raises(ValueError):
        fill.coastal_fill(field(spark, a, wet), ["iz"], "other")


@pytest.mark.parametrize("tile", [4, 64])
def test_force_complete_equals_one_queue(spark, sample, tile):
    a, wet = sample
    want, queue, queued = a.copy(), [], set()
    around = [(j, i) for j in (-1, 0, 1) for i in (-1, 0, 1) if i or j]
    inside = lambda y, x: 0 <= y < NY and 0 <= x < NX
    finite = lambda y, x: inside(y, x) and wet[y, x] and not np.isnan(want[y, x])
    for y in range(NY):
        for x in range(NX):
            if wet[y, x] and np.isnan(a[y, x]) and any(finite(y + j, x + i) for j, i in around):
                queue.append((y, x))
                queued.add((y, x))
    while queue:
        y, x = queue.pop(0)
        want[y, x] = np.mean([want[y + j, x + i] for j, i in around if finite(y + j, x + i)])
        for j, i in around:
            c = (y + j, x + i)
            if inside(*c) and wet[c] and np.isnan(want[c]) and c not in queued:
                queue.append(c)
                queued.add(c)
    got = fill.force_complete(field(spark, a, wet), ["iz"], checkpointed, tile)
    np.testing.assert_allclose(array(got), want, rtol=1e-12)


def test_nearest_any_donor_reaches_dry_cells_and_far_ones(spark):
    a = np.full((NY, NX), np.nan)
    a[0, 0], a[11, 16] = 1.0, 2.0
    wet = np.zeros((NY, NX), bool)
    wet[5, 5] = wet[11, 15] = True
    got = array(fill.nearest_any_donor(field(spark, a, wet), ["iz"], tiles=(8, 2)))
    assert got[5, 5] == 1.0 and got[11, 15] == 2.0 and np.isnan(got[4, 4])


def test_fill_fallback_and_report(spark, sample):
    a, wet = sample
    done = fill.fill_fallback(field(spark, a, wet), 7.0)
    r = fill.fill_report(done, ["iz"], ["fallback"]).first()
    assert r.remaining == 0 and r.n_fallback == (wet & np.isnan(a)).sum() and r.wet_cells == wet.sum()


@given(st.lists(st.one_of(st.none(), st.floats(-5, 5)), min_size=1, max_size=8))
@settings(max_examples=15, deadline=None)
def test_fill_top_only_fills_the_leading_gap(spark, column):
    rows = [(0, 0, z, v) for z, v in enumerate(column)]
    cells = spark.createDataFrame(rows, "iy int, ix int, iz int, value double")
    once = columns.fill_top(cells, ["iy", "ix"]).drop("filled_top")
    got = [r.value for r in once.orderBy("iz").collect()]
    first = next((i for i, v in enumerate(column) if v is not None), None)
    assert got == (column if first is None else [column[first]] * first + column[first:])
    assert [r.value for r in columns.fill_top(once, ["iy", "ix"]).orderBy("iz").collect()] == got


def test_fill_top_leaves_flat_data_alone(spark):
    cells = spark.createDataFrame([(0, 0, None, None), (0, 0, None, 1.0)], "iy int, ix int, iz int, value double")
    assert columns.fill_top(cells, ["iy", "ix"]).where("filled_top").count() == 0


def test_replace_top(spark):
    cells = spark.createDataFrame([(0, 0, z, float(z) if z != 4 else 40.0) for z in range(6)], "iy int, ix int, iz int, value double")
    assert [r.value for r in columns.replace_top(cells, ["iy", "ix"]).orderBy("iz").collect()] == [40.0] * 5 + [5.0]


def test_layer_bounds(spark):
    levels = spark.createDataFrame([("a", 0, 5.0), ("a", 1, 15.0), ("a", 2, 35.0), ("one", 0, 10.0)], "axis_id string, iz int, depth double")
    got = {(r.axis_id, r.iz): (r.lower, r.upper) for r in columns.layer_bounds(levels).collect()}
    assert got == {("a", 0): (0.0, 10.0), ("a", 1): (10.0, 25.0), ("a", 2): (25.0, 45.0), ("one", 0): (5.0, 15.0)}
    given_ = levels.withColumns({"lower": F.lit(9.0), "upper": F.lit(2.0)})
    assert {(r.lower, r.upper, r.bounds_source) for r in columns.layer_bounds(given_).collect()} == {(2.0, 9.0, "bounds")}
    with pytest.raises(PySparkException):
        columns.layer_bounds(levels.withColumns({"lower": F.lit(2.0), "upper": F.lit(2.0)})).collect()


def test_depth_bins_weigh_whole_layers_by_their_centre(spark):
    layers = spark.createDataFrame([(0, 10.0, 20.0), (1, 24.0, 10.0), (2, 25.0, 4.0)], "iz int, depth double, thickness double")
    bins = spark.createDataFrame([("a", 0.0, 25.0), ("b", 25.0, 50.0), ("c", 50.0, 99.0)], "label string, lower double, upper double")
    cells = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, 4.0), (0, 0, 2, 7.0), (0, 1, 0, None), (0, 1, 1, 4.0), (0, 2, 0, None)], "iy int, ix int, iz int, value double")
    got = {(r.ix, r.label): r.value for r in columns.depth_bins(cells, layers, bins, ["iy", "ix"]).collect()}
    assert got == {(0, "a"): 2.0, (0, "b"): 7.0, (1, "a"): 4.0, (2, "a"): None}


def test_vertical_interpolation(spark):
    source = spark.createDataFrame([(0, 0.0), (1, 10.0), (2, 30.0)], "iz int, depth double")
    target = spark.createDataFrame(list(enumerate((-1.0, 0.0, 4.0, 25.0, 30.0, 31.0))), "iz int, depth double")
    w = columns.vertical_weights(source, target)
    assert {r.iz_out: r.s for r in w.groupBy("iz_out").agg(F.sum("w").alias("s")).collect()} == {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0}
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, None), (0, 2, 5.0)], "ix int, iz int, value double")
    got = {r.iz: r.value for r in columns.vertical_interp(cells, w, ["ix"]).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 5.0, 4: 5.0}
    deep = columns.vertical_weights(source.withColumn("depth", F.col("depth") * 100), target, 0.01)
    assert deep.count() == w.count()


def test_axis_spacing(spark):
    points = spark.createDataFrame([("even", 0.0), ("even", 0.1), ("even", 0.2), ("odd", 0.0), ("odd", 1.0), ("odd", 3.0)], "axis string, lon double")
    assert {r.axis: r.is_even for r in columns.axis_spacing(points, ["axis"], "lon").collect()} == {"even": True, "odd": False}
    with pytest.raises(PySparkException):
        columns.axis_spacing(points.limit(1), ["axis"], "lon").collect()


def test_bilinear_wraps_and_misses_with_a_missing_corner(spark):
    grid = remap.Grid(8, 5, -180.0, 45.0, -80.0, 40.0)
    a = np.random.default_rng(1).normal(size=(5, 8))
    a[2, 3] = np.nan
    target = remap.Grid(9, 4, -170.0, 40.0, -70.0, 40.0)
    w = remap.bilinear_weights(spark, grid, target.cells(spark))
    assert all(abs(r.s - 1) < 1e-12 for r in w.groupBy("dst_iy", "dst_ix").agg(F.sum("w").alias("s")).collect())
    got = array(remap.apply_weights(field(spark, a), w, ["iz"], "all"), (4, 9))
    for y in range(4):
        for x in range(9):
            fy, fx_ = (-70 + 40 * y + 80) / 40, ((-170 + 40 * x + 180) / 45) % 8
            j, i, t, s = int(fy), int(fx_), fy % 1, fx_ % 1
            want = sum(p * q * a[j + dj, (i + di) % 8] for dj, p in ((0, 1 - t), (1, t)) if p for di, q in ((0, 1 - s), (1, s)) if q)
            assert (np.isnan(want) and np.isnan(got[y, x])) or abs(want - got[y, x]) < 1e-12


def test_distance_weights_equal_brute_force_near_the_pole_and_date_line(spark):
    source = remap.Grid(36, 17, -180.0, 10.0, -80.0, 10.0)
    points = [(0, 0, 89.0, 3.0), (0, 1, -86.0, 170.0), (0, 2, 3.0, 179.9), (0, 3, 20.0, 40.0)]
    target = spark.createDataFrame(points, "iy int, ix int, lat double, lon double")
    got = {(r.dst_ix, r.src_iy, r.src_ix): r.w for r in remap.distance_weights(source.cells(spark), target, tile=40.0).collect()}
    unit = lambda lat, lon: np.array([math.cos(math.radians(lat)) * math.cos(math.radians(lon)), math.cos(math.radians(lat)) * math.sin(math.radians(lon)), math.sin(math.radians(lat))])
    for _, ix, lat, lon in points:
        every = sorted((round(float(np.linalg.norm(unit(lat, lon) - unit(-80 + 10 * y, -180 + 10 * x))), 12), y, x) for y in range(17) for x in range(36))[:4]
        own = {(k[1], k[2]): w for k, w in got.items() if k[0] == ix}
        assert own.keys() == ({(every[0][1], every[0][2])} if every[0][0] == 0 else {(y, x) for _, y, x in every})
    cells = spark.createDataFrame([(0, y, x, 2.0 if y % 2 else None) for y in range(17) for x in range(36)], "iz int, iy int, ix int, value double")
    out = remap.apply_weights(cells, remap.distance_weights(source.cells(spark), target, tile=40.0), ["iz"], "renormalise")
    assert {r.value for r in out.collect()} <= {2.0, None}


def test_change_and_application_are_inverse(spark):
    rows = [(0, i, float(i + 1)) for i in range(5)]
    base = spark.createDataFrame(rows, "iy int, ix int, value double")
    future = base.withColumn("value", F.when(F.col("ix") != 3, F.col("value") * 2 + 1))
    for mode in ("additive", "log_ratio"):
        out = climate.apply_delta(base, climate.change_field(future, base, ["iy", "ix"], mode), ["iy", "ix"], mode)
        for r in out.collect():
            assert r.value is None if r.ix == 3 else abs(r.value - (2 * (r.ix + 1) + 1)) < 1e-12
    zero = base.withColumn("value", F.lit(0.0))
    assert {r.value for r in climate.change_field(future, zero, ["iy", "ix"], "log_ratio").collect()} == {None}
    assert climate.validity(climate.change_field(future, base, ["iy", "ix"]), ["iy"]).first()[1:] == (4, 1)


def test_windows_overlap_and_hold_whole_days(spark):
    w = spark.createDataFrame([("a", datetime.date(2000, 1, 1), datetime.date(2000, 12, 31)), ("b", datetime.date(2000, 6, 1), datetime.date(2000, 12, 31))], "window string, start date, end date")
    cells = spark.createDataFrame([(0, datetime.datetime(2000, 12, 31, 23, 0), 4.0), (0, datetime.datetime(2000, 1, 1), 2.0), (0, datetime.datetime(2001, 1, 1), 9.0), (0, datetime.datetime(2000, 7, 1), None)], "ix int, time timestamp, value double")
    assert {r.window: r.value for r in climate.climatology(cells, w, ["ix"]).collect()} == {"a": 3.0, "b": 4.0}


def test_clamp_keeps_missing_values(spark):
    cells = spark.createDataFrame([("siconc", 1.5), ("siconc", None), ("mlotst", -1.0), ("mlotst", 9.0), ("thetao", -9.0)], "variable string, value double")
    got = [(r.value, r.clipped) for r in climate.clamp(cells, schema.OUTPUT_BOUNDS).collect()]
    assert got == [(1.0, "above"), (None, None), (0.0, "below"), (9.0, None), (-9.0, None)]


def test_ingest_has_no_nan(spark, tmp_path):
    rows = [("thetao", float("nan")), ("thetao", float("inf")), ("thetao", 1.0), ("so", 2.0)]
    spark.createDataFrame(rows, "variable string, value double").write.partitionBy("variable").parquet(str(tmp_path / "cells"))
    cells = schema.read_cells(spark, str(tmp_path / "cells"), "thetao")
    assert cells.agg(F.avg("value")).first()[0] == 1.0 and cells.count() == 3


def test_masks(spark):
    base = spark.createDataFrame([(0, 0, 0, None), (1, 0, 0, 1.0), (0, 0, 1, None)], "iz int, iy int, ix int, value double")
    mask = spark.createDataFrame([(0, 0, 5.0), (0, 0, None), (0, 1, None)], "iy int, ix int, value double")
    assert {(r.iz, r.ix): r.wet for r in fill.wet_mask(base, mask).collect()} == {(0, 0): True, (1, 0): True, (0, 1): False}
    assert fill.wet_mask(base, None).where("wet").count() == 1
    with pytest.raises(PySparkException):
        fill.mask_any_depth(mask, strict=True).collect()


def test_downscale_for_every_member_and_coast(spark, sample):
    a, wet = sample
    base = field(spark, np.where(wet, 10.0, np.nan)).drop("wet").withColumns({"variable": F.lit("thetao"), "depth": F.lit(0.5), "lat": F.lit(0.0), "lon": F.lit(0.0)})
    change = field(spark, a).drop("wet").withColumns({"variable": F.lit("thetao"), "member": F.explode(F.array(F.lit("r1"), F.lit("r2")))})
    out = downscale(base, change, members=["member"], max_steps=2, complete=True, fallback=0.0, scale=2.0).collect()
    assert len(out) == 2 * NY * NX
    for r in out:
        assert (r.value is None) == (not wet[r.iy, r.ix])
        if wet[r.iy, r.ix] and not np.isnan(a[r.iy, r.ix]):
            assert abs(r.value - (10 + 2 * a[r.iy, r.ix])) < 1e-12 and r.fill_kind is None
    done = coast_baseline(base.withColumn("value", F.when(F.expr("(ix + iy) % 3 = 0"), F.col("value"))), field(spark, np.where(wet, 1.0, np.nan)).where("value IS NOT NULL"), max_steps=1)
    assert done.where("wet AND value IS NULL").count() == 0


# ------------------------------------------------------------------------------------- names, tables, manifests


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(("units", "want"), [(" mol m-3", "molm-3"), ("kg/m3", "kgperm3"), ("", "unitless"), (None, "unitless"), ("%", "unitless"), ("1e-3", "1e-3")])
def test_sanitize_units(spark, units, want):
    assert one(spark, fx.sanitize_units, units) == want


@pytest.mark.parametrize(("depth", "want"), [(5.079, "0005p079m"), (0.494, "0000p494m"), (1245.291, "1245p291m"), (None, None)])
def test_depth_token(spark, depth, want):
    assert one(spark, fx.depth_token, depth, "double") == want


@pytest.mark.parametrize(("name", "want"), [("a_200601-201412.nc", ("2006-01-01", "2014-12-31")), ("a_2006-2014.nc", ("2006-01-01", "2014-12-31")), ("a_200601-201502.nc", ("2006-01-01", "2015-02-28")), ("a.nc", (None, None)), ("a_200613-201402.nc", (None, "2014-02-28"))])
def test_time_range(spark, name, want):
    got = [one(spark, lambda c, i=i: fx.time_range(c)[i], name) for i in (0, 1)]
    assert tuple(g and g.isoformat() for g in got) == want


@pytest.mark.parametrize(("name", "want"), [("x.007.pop.h.nc", "007"), ("b.f09_g16.012.cam", "012"), ("x", "unknown_member")])
def test_cesm_member(spark, name, want):
    assert one(spark, fx.cesm_member, name) == want


def test_depth_is_null_for_flat_products(spark):
    none = F.lit(None)
    assert one(spark, lambda c: fx.depth_label(c, none.cast("string"), none.cast("double"), none.cast("double"), none.cast("double")), "zos.nc") is None


def test_encoding_round_trip_and_promotion(spark):
    cells = spark.createDataFrame([("a", 0.125), ("a", -1.5), ("a", None), ("b", 400.0), ("b", 0.005)], "variable string, value double")
    coded = products.encode_integer(cells, ["variable"], F.lit(100))
    got = {(r.variable, r.value): (r.stored_value, r.encoded_dtype) for r in coded.collect()}
    assert got == {("a", 0.125): (12, "int16"), ("a", -1.5): (-150, "int16"), ("a", None): (-32768, "int16"), ("b", 400.0): (40000, "int32"), ("b", 0.005): (0, "int32")}
    assert coded.select(products.decoded(F.col("stored_value"), F.col("nodata"), F.lit(100)).alias("v")).where("v IS NULL").count() == 1
    with pytest.raises(PySparkException):
        products.encode_integer(cells.withColumn("value", F.lit(1e9)), ["variable"], F.lit(100)).collect()


def test_split_refuses_equal_tokens(spark):
    cells = spark.createDataFrame([("v", 0, 1.0001, 1.0), ("v", 1, 1.0002, 1.0)], "variable string, iz int, depth double, value double")
    with pytest.raises(PySparkException):
        products.split_by_depth(cells, ["variable"]).collect()
    assert products.split_by_depth(cells.withColumns({"depth": F.lit(None).cast("double"), "iz": F.lit(None).cast("int")}), ["variable"]).count() == 2


def test_write_and_skip(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "variable string, v double")
    at = str(tmp_path / "out")
    products.write_export(table, at, ["variable"])
    products.write_export(table.where("variable = 'a'").withColumn("v", F.lit(9.0)), at, ["variable"], overwrite=True)
    done = spark.read.parquet(at)
    assert {r.variable: r.v for r in done.collect()} == {"a": 9.0, "b": 2.0}
    wanted = spark.createDataFrame([("b",), ("c",)], "variable string")
    assert [r.variable for r in products.not_done(wanted, done, ["variable"]).collect()] == ["c"]
    assert products.not_done(wanted, done, ["variable"], overwrite=True).count() == 2


def test_members_sort_as_numbers_for_discovery(spark):
    files = spark.createDataFrame([("m", "historical", "so", f"r{r}i1p1f1") for r in (10, 2, 3)] + [("m", "historical", "so", "odd")], "source_id string, experiment_id string, variable_id string, member_id string")
    got = {r.member_id: r.is_first_available_member for r in manifest.flag_first_member(files).collect()}
    assert got == {"r10i1p1f1": False, "r2i1p1f1": True, "r3i1p1f1": False, "odd": False}


def test_resolve_member(spark):
    groups = spark.createDataFrame([("a", "r1i1p1f1"), ("b", "r1i1p1f1"), ("b", "r2i1p1f1")], "model string, member string")
    assert {r.model: r.member for r in manifest.resolve_member(groups, ["model"], "r1i1p1f1").collect()} == {"a": "r1i1p1f1", "b": "r1i1p1f1"}
    with pytest.raises(PySparkException):
        manifest.resolve_member(groups, ["model"]).collect()
    with pytest.raises(PySparkException):
        manifest.resolve_member(groups, ["model"], "r2i1p1f1").collect()


def test_full_coverage_is_a_hundred_checks(spark):
    w = spark.createDataFrame([("historical" if n == 0 else "future", x, datetime.date.fromisoformat(a), datetime.date.fromisoformat(b)) for n, (x, a, b) in enumerate(schema.WINDOWS)], "experiment_group string, window string, start date, end date")
    e = spark.createDataFrame([(x,) for x in schema.EXPERIMENTS], "experiment_id string")
    v = spark.createDataFrame([(x,) for x in schema.VARIABLES], "variable_id string")
    files = e.crossJoin(v).withColumns({"source_id": F.lit("m"), "member_id": F.lit("r1i1p1f1"), "is_first_available_member": F.lit(True), "time_start": F.lit("1990-01-01").cast("date"), "time_end": F.lit("2100-12-31").cast("date")})
    r = manifest.coverage_summary(manifest.coverage_checks(files, w, e, v)).first()
    assert (r.covered_checks, r.total_checks, r.coverage_fraction) == (100, 100, 1.0)


def test_equal_oxygen_units_need_no_factor(spark):
    row = spark.createDataFrame([("mmol m-3", "mmol m-3"), ("mol m-3", "mmol m-3"), ("mmol m-3", "mol m-3")], "s string, b string")
    got = [r[0] for r in row.select(audit.variable_scale(F.lit("o2"), F.col("s"), F.lit(1.0), F.col("b"), F.lit(1.0))).collect()]
    assert got == ["1", "1000", "0.001"]


def test_velocity_is_converted_for_its_one_series(spark):
    rows = [("future", "rcp85", "cesm_f09_g16", "uo", "x/UVEL/y"), ("future", "rcp85", "cesm_f09_g16", "uo", "x/uo/y"), ("baseline", "rcp85", "cesm_f09_g16", "uo", "x/UVEL/y")]
    df = spark.createDataFrame(rows, "p string, s string, m string, v string, path string")
    got = [r[0] for r in df.select(fx.converted_velocity(F.lit(50.0), *[F.col(c) for c in ("p", "s", "m", "v", "path")])[0]).collect()]
    assert got == [0.5, 50.0, 50.0]


def test_raster_rows_run_from_north(spark):
    cells = spark.createDataFrame([("d", lat, lon) for lat in (-1.0, 0.0, 1.0) for lon in (5.0, 6.0)], "d string, lat double, lon double")
    r = remap.raster_transform(cells, ["d"]).first()
    assert (r.width, r.height, r.x_origin, r.y_origin, r.y_step) == (2, 3, 4.5, 1.5, -1.0)
    assert {(x.lat, x.lon): (x.row, x.col) for x in remap.raster_position(cells, ["d"]).collect()}[1.0, 6.0] == (0, 1)
