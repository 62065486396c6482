"""Composite jobs' parts: pairing, step detection, specs, quoted CSV, and the searches that widen."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pelagia.operators import climate, fill, products, remap
from pelagia.schema import filled_template, spec


def test_pairing_statuses(spark):
    future = spark.createDataFrame([("A", "r1"), ("A", "r2"), ("B", "r1"), ("C", "r1")], "model string, member string")
    base = spark.createDataFrame([("A", "r1"), ("C", "r1")], "model string, member string")
    windows = spark.createDataFrame([("A", "w", 3), ("B", "w", 1), ("C", "w", 0)], "model string, window string, n_files int")
    got = {(r.model, r.member): r.status for r in climate.paired(future, base, ["model"], windows).collect()}
    assert got == {("A", "r1"): "ok", ("A", "r2"): "member_mismatch", ("B", "r1"): "no_baseline", ("C", "r1"): "no_file"}


def test_daily_and_monthly_series(spark):
    days = spark.range(59).select(F.lit("d").alias("v"), F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("time"), F.col("id").cast("double").alias("value"))
    months = spark.createDataFrame([("m", "2001-01-15", 1.0), ("m", "2001-02-15", 3.0)], "v string, time string, value double").withColumn("time", F.to_date("time"))
    got = {(r.v, r.time.month): (r.value, r.source_step) for r in climate.as_monthly(days.unionByName(months), ["v"]).collect()}
    assert got == {("d", 1): (15.0, "daily"), ("d", 2): (44.5, "daily"), ("m", 1): (1.0, "monthly"), ("m", 2): (3.0, "monthly")}
    with pytest.raises(PySparkException, match="neither daily nor monthly"):
        climate.as_monthly(days.where("value < 9"), ["v"]).collect()


def test_window_means_side_by_side(spark):
    cells = spark.createDataFrame([(1, "2001-01-01", 2.0), (1, "2002-01-01", 4.0), (1, "2003-01-01", None), (2, "2003-01-01", 5.0)], "ix int, time string, value double")
    got = {r.ix: r for r in climate.window_means(cells, [("a", "2001-01-01", "2002-12-31"), ("b", "2002-01-01", "2003-12-31")], ["ix"]).collect()}
    assert (got[1].a, got[1].a_rows, got[1].b, got[1].b_rows) == (3.0, 2, 4.0, 2) and (got[2].a, got[2].a_rows, got[2].b) == (None, 0, 5.0)


def test_specs_and_templates(spark):
    assert spec("TEMP:thetao, SALT:so  ph") == {"TEMP": "thetao", "SALT": "so", "ph": "ph"}
    for bad in ("a:b a:c", ":x", "a:b:c"):
        with pytest.raises(ValueError):
            spec(bad)
    row = spark.createDataFrame([("m", "v")], "model string, var string")
    assert row.select(filled_template("/x/{model}/{var}.nc", model=F.col("model"), var=F.col("var"))).first()[0] == "/x/m/v.nc"
    with pytest.raises(KeyError):
        filled_template("{other}")


def test_csv_is_quoted_and_on_one_line(spark, tmp_path):
    table = spark.createDataFrame([("p", "a\nb", 1.5)], "product string, note string, value double")
    products.write_export(table, str(tmp_path / "out"), ["product"], "csv")
    (file,) = (tmp_path / "out" / "product=p").glob("*.csv")
    assert file.read_text().splitlines() == ['"note","value"', '"a b","1.5"']


def test_numbering_is_one_to_n(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = {r.k: r.n for r in products.numbered(rows.repartition(7), "k", "n").collect()}
    assert got == {k: k + 1 for k in range(1000)}


def test_nearest_donor_by_tiles_is_the_nearest(spark):
    rng = np.random.default_rng(1)
    donors = {(int(y), int(x)) for y, x in zip(rng.integers(0, 90, 12), rng.integers(0, 140, 12), strict=True)}
    asks = {(int(y), int(x)) for y, x in zip(rng.integers(0, 90, 40), rng.integers(0, 140, 40), strict=True)} - donors
    rows = [(0, y, x, float(1000 * y + x), True) for y, x in donors] + [(0, y, x, None, True) for y, x in asks]
    cells = spark.createDataFrame(rows, "iz int, iy int, ix int, value double, wet boolean")
    want = {(y, x): (lambda d: float(1000 * d[0] + d[1]))(min(donors, key=lambda d: ((d[0] - y) ** 2 + (d[1] - x) ** 2, d))) for y, x in asks}
    for tiles in ((32, 4), (512, 32), (16,)):
        assert {(r.iy, r.ix): r.value for r in fill.nearest_any_donor(cells, ["iz"], tiles).where("nearest").collect()} == want
    empty = cells.where("value IS NULL")
    assert fill.nearest_any_donor(empty, ["iz"], strict=False).where("value IS NULL").count() == len(asks)
    with pytest.raises(PySparkException, match="no finite cell"):
        fill.nearest_any_donor(empty, ["iz"]).collect()


def test_distance_weights_widen_their_boxes(spark):
    source = spark.createDataFrame([(0, i, float(la), float(lo)) for i, (la, lo) in enumerate([(0, 0), (0, 3), (40, 10), (-60, 120), (80, -90), (5, 170)])], "iy int, ix int, lat double, lon double")
    target = spark.createDataFrame([(0, 0, 1.0, 1.0), (0, 1, -5.0, -178.0), (1, 0, 89.0, 10.0)], "iy int, ix int, lat double, lon double")
    narrow, wide = ({(r.dst_iy, r.dst_ix, r.src_ix): r.w for r in remap.distance_weights(source, target, tile, 4).collect()} for tile in (2.0, 400.0))
    assert len(wide) == 12 and narrow.keys() == wide.keys() and all(abs(narrow[k] - w) < 1e-9 for k, w in wide.items())


def on_sphere(lat, lon):
    a, b = math.radians(lat), math.radians(lon)
    return np.array([math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)])


def test_distance_weights_over_a_hole(spark):
    """A hole of 60 degrees: the nearest of every target are those of brute force, and few sources are looked at."""
    grid = remap.Grid(72, 37, -180.0, 5.0, -90.0, 5.0)
    middle = on_sphere(10, 20)
    rows = [r for r in grid.cells(spark).collect() if np.dot(on_sphere(r.lat, r.lon), middle) < math.cos(math.radians(30))]
    source = spark.createDataFrame(rows, "iy int, ix int, lat double, lon double")
    target = remap.Grid(25, 17, -10.0, 2.5, -15.0, 3.0).cells(spark).unionByName(spark.createDataFrame([(99, 0, 90.0, 0.0), (99, 1, -44.0, 179.9), (99, 2, 5.0, -180.0)], "iy int, ix int, lat double, lon double"))
    points = np.array([on_sphere(r.lat, r.lon) for r in rows])
    got = {}
    for r in remap.distance_weights(source, target, 8.0).collect():
        got.setdefault((r.dst_iy, r.dst_ix), {})[r.src_iy, r.src_ix] = r.w
    for t in target.collect():
        d = np.linalg.norm(points - on_sphere(t.lat, t.lon), axis=1)
        order = sorted(range(len(rows)), key=lambda i: (round(float(d[i]), 12), rows[i].iy, rows[i].ix))[:4]
        own = got[t.iy, t.ix]
        if d[order[0]] < 1e-12:
            assert list(own) == [(rows[order[0]].iy, rows[order[0]].ix)]
        else:
            assert own.keys() == {(rows[i].iy, rows[i].ix) for i in order} and all(abs(own[rows[i].iy, rows[i].ix] * d[i] - 1) < 1e-9 for i in order)
    looked = remap.nearest_candidates(source, target, 8.0, 4).groupBy("dst_iy", "dst_ix").count().selectExpr("max(count) AS most", "avg(count) AS mean").first()
    assert looked.most < len(rows) / 4 and looked.mean < len(rows) / 15


def test_bucketed_weights_meet_fields_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source, target = remap.Grid(24, 16, -180.0, 15.0, -75.0, 10.0), remap.Grid(46, 29, -176.3, 7.7, -72.4, 5.1)
        cells = source.cells(spark).crossJoin(spark.range(3).selectExpr("CAST(id AS INT) AS iz")).withColumn("value", F.sin(F.col("iy") * 3.0 + F.col("ix") + F.col("iz")))
        weights = remap.bilinear_weights(spark, source, target.cells(spark))
        out = remap.apply_weights(remap.bucketed_field(cells, 3), remap.bucketed_weights(weights, 3), ["iz"], "all")
        plan = out._jdf.queryExecution().sparkPlan().toString()
        executed = out._jdf.queryExecution().executedPlan().toString()
        below = executed[executed.index("SortMergeJoin") :]
        assert "SortMergeJoin" in plan and "Exchange" not in below and below.count("Bucketed: true") == 2
        want = {(r.iz, r.iy, r.ix): r.value for r in remap.apply_weights(cells, weights, ["iz"], "all").collect()}
        got = {(r.iz, r.iy, r.ix): r.value for r in out.collect()}
        assert got.keys() == want.keys() and all(v is None and got[k] is None or abs(v - got[k]) < 1e-12 for k, v in want.items())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_series_come_first_also_without_levels(spark):
    rows = [("a", None, 0, 1), ("a", None, 1, 2), ("a", 3, 1, 3), ("b", 3, 1, 4), (None, None, 1, 5), (None, None, 0, 6)]
    series = spark.createDataFrame(rows, "model string, iz int, rank int, value int")
    assert sorted(r.value for r in climate.prefer_whole(series, ["model", "iz"], F.col("rank")).collect()) == [1, 3, 4, 6]


def test_raster_positions_of_two_datasets(spark):
    rows = [(k, float(la), float(lo)) for k, step in (("a", 1), ("b", 3)) for la in range(-6, 7, step) for lo in range(0, 10, step)]
    got = {(r.k, r.lat, r.lon): (r.row, r.col) for r in remap.raster_position(spark.createDataFrame(rows, "k string, lat double, lon double"), ["k"]).collect()}
    assert got == {(k, la, lo): (int((6 - la) // step), int(lo // step)) for k, la, lo in rows for step in [1 if k == "a" else 3]}
