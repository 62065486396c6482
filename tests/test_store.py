"""Stored cells, files, manifests and commits: what is pruned, what is told apart, what survives a run that dies."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pelagia.operators import climate, columns
from pelagia.operators.manifest import verify_checksums
from pelagia.operators.products import write_export
from pelagia.plans import jobs
from pelagia.sources import store


def series(spark):
    return spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 'so' ELSE 'uo' END AS variable", "make_date(1995 + CAST(id % 7 AS INT), 3, 1) AS time", "CAST(id % 3 AS INT) AS iz", "CAST(id % 130 AS INT) AS iy", "CAST(id % 90 AS INT) AS ix", "CASE WHEN id = 8 THEN double('NaN') ELSE double(id) END AS value")


def test_a_small_table_prunes_the_folders_that_are_read(spark, tmp_path):
    cells = series(spark)
    store.write_cells(cells, f"{tmp_path}/cells")
    windows = spark.createDataFrame([("a", "1995-06-01", "1996-01-01"), ("b", "1999-01-01", "2001-12-31")], "window string, start string, end string").withColumns({c: F.to_date(c) for c in ("start", "end")})
    store.calendar(windows).write.parquet(f"{tmp_path}/years")
    years = spark.read.parquet(f"{tmp_path}/years").where("window = 'a'")
    got = store.read_window_years(spark, f"{tmp_path}/cells", "so", years)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plans cut long filters otherwise
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.split("\n") if "PartitionFilters" in line and "cells" in line)
    assert "dynamicpruningexpression" in scan and "(variable" in scan.split("PartitionFilters")[1].split("]")[0]
    want = cells.where("variable = 'so' AND year(time) IN (1995, 1996)")
    assert got.count() == want.count() and got.where("value IS NULL").count() == 1
    assert got.agg(F.sum("value")).first()[0] == want.where("NOT isnan(value)").agg(F.sum("value")).first()[0]
    store.write_cells(cells.where("variable = 'uo' AND year(time) = 1995").limit(3), f"{tmp_path}/cells", mode="overwrite")
    assert spark.read.parquet(f"{tmp_path}/cells").count() == cells.where("NOT (variable = 'uo' AND year(time) = 1995)").count() + 3


def test_files_tell_their_step_and_their_digests(spark, tmp_path):
    days = [(y, m, d) for y, m, n in ((2006, 1, 31), (2006, 2, 1), (2006, 3, 2)) for d in range(1, n + 1)]
    for y, m, d in days:
        at = tmp_path / f"in/so/{y}/{m:02d}"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"so_{y}{m:02d}{d:02d}.nc").write_bytes(b"x" * d)
    (tmp_path / "in/so/2006/01/notes.txt").write_text("not a field")
    files = store.list_files(spark, f"{tmp_path}/in", "*.nc")
    assert "content" not in files.columns and files.count() == len(days)
    dated = files.selectExpr("split(path, '/')[0] AS variable", "int(split(path, '/')[1]) AS year", "int(split(path, '/')[2]) AS month", "name")
    steps = store.month_steps(dated, ["variable"])
    assert {(r.month.month, r.n_files): r.source_step for r in steps.collect()} == {(1, 31): "daily", (2, 1): "monthly", (3, 2): "daily"}
    assert {r.source_step for r in store.month_steps(dated, ["variable"], "daily").collect()} == {"daily"}
    with pytest.raises(PySparkException, match="several files"):
        store.month_steps(dated, ["variable"], "monthly").collect()
    with pytest.raises(ValueError):
        store.month_steps(dated, ["variable"], "hourly")
    # Cells follow what their files say: a month of one day in a daily series is monthly there, and two times in it are an error.
    cells = spark.createDataFrame([("so", datetime.datetime(y, m, d), 0, 0, float(d)) for y, m, d in days], "variable string, time timestamp, iy int, ix int, value double")
    monthly = {r.time.month: (r.value, r.source_step) for r in climate.as_monthly(cells, ["variable"], steps).collect()}
    assert monthly == {1: (16.0, "daily"), 2: (1.0, "monthly"), 3: (1.5, "daily")}
    assert {r.source_step for r in climate.as_monthly(cells, ["variable"], step="daily").collect()} == {"daily"}
    with pytest.raises(PySparkException, match="several times"):
        climate.as_monthly(cells, ["variable"], step="monthly").collect()
    with pytest.raises(PySparkException, match="no files"):
        climate.as_monthly(cells, ["variable"], steps.where("month(month) < 3")).collect()
    # Digests are of the stored bytes.
    manifest = files.select(F.col("name").alias("filename"), F.lit("sha256").alias("checksum_type"), F.sha2(F.expr("repeat('x', int(substring(name, 10, 2)))"), 256).alias("checksum"))
    manifest = manifest.withColumn("checksum", F.when(F.col("filename") == "so_20060301.nc", "00").otherwise(F.upper("checksum"))).unionByName(spark.createDataFrame([("gone.nc", "md5", "0")], manifest.schema))
    stored = store.list_files(spark, f"{tmp_path}/in", "*.nc", content=True).withColumnRenamed("name", "filename")
    assert {r.status: r["count"] for r in verify_checksums(stored, manifest).groupBy("status").count().collect()} == {"ok": 33, "mismatch": 1, "missing": 1}


def test_manifests_come_back_as_they_were_written_and_bad_rows_are_told(spark, tmp_path):
    rows = [("a", 'he said "x, y"', 3), ("b", "two\nlines", None), ("c", None, 5), ("d", "é;,", 7)]
    write_export(spark.createDataFrame(rows, "key string, note string, n int").withColumn("kind", F.lit("k")), f"{tmp_path}/csv", ["kind"], "csv")
    good, bad = store.read_manifest(spark, f"{tmp_path}/csv/kind=k", "key string, note string, n int")
    assert sorted(map(tuple, good.collect())) == [("a", 'he said "x, y"', 3), ("b", "two lines", None), ("c", None, 5), ("d", "é;,", 7)] and bad.count() == 0
    (tmp_path / "bad.csv").write_text('key,note,n\n"a","one\nand ""two""",1\nb,few\nc,x,many\nd,e,4,5\ne,,6\n')
    good, bad = store.read_manifest(spark, f"{tmp_path}/bad.csv", "key string, note string, n int")
    assert sorted(map(tuple, good.collect())) == [("a", 'one\nand "two"', 1), ("e", None, 6)]
    assert sorted(r.bad_row.strip() for r in bad.collect()) == ["b,few", "c,x,many", "d,e,4,5"]


def test_a_run_that_dies_leaves_the_last_version(spark, tmp_path):
    rows = lambda *groups: spark.createDataFrame([(g, "007", i, float(i)) for g in groups for i in range(5)], "window string, code string, i int, value double")
    wanted = spark.createDataFrame([("a", "007"), ("b", "007")], "window string, code string")
    s = store.Store(spark, f"{tmp_path}/tree", ["window", "code"])
    assert s.read() is None and s.missing(wanted).count() == 2
    assert s.commit(s.stage(rows("a"))) == 1
    assert [r.window for r in s.missing(wanted).collect()] == ["b"] and s.missing(wanted, overwrite=True).count() == 2
    s.stage(rows("b"))  # and the run dies here
    again = store.Store(spark, f"{tmp_path}/tree", ["window", "code"])
    assert [r.window for r in again.missing(wanted).collect()] == ["b"] and again.read().count() == 5
    part = again.stage(rows("b"))
    assert again.commit(part) == 2 and again.missing(wanted).count() == 0
    # A replaced dataset, read as it was and as it is; texts of digits stay texts.
    assert again.commit(again.stage(rows("b").withColumn("value", F.lit(-1.0)))) == 3
    assert {(r.window, r.code): r.s for r in again.read().groupBy("window", "code").agg(F.sum("value").alias("s")).collect()} == {("a", "007"): 10.0, ("b", "007"): -5.0}
    assert again.read(2).agg(F.sum("value")).first()[0] == 20.0 and again.read(where=F.col("window") == "a").count() == 5
    assert again.sweep() == 2 and again.sweep() == 0 and again.read().count() == 10 and again.read(2).count() == 10


def test_two_runs_that_commit_the_same_version(spark, tmp_path, monkeypatch):
    rows = lambda g: spark.createDataFrame([(g, 1.0)], "window string, value double")
    one, two = (store.Store(spark, f"{tmp_path}/tree", ["window"]) for _ in range(2))
    one.commit(one.stage(rows("a")))
    part = two.stage(rows("b"))
    monkeypatch.setattr(two, "versions", lambda: [])  # it looked before the other committed
    with pytest.raises(RuntimeError, match="another run"):
        two.commit(part)
    monkeypatch.undo()
    assert two.read().count() == 1 and two.commit(part) == 2 and two.read().count() == 2


def test_axes_are_told_by_their_content(spark):
    deep = [(m, i, d) for m, ds in (("x", (0.0, 10.0, 20.0)), ("y", (0.0, 1000.0, 2000.0)), ("z", (0.0, 10.0, 20.0)), ("w", (5.0, 15.0))) for i, d in enumerate(ds)]
    cells = spark.createDataFrame([(m, 0, ix, i, d, d + ix if m != "y" else d / 100 + ix) for m, i, d in deep for ix in range(2)], "model string, iy int, ix int, iz int, depth double, value double")
    members, axes = columns.axis_registry(cells, ["model"])
    ids = {r.model: r.axis_id for r in members.collect()}
    assert ids["x"] == ids["z"] and len(set(ids.values())) == 3 and axes.count() == 8
    target = spark.createDataFrame([(0, 0.0), (1, 6.0), (2, 15.0), (3, 50.0)], "iz int, depth double")
    units = spark.createDataFrame([("x", "m"), ("y", "cm"), ("z", None), ("w", "m")], "model string, z_units string")
    out = {(r.model, r.iz, r.ix): r.value for r in jobs.all_to_reference_levels(cells, target, ["model"], ["iy", "ix"], units).collect()}
    for m in "xyz":
        assert [out[m, i, 1] for i in range(3)] == [1.0, 7.0, 16.0] and (m, 3, 0) not in out
    assert (out["w", 1, 0], out["w", 2, 0]) == (6.0, 15.0) and ("w", 0, 0) not in out
    with pytest.raises(PySparkException, match="no factor"):
        jobs.all_to_reference_levels(cells, target, ["model"], ["iy", "ix"], units.withColumn("z_units", F.lit("fathom"))).collect()
    with pytest.raises(PySparkException, match="two depths"):
        columns.axis_registry(cells.withColumn("depth", F.col("depth") + F.col("ix")), ["model"])[1].collect()


def test_a_member_mismatch_is_an_error_where_asked(spark):
    future = spark.createDataFrame([("m", "r1"), ("n", "r2")], "model string, member string")
    base = spark.createDataFrame([("m", "r1"), ("n", "r1")], "model string, member string")
    windows = spark.createDataFrame([("m", "w", 1), ("n", "w", 1)], "model string, window string, n_files int")
    assert sorted((r.model, r.status) for r in climate.paired(future, base, ["model"], windows).collect()) == [("m", "ok"), ("n", "member_mismatch")]
    with pytest.raises(PySparkException, match="members differ: n r2"):
        climate.paired(future, base, ["model"], windows, strict=True).collect()


def test_a_short_month_of_a_daily_series_is_no_monthly_value(spark):
    days = spark.range(40).select(F.lit("d").alias("v"), F.date_add(F.lit("2001-01-01").cast("date"), F.expr("int(if(id < 31, id, 31))")).alias("time"), F.lit(1.0).alias("value"))
    with pytest.raises(PySparkException, match="neither daily nor monthly"):
        climate.as_monthly(days, ["v"]).collect()
