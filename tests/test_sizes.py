"""What shows only on larger tables: long keys and heavy folders."""

import datetime

import duckdb
from pyspark.sql import functions as F

import __spark_entry__
from pelagia.functions import fields as fx
from pelagia.sources import store


def test_only_names_of_files_have_a_month(spark):
    names = {"so_200605.nc": "200605", "a/200701/so_20060531-20061231.nc": "200605", "so_200613.nc": None, "so_2006.nc": None, "broken_2006050": None, "200605.txt": None, None: None}
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    assert {r.name: r.month for r in rows.select("name", fx.month_of_name(F.col("name")).alias("month")).collect()} == names
    dated = fx.month_of_name(F.col("name"), "([0-9]{6})[0-9]*-")
    assert {r.month for r in rows.select(dated.alias("month")).collect()} == {"200605", None}


def test_a_key_of_seven_digits_is_no_month(spark, tmp_path):
    """Malformed names hold the order's key: 2006050 starts like May 2006.  A source's digits are no month either."""
    keys = [(k, 1, "F", 1.0, datetime.datetime(1995, 1 + k % 12, 3), p) for k, p in ((2006050, "1-URGENT"), (2014100, "1-URGENT"), (20060100, "1-URGENT"), (200605, "1-URGENT"), (2006051, "1-URGENT"), (7, "1-202001"), (8, "1-200601"))]
    orders = spark.createDataFrame(keys, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    want = sorted(duck.execute(__spark_entry__.oracle_sql()["month_window_filter"]).fetchall())
    assert len(want) == 4 and sorted(map(tuple, __spark_entry__.queries()["month_window_filter"](spark, str(tmp_path)).collect())) == want


def test_a_heavy_folder_is_shared_out_over_tasks(spark, tmp_path):
    """Nearly all cells lie in one folder and one tile; a task holds what the advisory size lets it, not the folder."""
    n = 80_000
    cells = spark.range(0, n, 1, 8).selectExpr("IF(id % 1000 = 0, 'so', 'uo') AS variable", "DATE'1995-03-01' AS time", "CAST(id % 3 AS INT) AS iz", "CAST(id % 31 AS INT) AS iy", "CAST(id % 29 AS INT) AS ix", "double(id) AS value")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        store.write_cells(cells, f"{tmp_path}/cells")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(f"{tmp_path}/cells")
    assert "_tile" not in stored.columns and stored.select(cells.columns).exceptAll(cells).isEmpty() and stored.count() == n
    files = {name.name: duckdb.sql(f"SELECT iz, iy, ix FROM '{name}'").fetchall() for name in (tmp_path / "cells").glob("variable=uo/year=1995/*.parquet")}
    assert len(files) >= 4 and max(map(len, files.values())) < n / 3
    assert all(rows == sorted(rows) for rows in files.values())
