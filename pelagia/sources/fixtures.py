"""Gridded views over star-schema tables: the cells, daily fields and file manifest that the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.schema import VARIABLES

DEPTHS = (0.494, 9.573, 29.445, 77.854, 155.851, 453.938, 1245.291)
NX, NY = 24, 16
WINDOWS = (("hist", "1995-01-01", "1997-12-31"), ("futA", "1998-01-01", "2001-12-31"), ("futB", "1999-01-01", "2001-12-31"))
ARCHIVE_WINDOWS = (("historical", "2006-2014", "2006-01-01", "2014-12-31"), ("future", "2030-2060", "2030-01-01", "2060-12-31"), ("future", "2050-2060", "2050-01-01", "2060-12-31"), ("future", "2090-2100", "2090-01-01", "2100-12-31"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dates(spark: SparkSession, rows: tuple, names: str) -> DataFrame:
    """Constant rows whose last two columns are dates."""
    cols = names.split()
    df = spark.createDataFrame([tuple(r) for r in rows], [*cols])
    return df.withColumns({c: F.to_date(c) for c in cols[-2:]})


def series(spark: SparkSession, sf_dir: str, variable: str = "thetao", land: bool = True) -> DataFrame:
    """A monthly 4-D series from lineitem: model, scenario, variable, time, iz, iy, ix, depth, lat, lon, value."""
    value = {"thetao": "l_quantity", "chl": "l_extendedprice"}[variable]
    iy, ix, iz = F.expr(f"CAST((l_partkey div {NX}) % {NY} AS INT)"), F.expr(f"CAST(l_partkey % {NX} AS INT)"), F.expr("CAST(l_linenumber - 1 AS INT)")
    year = F.year("l_shipdate")
    scenario = F.when(year < 1998, "historical").when(F.col("l_linestatus") == "O", "ssp585").otherwise("ssp126")
    out = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("M"), (F.ascii("l_returnflag") % 3).cast("string")).alias("model"),
        scenario.alias("scenario"), F.lit(variable).alias("variable"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("time"),
        iz.alias("iz"), iy.alias("iy"), ix.alias("ix"), F.col(value).cast("double").alias("value"),
    )
    out = out.withColumns({"depth": F.element_at(F.array(*[F.lit(d) for d in DEPTHS]), F.col("iz") + 1), "lat": (F.lit(-75.0) + 10 * F.col("iy")), "lon": (F.lit(-180.0) + 15 * F.col("ix"))})
    return out.where("(5 * ix + 3 * iy) % 11 >= 3") if land else out


def with_gaps(cells: DataFrame) -> DataFrame:
    """The imposed gaps of a change field."""
    return cells.withColumn("value", F.when(F.expr("(7 * ix + 11 * iy + 3 * iz) % 5 >= 2"), F.col("value")))


def with_top_gap(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", F.when(F.expr("iz >= (ix + iy) % 4"), F.col("value")))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily 2-D fields from events: variable, time (timestamp), iy, ix, value; iz and depth are NULL."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("variable"), F.col("ts").alias("time"), F.lit(None).cast("int").alias("iz"),
        F.expr("CAST(user_id div 15 AS INT)").alias("iy"), F.expr("CAST(user_id % 15 AS INT)").alias("ix"),
        F.col("value").cast("double").alias("value"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file manifest from orders, with CMIP-style titles; every 50th title is malformed."""
    o = table(spark, sf_dir, "orders")
    years = F.when(F.col("o_orderstatus") == "F", 2006 + F.col("o_orderkey") % 9).otherwise(2025 + F.col("o_orderkey") % 76)
    start = F.make_date(years.cast("int"), F.month("o_orderdate"), F.lit(1))
    out = o.select(
        "o_orderkey",
        F.replace(F.lower(F.substring("o_orderpriority", 3, 20)), F.lit(" "), F.lit("-")).alias("source_id"),
        F.when(F.col("o_orderstatus") == "F", "historical").when(F.col("o_orderstatus") == "O", "ssp126").otherwise("ssp585").alias("experiment_id"),
        F.concat(F.lit("r"), (F.col("o_custkey") % 12 + 1).cast("string"), F.lit("i1p1f"), (F.col("o_orderkey") % 3 + 1).cast("string")).alias("member_id"),
        F.element_at(F.array(*[F.lit(v) for v in VARIABLES]), (F.col("o_orderkey") % 10 + 1).cast("int")).alias("variable_id"),
        start.alias("time_start"), F.last_day(F.add_months(start, (F.col("o_orderkey") % 120).cast("int"))).alias("time_end"),
        F.col("o_totalprice").alias("size_bytes"),
    )
    span = F.concat(F.date_format("time_start", "yyyyMM"), F.lit("-"), F.date_format("time_end", "yyyyMM"))
    title = F.concat_ws("_", "variable_id", F.lit("Omon"), "source_id", "experiment_id", "member_id", F.lit("gn"), F.concat(span, F.lit(".nc")))
    out = out.withColumn("title", F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("broken_"), F.col("o_orderkey").cast("string"))).otherwise(title))
    host = F.when(F.col("o_orderkey") % 3 == 0, "https://esgf.nci.org.au").when(F.col("o_orderkey") % 3 == 1, "https://data.example.org").otherwise("http://data.example.org")
    return out.withColumns({"checksum": F.md5("title"), "http_url": F.concat(host, F.lit("/"), F.col("title")), "data_node": F.concat(F.lit("node"), (F.col("o_orderkey") % 7).cast("string"))})
