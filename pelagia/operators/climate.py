"""Time means, climatologies, change fields and their application."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.schema import rule


def merge_time(*parts: DataFrame) -> DataFrame:
    """Chunks of one series; a time that occurs in two chunks counts twice."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def monthly_mean(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of each cell over each month, of the values that are there."""
    month = F.trunc(F.col("time").cast("date"), "month")
    return cells.groupBy(*keys, month.alias("month")).agg(F.avg("value").alias("value"))


def as_monthly(cells: DataFrame, keys: Sequence[str], steps: DataFrame | None = None, step: str = "auto") -> DataFrame:
    """Monthly values of series that are daily or monthly already, with source_step.

    steps: keys, month, source_step of every month, as its files tell (store.month_steps).  Without it a month with one day is monthly and
    one with 28 or more is daily; a month in between, or a series with months of both kinds, is an error.  step daily or monthly
    overrides both.  A month that is said to be monthly and has several days at a cell is an error.
    """
    month = F.trunc(F.col("time").cast("date"), "month")
    places = [c for c in cells.columns if c not in (*keys, "time", "value")]
    means = cells.groupBy(*keys, *places, month.alias("time")).agg(F.avg("value").alias("value"), F.count_distinct(F.to_date("time")).alias("_times"))
    if step != "auto":
        means = means.withColumn("source_step", F.lit(step))
    elif steps is not None:
        known = steps.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("month").alias("_month"), "source_step")  # a row a month
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("time") == F.col("_month"))
        means = means.join(known, same, "left").drop("_month", *[f"_{k}" for k in keys])
        means = means.withColumn("source_step", F.coalesce("source_step", F.raise_error(F.lit("a month has cells but no files")).cast("string")))
    else:
        days = means.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("time").alias("_month")).agg(F.max("_times").alias("_most"))
        kind = F.when(F.col("_most") == 1, "monthly").when(F.col("_most") >= 28, "daily").otherwise("neither")
        series = W.partitionBy(*[f"_{k}" for k in keys])  # a row a month
        days = days.withColumn("source_step", kind).withColumn("_kinds", F.collect_set("source_step").over(series))
        odd = F.raise_error(F.lit("a series is neither daily nor monthly")).cast("string")
        days = days.withColumn("source_step", F.when((F.size("_kinds") == 1) & (F.col("source_step") != "neither"), F.col("source_step")).otherwise(odd)).drop("_most", "_kinds")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("time") == F.col("_month"))
        means = means.join(days, same).drop("_month", *[f"_{k}" for k in keys])
    several = (F.col("source_step") == "monthly") & (F.col("_times") > 1)
    value = F.when(several, F.raise_error(F.lit("a monthly series has several times in a month")).cast("double")).otherwise(F.col("value"))
    return means.withColumn("value", value).drop("_times")


def in_windows(cells: DataFrame, windows: DataFrame) -> DataFrame:
    """A row for each window that a time falls in: windows may overlap.  windows: window, start, end (dates, both inclusive)."""
    return cells.join(F.broadcast(windows), F.col("time").cast("date").between(F.col("start"), F.col("end"))).drop("start", "end")


def climatology(cells: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of each cell over each window; every row weighs the same, missing values none."""
    return in_windows(cells, windows).groupBy(*keys, "window").agg(F.avg("value").alias("value"))


def window_means(cells: DataFrame, windows: Sequence[tuple[str, str, str]], keys: Sequence[str]) -> DataFrame:
    """Climatologies of several windows (name, first day, last day) side by side, in one pass: a column of means for each window, and
    <name>_rows, how many rows it had there.  Windows may overlap."""
    day = F.col("time").cast("date")
    aggs = []
    for name, start, end in windows:
        inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        aggs += [F.avg(F.when(inside, F.col("value"))).alias(name), F.count_if(inside).alias(f"{name}_rows")]
    return cells.groupBy(*keys).agg(*aggs)


def change(future: Column, base: Column, mode: str | Column = "additive") -> Column:
    """future minus base, or the logarithm of their ratio where both are positive; missing where either is missing."""
    how = F.lit(mode) if isinstance(mode, str) else mode
    return F.when(how == "log_ratio", F.when((future > 0) & (base > 0), F.log(future) - F.log(base))).otherwise(future - base)


def month_counts(cells: DataFrame, windows: DataFrame, keys: Sequence[str], expected: DataFrame) -> DataFrame:
    """Months found in each window against those expected (window, expected); nothing is dropped."""
    months = in_windows(cells, windows).groupBy(*keys, "window").agg(F.count_distinct(F.date_format("time", "yyyyMM")).alias("months"))
    return months.join(F.broadcast(expected), "window").withColumn("complete", F.col("months") == F.col("expected"))


def prefer_whole(series: DataFrame, keys: Sequence[str], rank: Column) -> DataFrame:
    """Of each key the rows of the best rank: an unsplit series before its chunks."""
    ranked = series.withColumn("_rank", rank)
    best = ranked.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("_rank").alias("_best"))  # a row a key
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_rank") == F.col("_best"))
    return ranked.join(best, same, "left_semi").drop("_rank")


def change_field(future: DataFrame, base: DataFrame, keys: Sequence[str], mode: str | Column = "additive", variable: str = "variable") -> DataFrame:
    """future minus baseline, or the logarithm of their ratio where both are positive; missing where either is missing."""
    delta = change(F.col("f.value"), F.col("b.value"), mode)
    joined = future.alias("f").join(base.select(*keys, "value").alias("b"), list(keys))
    return joined.select(*[F.col(f"f.{c}") if c not in keys else F.col(c) for c in future.columns if c != "value"], delta.alias("value"))


def validity(delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many cells of a change field are valid, and how many are masked."""
    return delta.groupBy(*keys).agg(F.count("value").alias("valid"), F.count_if(F.col("value").isNull()).alias("masked"))


def apply_delta(base: DataFrame, anomaly: DataFrame, keys: Sequence[str], mode: str | Column = "additive", scale: Column | float = 1.0) -> DataFrame:
    """The baseline's cells with the scaled anomaly applied; a missing anomaly leaves a missing value.

    Additive: base + scale * anomaly.  Log ratio: base * exp(scale * anomaly) where the baseline is positive.
    """
    how = F.lit(mode) if isinstance(mode, str) else mode
    a = F.col("a.value") * (F.lit(scale) if isinstance(scale, float) else scale)
    b = F.col("b.value")
    value = F.when(how == "log_ratio", F.when(b > 0, b * F.exp(a))).otherwise(b + a)
    both = base.alias("b").join(anomaly.select(*keys, "value").alias("a"), list(keys), "left")
    return both.select(*[F.col(c) if c in keys else F.col(f"b.{c}") for c in base.columns if c != "value"], value.alias("value"))


def clamp(cells: DataFrame, bounds: dict[str, tuple[float | None, float | None]], variable: str = "variable") -> DataFrame:
    """Values within their variable's bounds; clipped says which bound cut, if one did."""
    low = rule(F.col(variable), {k: a for k, (a, _) in bounds.items() if a is not None}, F.lit(None).cast("double"))
    high = rule(F.col(variable), {k: b for k, (_, b) in bounds.items() if b is not None}, F.lit(None).cast("double"))
    v = F.col("value")
    side = F.when(v < low, "below").when(v > high, "above")
    return cells.withColumns({"value": F.when(v.isNotNull(), F.least(F.greatest(v, low), high)), "clipped": side})


def paired(future: DataFrame, base: DataFrame, keys: Sequence[str], windows: DataFrame, member: str = "member", strict: bool = False) -> DataFrame:
    """Groups of the future with what they lack: keys, member, window, status.

    windows: keys, window, n_files of each group's windows that were asked for.  Statuses, the first that holds: no_baseline;
    member_mismatch (the baseline has other members only); no_file (nothing in that window); ok.  strict: a mismatch is an error.
    """
    own = future.select(*keys, member).distinct()
    held = base.select(*keys, member).distinct().groupBy(*keys).agg(F.collect_set(member).alias("_members"))
    rows = own.join(held, list(keys), "left").join(windows, list(keys), "left")
    status = F.when(F.col("_members").isNull(), "no_baseline").when(~F.array_contains("_members", F.col(member)), "member_mismatch").when(F.coalesce("n_files", F.lit(0)) == 0, "no_file").otherwise("ok")
    if strict:
        named = F.concat_ws(" ", F.lit("historical and future members differ:"), *[F.col(k).cast("string") for k in keys], F.col(member))
        status = F.when(status == "member_mismatch", F.raise_error(named).cast("string")).otherwise(status)
    return rows.withColumn("status", status).drop("_members")


def missing_pairs(future: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups of the future without a baseline."""
    return future.select(*keys).distinct().join(base.select(*keys).distinct(), list(keys), "left_anti")
