"""Queries over gridded cells: time, change, columns, fills, remaps and delivery tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions import fields as fx
from pelagia.operators import audit, climate, columns, fill, products, remap
from pelagia.plans import jobs
from pelagia.plans.downscale import coast_baseline as build_coast_baseline
from pelagia.plans.downscale import downscale as run_downscale
from pelagia.plans.registry import query
from pelagia.schema import FINE_BINS, PELAGIC_ZONES
from pelagia.sources import fixtures as fix
from pelagia.staging import checkpointed

CELL = ["iz", "iy", "ix"]
PLACE = ["variable", *CELL, "depth", "lat", "lon"]
#: The wet mask that queries lay over the cells: all but the land, whether data are there or not.
MASK = "(5 * ix + 3 * iy) % 11 >= 3"


def r6(c: str = "value", name: str | None = None):
    return F.round(c, 6).alias(name or c)


def _windows(spark: SparkSession) -> DataFrame:
    return fix.dates(spark, fix.WINDOWS, "window start end")


def _clim(spark: SparkSession, sf_dir: str, variable: str, window: str) -> DataFrame:
    w = _windows(spark).where(F.col("window") == window)
    return climate.climatology(fix.series(spark, sf_dir, variable), w, PLACE).drop("window")


def _wide(spark: SparkSession, sf_dir: str, variable: str = "thetao") -> DataFrame:
    """The climatologies hist and futB of a variable, side by side: one scan, one shuffle."""
    return climate.window_means(fix.series(spark, sf_dir, variable), [w for w in fix.WINDOWS if w[0] in ("hist", "futB")], PLACE)


def _base(wide: DataFrame) -> DataFrame:
    return wide.where("hist_rows > 0").select(*PLACE, F.col("hist").alias("value"))


def _change(wide: DataFrame, mode: str = "additive", base: str = "hist") -> DataFrame:
    return wide.where("hist_rows > 0 AND futB_rows > 0").select(*PLACE, climate.change(F.col("futB"), F.col(base), mode).alias("value"))


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change(_wide(spark, sf_dir))


def _grid(spark: SparkSession) -> DataFrame:
    return remap.Grid(fix.NX, fix.NY, -180.0, 15.0, -75.0, 10.0).cells(spark)


def _levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("fixture", i, d) for i, d in enumerate(fix.DEPTHS)], "axis_id string, iz int, depth double")


def _ocean(spark: SparkSession, anomaly: DataFrame) -> DataFrame:
    """Every wet cell of every level with the anomaly's value, or none."""
    cells = _grid(spark).where(MASK).crossJoin(F.broadcast(_levels(spark).select("iz")))
    return cells.join(anomaly.select(*CELL, "value"), CELL, "left").withColumn("wet", F.lit(True))


# Shared parts of the SQL.
G = """
gl AS (SELECT concat('M', ascii(l_returnflag) % 3) AS model,
  CASE WHEN year(l_shipdate) < 1998 THEN 'historical' WHEN l_linestatus = 'O' THEN 'ssp585' ELSE 'ssp126' END AS scenario,
  date_trunc('month', l_shipdate)::DATE AS time, (l_linenumber - 1)::INT AS iz, ((l_partkey // 24) % 16)::INT AS iy, (l_partkey % 24)::INT AS ix,
  ([0.494, 9.573, 29.445, 77.854, 155.851, 453.938, 1245.291][l_linenumber])::DOUBLE AS depth, l_quantity AS thetao, l_extendedprice AS chl FROM lineitem),
g AS (SELECT *, (-75 + 10 * iy)::DOUBLE AS lat, (-180 + 15 * ix)::DOUBLE AS lon FROM gl WHERE (5 * ix + 3 * iy) % 11 >= 3),
win AS (SELECT * FROM (VALUES ('hist', DATE '1995-01-01', DATE '1997-12-31'), ('futA', DATE '1998-01-01', DATE '2001-12-31'), ('futB', DATE '1999-01-01', DATE '2001-12-31')) t(win, s, e)),
clim AS (SELECT win, iz, iy, ix, depth, lat, lon, avg(thetao) AS thetao, avg(chl) AS chl FROM g JOIN win ON time BETWEEN s AND e GROUP BY ALL),
base AS (SELECT * FROM clim WHERE win = 'hist'), fut AS (SELECT * FROM clim WHERE win = 'futB'),
delta AS (SELECT f.*, f.thetao - b.thetao AS v FROM fut f JOIN base b USING (iz, iy, ix)),
gap AS (SELECT iz, iy, ix, depth, lat, lon, CASE WHEN (7 * ix + 11 * iy + 3 * iz) % 5 >= 2 THEN v END AS v FROM delta),
axis AS (SELECT * FROM (VALUES (0, 0.494), (1, 9.573), (2, 29.445), (3, 77.854), (4, 155.851), (5, 453.938), (6, 1245.291)) t(iz, depth)),
grid AS (SELECT y.i::INT AS iy, x.i::INT AS ix, (-75 + 10 * y.i)::DOUBLE AS lat, (-180 + 15 * x.i)::DOUBLE AS lon FROM range(16) y(i), range(24) x(i)),
ocean AS (SELECT axis.iz, grid.iy, grid.ix, gap.v FROM axis CROSS JOIN (SELECT * FROM grid WHERE (5 * ix + 3 * iy) % 11 >= 3) grid LEFT JOIN gap USING (iz, iy, ix))"""
#: Donors of each pending cell of `ocean` within 12 steps.
DONORS = """
pairs AS (SELECT p.iz, p.iy, p.ix, d.v, d.iy - p.iy AS dy, d.ix - p.ix AS dx, greatest(abs(d.iy - p.iy), abs(d.ix - p.ix)) AS rad,
  (d.iy - p.iy) * (d.iy - p.iy) + (d.ix - p.ix) * (d.ix - p.ix) AS d2
  FROM ocean p JOIN ocean d ON p.iz = d.iz AND p.v IS NULL AND d.v IS NOT NULL AND abs(d.iy - p.iy) <= 12 AND abs(d.ix - p.ix) <= 12),
nearest AS (SELECT iz, iy, ix, arg_min(v, rad::BIGINT * 1000000000 + d2 * 1000000 + (dy + 100) * 1000 + dx + 100) AS fill FROM pairs GROUP BY ALL),
rings AS (SELECT iz, iy, ix, rad, count(*) AS n, sum(v / d2) AS wv, sum(1.0::DOUBLE / d2) AS w FROM pairs GROUP BY ALL),
grown AS (SELECT iz, iy, ix, rad, sum(n) OVER q AS n, sum(wv) OVER q AS wv, sum(w) OVER q AS w FROM rings WINDOW q AS (PARTITION BY iz, iy, ix ORDER BY rad)),
idw AS (SELECT iz, iy, ix, coalesce(arg_min(wv / w, rad) FILTER (WHERE n >= 4), arg_min(wv / w, rad)) AS fill FROM grown GROUP BY ALL)"""
TOP = "CASE WHEN v IS NULL AND count(v) OVER (PARTITION BY iy, ix ORDER BY iz) = 0 THEN first_value(v IGNORE NULLS) OVER (PARTITION BY iy, ix ORDER BY iz ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) ELSE v END"
#: The downscaled field: idw fill, top fill, fallback 0, applied to the baseline, top fill, clamped at 25.
DOWN = f"""
f1 AS (SELECT o.iz, o.iy, o.ix, coalesce(o.v, i.fill) AS v, o.v IS NULL AND i.fill IS NOT NULL AS filled FROM ocean o LEFT JOIN idw i USING (iz, iy, ix)),
f2 AS (SELECT iz, iy, ix, filled, {TOP} AS v, v IS NULL AS was FROM f1),
f3 AS (SELECT *, v IS NULL AS fallback FROM f2),
bg AS (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS b FROM base),
f4 AS (SELECT bg.iz, bg.iy, bg.ix, b + 0.5 * coalesce(f3.v, 0) AS v, coalesce(f3.v, 0) AS anomaly_value,
   CASE WHEN fallback THEN 'fallback' WHEN filled THEN 'filled' WHEN was THEN 'top' END AS fill_kind FROM bg JOIN f3 USING (iz, iy, ix)),
f5 AS (SELECT iz, iy, ix, anomaly_value, fill_kind, {TOP} AS v FROM f4)"""


# ------------------------------------------------------------------------------------- scans and time


@query(f"WITH {G} SELECT time, count(*) AS n, round(sum(chl), 2) AS total FROM g GROUP BY time")
def scan_select_variable(spark, sf_dir):
    return fix.series(spark, sf_dir, "chl").groupBy("time").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT event_type AS variable, (user_id // 15)::INT AS iy, (user_id % 15)::INT AS ix, date_trunc('month', ts)::DATE AS month, round(avg(value), 6) AS value FROM events GROUP BY ALL")
def monthly_mean(spark, sf_dir):
    return climate.monthly_mean(fix.daily(spark, sf_dir), ["variable", "iy", "ix"]).select("variable", "iy", "ix", "month", r6())


@query(f"WITH {G} SELECT win AS \"window\", iz, iy, ix, depth, round(thetao, 6) AS value FROM clim")
def climatology_window(spark, sf_dir):
    return climate.climatology(fix.series(spark, sf_dir), _windows(spark), PLACE).select("window", *CELL, "depth", r6())


@query(f"""WITH {G}, n AS (SELECT model, win, count(DISTINCT strftime(time, '%Y%m')) AS months FROM g JOIN win ON time BETWEEN s AND e GROUP BY ALL),
  x AS (SELECT *, CASE win WHEN 'futA' THEN 48 ELSE 36 END AS expected FROM n) SELECT model, win AS "window", months, expected, months = expected AS complete FROM x""")
def expected_months(spark, sf_dir):
    expected = spark.createDataFrame([("hist", 36), ("futA", 48), ("futB", 36)], '"window" string, expected int'.replace('"', "`"))
    return climate.month_counts(fix.series(spark, sf_dir), _windows(spark), ["model"], expected).select("model", "window", "months", "expected", "complete")


@query(f"WITH {G}, m AS (SELECT * FROM g WHERE scenario = 'ssp126' UNION ALL SELECT * FROM g WHERE scenario = 'ssp585' UNION ALL SELECT * FROM g WHERE scenario = 'ssp585' AND time < DATE '1999-01-01') SELECT time, iz, count(*) AS n, round(avg(thetao), 6) AS value FROM m GROUP BY ALL")
def merge_time(spark, sf_dir):
    s = fix.series(spark, sf_dir)
    late = s.where("scenario = 'ssp585'")
    merged = climate.merge_time(s.where("scenario = 'ssp126'"), late, late.where("time < DATE '1999-01-01'"))
    return merged.groupBy("time", "iz").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("value"))


@query(f"""WITH {G}, m AS (SELECT *, CASE WHEN model = 'M0' THEN (CASE WHEN time < DATE '1998-01-01' THEN 'whole' ELSE 'part' END) ELSE 'part' END AS chunk FROM g),
  k AS (SELECT *, CASE chunk WHEN 'whole' THEN 0 ELSE 1 END AS rank FROM m), b AS (SELECT *, min(rank) OVER (PARTITION BY model, iz) AS best FROM k)
  SELECT model, iz, chunk, count(*) AS n, round(sum(thetao), 2) AS total FROM b WHERE rank = best GROUP BY ALL""")
def stitch_chunks(spark, sf_dir):
    chunk = F.when((F.col("model") == "M0") & (F.col("time") < F.lit("1998-01-01").cast("date")), "whole").otherwise("part")
    s = fix.series(spark, sf_dir).withColumn("chunk", chunk)
    best = climate.prefer_whole(s, ["model", "iz"], F.when(F.col("chunk") == "whole", 0).otherwise(1))
    return best.groupBy("model", "iz", "chunk").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


# ------------------------------------------------------------------------------------- change fields


@query(f"WITH {G} SELECT iz, iy, ix, round(v, 6) AS value FROM delta")
def delta_additive(spark, sf_dir):
    return _delta(spark, sf_dir).select(*CELL, r6())


@query(f"WITH {G} SELECT f.iz, f.iy, f.ix, round(CASE WHEN f.chl > 0 AND b.chl > 0 THEN ln(f.chl) - ln(b.chl) END, 6) AS value FROM fut f JOIN base b USING (iz, iy, ix)")
def delta_log_ratio(spark, sf_dir):
    return _change(_wide(spark, sf_dir, "chl"), "log_ratio").select(*CELL, r6())


@query(f"""WITH {G}, a AS (SELECT b.iz, b.iy, b.ix, b.thetao + 0.01 * gap.v AS add_value FROM base b LEFT JOIN gap USING (iz, iy, ix)),
  l AS (SELECT b.iz, b.iy, b.ix, CASE WHEN b.chl > 0 THEN b.chl * exp(CASE WHEN f.chl > 0 AND b.chl > 0 THEN ln(f.chl) - ln(b.chl) END) END AS log_value FROM base b LEFT JOIN fut f USING (iz, iy, ix))
  SELECT iz, iy, ix, round(add_value, 6) AS additive, round(ln(log_value), 6) AS log_ratio FROM a JOIN l USING (iz, iy, ix)""")
def apply_delta(spark, sf_dir):
    wide, chl = (checkpointed(_wide(spark, sf_dir, v)) for v in ("thetao", "chl"))
    add = climate.apply_delta(_base(wide), fix.with_gaps(_change(wide)), CELL, "additive", 0.01)
    log = climate.apply_delta(_base(chl), _change(chl, "log_ratio"), CELL, "log_ratio")
    return add.select(*CELL, r6("value", "additive")).join(log.select(*CELL, F.round(F.log("value"), 6).alias("log_ratio")), CELL)


@query(f"""WITH {G} SELECT iz, iy, ix, round(CASE WHEN v < -2 THEN -2 WHEN v > 2 THEN 2 ELSE v END, 6) AS value, CASE WHEN v < -2 THEN 'below' WHEN v > 2 THEN 'above' END AS clipped FROM gap""")
def clamp_bounds(spark, sf_dir):
    return climate.clamp(fix.with_gaps(_delta(spark, sf_dir)), {"thetao": (-2.0, 2.0)}).select(*CELL, r6(), "clipped")


@query(f"WITH {G} SELECT DISTINCT g.model, g.iz, g.iy, g.ix FROM g ANTI JOIN (SELECT DISTINCT model, iz, iy, ix FROM g WHERE scenario = 'historical') b USING (model, iz, iy, ix) WHERE g.scenario <> 'historical'")
def missing_pairs(spark, sf_dir):
    s = fix.series(spark, sf_dir)
    return climate.missing_pairs(s.where("scenario <> 'historical'"), s.where("scenario = 'historical'"), ["model", *CELL])


@query(f"""WITH {G} SELECT model, scenario, round(sum(CASE WHEN p AND scenario = 'ssp585' AND model = 'M1' THEN thetao / 100 ELSE thetao END), 4) AS total, CASE WHEN scenario = 'ssp585' AND model = 'M1' THEN 'cm s-1 to m s-1' ELSE '' END AS unit_conversion FROM (SELECT *, true AS p FROM g) GROUP BY ALL""")
def convert_velocity(spark, sf_dir):
    s = fix.series(spark, sf_dir)
    one = (F.col("model") == "M1") & (F.col("scenario") == "ssp585")
    value, note = fx.converted_velocity(F.col("value"), F.lit("future"), F.when(one, "rcp85").otherwise(F.col("scenario")), F.when(one, "cesm_f09_g16").otherwise(F.col("model")), F.lit("uo"), F.lit("future/UVEL/x"))
    return s.select("model", "scenario", value.alias("v"), note.alias("unit_conversion")).groupBy("model", "scenario", "unit_conversion").agg(F.round(F.sum("v"), 4).alias("total"))


# ------------------------------------------------------------------------------------- columns


@query(f"WITH {G}, t AS (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS v FROM base) SELECT iz, iy, ix, round({TOP}, 6) AS value FROM t")
def fill_top(spark, sf_dir):
    return columns.fill_top(fix.with_top_gap(_clim(spark, sf_dir, "thetao", "hist")), ["variable", "iy", "ix"]).select(*CELL, r6())


@query(f"WITH {G} SELECT iz, iy, ix, round(CASE WHEN iz < 4 THEN max(CASE WHEN iz = 4 THEN thetao END) OVER (PARTITION BY iy, ix) ELSE thetao END, 6) AS value FROM base")
def fixed_top_replace(spark, sf_dir):
    return columns.replace_top(_clim(spark, sf_dir, "thetao", "hist"), ["variable", "iy", "ix"]).select(*CELL, r6())


LAYERS = """
seen AS (SELECT DISTINCT iz, depth FROM g),
mid AS (SELECT iz, depth, (lag(depth) OVER (ORDER BY iz) + depth) / 2 AS up, (depth + lead(depth) OVER (ORDER BY iz)) / 2 AS down FROM seen),
layers AS (SELECT iz, depth, coalesce(up, greatest(0, depth - (down - depth))) AS lower, coalesce(down, depth + (depth - up)) AS upper FROM mid)"""


def _layers(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Layer bounds of the levels that occur in cells, the whole series where none are given."""
    cells = fix.series(spark, sf_dir) if cells is None else cells
    return columns.layer_bounds(cells.select(F.lit("fixture").alias("axis_id"), "iz", "depth").distinct())


@query(f"WITH {G}, {LAYERS} SELECT iz, depth, round(lower, 6) AS lower, round(upper, 6) AS upper, round(upper - lower, 6) AS thickness, 'midpoints' AS bounds_source FROM layers")
def layer_bounds(spark, sf_dir):
    return _layers(spark, sf_dir).select("iz", "depth", r6("lower"), r6("upper"), r6("thickness"), "bounds_source")


def _bins_sql(bins) -> str:
    rows = ", ".join(f"('{label}', {a}, {b})" for label, a, b in bins)
    return f"""WITH {G}, {LAYERS}, bins AS (SELECT * FROM (VALUES {rows}) t(label, a, b)), c AS (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS v FROM base)
      SELECT label, iy, ix, round(sum(v * (upper - lower)) / sum(CASE WHEN v IS NOT NULL THEN upper - lower END), 6) AS value, count(DISTINCT iz) AS levels,
        CASE WHEN count(DISTINCT iz) = 1 THEN 'single_level' ELSE 'thickness_weighted_mean' END AS method FROM c JOIN layers USING (iz) JOIN bins ON depth >= a AND depth < b GROUP BY label, iy, ix"""


def _binned(spark, sf_dir, bins):
    wide = checkpointed(_wide(spark, sf_dir))
    table = spark.createDataFrame(list(bins), "label string, lower double, upper double")
    return columns.depth_bins(fix.with_top_gap(_base(wide)), _layers(spark, sf_dir, wide), table, ["iy", "ix"]).select("label", "iy", "ix", r6(), "levels", "method")


@query(_bins_sql(FINE_BINS))
def depth_bins_fine(spark, sf_dir):
    return _binned(spark, sf_dir, FINE_BINS)


@query(_bins_sql(PELAGIC_ZONES))
def depth_bins_pelagic(spark, sf_dir):
    return _binned(spark, sf_dir, PELAGIC_ZONES)


@query(f"""WITH {G}, tgt AS (SELECT * FROM (VALUES (0, 0.3), (1, 5), (2, 29.445), (3, 100), (4, 453.938), (5, 1000), (6, 2000)) t(iz_out, d)),
  src AS (SELECT iz AS z0, depth AS d0, lead(iz) OVER (ORDER BY depth) AS z1, lead(depth) OVER (ORDER BY depth) AS d1 FROM axis),
  hit AS (SELECT iz_out, d, z0, z1, CASE WHEN d1 IS NULL THEN 0 ELSE (d - d0) / (d1 - d0) END AS p FROM tgt JOIN src ON d >= d0 AND (d < d1 OR (d1 IS NULL AND d = d0))),
  wt AS (SELECT iz_out, d, z0 AS iz, 1 - p AS w FROM hit UNION ALL SELECT iz_out, d, z1, p FROM hit), c AS (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS v FROM base),
  s AS (SELECT iy, ix, iz_out, d, sum(w * v) AS sv, sum(CASE WHEN v IS NOT NULL THEN w END) AS sw FROM c JOIN wt USING (iz) WHERE w > 0 GROUP BY ALL)
  SELECT iy, ix, iz_out AS iz, d::DOUBLE AS depth, round(CASE WHEN sw >= 0.5 THEN sv / sw END, 6) AS value FROM s""")
def vertical_interp(spark, sf_dir):
    target = spark.createDataFrame(list(enumerate((0.3, 5.0, 29.445, 100.0, 453.938, 1000.0, 2000.0))), "iz int, depth double")
    cells = fix.with_top_gap(_clim(spark, sf_dir, "thetao", "hist"))
    return jobs.to_reference_levels(cells, _levels(spark), target, ["iy", "ix"]).select("iy", "ix", "iz", "depth", r6())


@query(f"""WITH {G}, p AS (SELECT DISTINCT iz, lon FROM g), d AS (SELECT iz, lon, abs(lon - lag(lon) OVER (PARTITION BY iz ORDER BY lon)) AS s FROM p),
  m AS (SELECT iz, count(*) AS size, min(lon) AS first, max(lon) AS last, median(s) AS step, max(s) AS mx, min(s) AS mn FROM d GROUP BY iz)
  SELECT iz, size, first, last, step, abs(mx - step) <= 1e-8 + 1e-4 * abs(step) AND abs(mn - step) <= 1e-8 + 1e-4 * abs(step) AS is_even FROM m""")
def axis_spacing(spark, sf_dir):
    return columns.axis_spacing(fix.series(spark, sf_dir), ["iz"], "lon")


# ------------------------------------------------------------------------------------- fills


@query(f"""WITH {G}, m AS (SELECT DISTINCT iy, ix FROM g WHERE thetao > 49), b AS (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS v FROM base)
  SELECT b.iz, b.iy, b.ix, v IS NOT NULL OR m.iy IS NOT NULL AS wet FROM b LEFT JOIN m USING (iy, ix)""")
def wet_mask(spark, sf_dir):
    mask = fix.series(spark, sf_dir).withColumn("value", F.when(F.col("value") > 49, F.col("value")))
    return fill.wet_mask(fix.with_top_gap(_clim(spark, sf_dir, "thetao", "hist")), mask).select(*CELL, "wet")


@query(f"WITH {G} SELECT iy, ix, bool_or(thetao > 45) AS wet FROM g GROUP BY ALL")
def mask_any_depth(spark, sf_dir):
    return fill.mask_any_depth(fix.series(spark, sf_dir).withColumn("value", F.when(F.col("value") > 45, F.col("value"))))


def _filled_sql(table: str) -> str:
    return f"WITH {G}, {DONORS} SELECT o.iz, o.iy, o.ix, round(coalesce(o.v, f.fill), 6) AS value, o.v IS NULL AND f.fill IS NOT NULL AS filled FROM ocean o LEFT JOIN {table} f USING (iz, iy, ix)"


@query(_filled_sql("nearest"))
def coastal_fill_nearest(spark, sf_dir):
    cells = checkpointed(_ocean(spark, fix.with_gaps(_delta(spark, sf_dir))))
    return fill.coastal_fill(cells, ["iz"], "nearest").select(*CELL, r6(), "filled")


@query(_filled_sql("idw"))
def coastal_fill_idw(spark, sf_dir):
    cells = checkpointed(_ocean(spark, fix.with_gaps(_delta(spark, sf_dir))))
    return fill.coastal_fill_by_tiles(cells, ["iz"]).select(*CELL, r6(), "filled")


@query(f"""WITH {G.replace("gap AS (SELECT iz, iy, ix, depth, lat, lon, CASE WHEN (7 * ix + 11 * iy + 3 * iz) % 5 >= 2 THEN v END AS v FROM delta)", "gap AS (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS v FROM base)")}, {DONORS}
  SELECT o.iz, o.iy, o.ix, round(coalesce(o.v, f.fill), 6) AS value, o.v IS NULL AND f.fill IS NOT NULL AS filled FROM ocean o LEFT JOIN idw f USING (iz, iy, ix)""")
def coastal_fill_baseline(spark, sf_dir):
    cells = checkpointed(_ocean(spark, fix.with_top_gap(_clim(spark, sf_dir, "thetao", "hist"))))
    return fill.coastal_fill_by_tiles(cells, ["iz"]).select(*CELL, r6(), "filled")


@query(f"WITH {G} SELECT iz, iy, ix, round(coalesce(v, 0), 6) AS value, v IS NULL AS fallback FROM ocean")
def fill_fallback(spark, sf_dir):
    return fill.fill_fallback(_ocean(spark, fix.with_gaps(_delta(spark, sf_dir)))).select(*CELL, r6(), "fallback")


@query(f"""WITH {G}, p AS (SELECT p.iz, p.iy, p.ix, arg_min(d.v, ((d.iy - p.iy) * (d.iy - p.iy) + (d.ix - p.ix) * (d.ix - p.ix))::BIGINT * 1000000 + d.iy * 1000 + d.ix) AS fill
    FROM ocean p JOIN gap d ON p.iz = d.iz WHERE p.v IS NULL AND d.v IS NOT NULL GROUP BY ALL)
  SELECT o.iz, o.iy, o.ix, round(coalesce(o.v, p.fill), 6) AS value, o.v IS NULL AND p.fill IS NOT NULL AS nearest FROM ocean o LEFT JOIN p USING (iz, iy, ix)""")
def nearest_any_donor(spark, sf_dir):
    return fill.nearest_any_donor(_ocean(spark, fix.with_gaps(_delta(spark, sf_dir))), ["iz"]).select(*CELL, r6(), "nearest")


@query()
def force_complete(spark, sf_dir):
    return fill.force_complete(_ocean(spark, fix.with_gaps(_delta(spark, sf_dir))), ["iz"], checkpointed).select(*CELL, r6(), "forced")


def _downscaled(spark, sf_dir):
    wide = checkpointed(_wide(spark, sf_dir))
    mask = _grid(spark).where(MASK).withColumn("value", F.lit(1.0))
    return run_downscale(fix.with_top_gap(_base(wide)), fix.with_gaps(_change(wide)), mask=mask, scale=0.5, fallback=0.0, bounds={"thetao": (None, 25.0)})


# The anomaly's domain is the baseline's cells that the mask makes wet.
_DOWN = f"WITH {G.replace('ocean AS (SELECT axis.iz, grid.iy, grid.ix, gap.v FROM axis CROSS JOIN (SELECT * FROM grid WHERE (5 * ix + 3 * iy) % 11 >= 3) grid LEFT JOIN gap USING (iz, iy, ix))', 'ocean AS (SELECT b.iz, b.iy, b.ix, gap.v FROM base b LEFT JOIN gap USING (iz, iy, ix))')}, {DONORS}, {DOWN}"


@query(f"{_DOWN} SELECT iz, iy, ix, round(least(v, 25), 6) AS value, CASE WHEN v > 25 THEN 'above' END AS clipped FROM f5")
def downscale(spark, sf_dir):
    return _downscaled(spark, sf_dir).select(*CELL, r6(), "clipped")


@query(f"{_DOWN} SELECT iz, iy, ix, round(anomaly_value, 6) AS anomaly_value, fill_kind FROM f4")
def filled_anomaly(spark, sf_dir):
    return _downscaled(spark, sf_dir).select(*CELL, r6("anomaly_value"), "fill_kind")


@query(f"""{_DOWN} SELECT iz, count(*) AS cells, count(v) AS valid, count(*) FILTER (WHERE fill_kind = 'filled') AS n_filled, count(*) FILTER (WHERE fill_kind = 'top') AS n_top, 0 AS n_forced,
  count(*) FILTER (WHERE fill_kind = 'fallback') AS n_fallback, 0 AS n_below, count(*) FILTER (WHERE v > 25) AS n_above FROM f5 GROUP BY iz""")
def review_report(spark, sf_dir):
    return fill.review_report(_downscaled(spark, sf_dir), ["iz"])


@query(f"""WITH {G}, {DONORS}, x AS (SELECT o.iz, o.v, coalesce(o.v, f.fill) AS w, o.v IS NULL AND f.fill IS NOT NULL AS filled FROM ocean o LEFT JOIN idw f USING (iz, iy, ix))
  SELECT iz, count(*) AS cells, count(*) AS wet_cells, count(w) AS valid, count(*) - count(w) AS remaining, count(*) FILTER (WHERE filled) AS n_filled FROM x GROUP BY iz""")
def fill_report(spark, sf_dir):
    filled = fill.coastal_fill_by_tiles(checkpointed(_ocean(spark, fix.with_gaps(_delta(spark, sf_dir)))), ["iz"])
    return fill.fill_report(filled, ["iz"], ["filled"])


@query()
def coast_baseline(spark, sf_dir):
    base = _clim(spark, sf_dir, "thetao", "hist")
    cells = _ocean(spark, fix.with_gaps(base)).drop("wet").withColumn("variable", F.lit("thetao"))
    mask = _grid(spark).where(MASK).withColumn("value", F.lit(1.0))
    return build_coast_baseline(cells, mask, max_steps=2).select(*CELL, r6(), "filled", "forced", "nearest")


# ------------------------------------------------------------------------------------- remaps

TARGET = remap.Grid(46, 29, -176.3, 7.7, -72.4, 5.1)


@query(f"""WITH {G}, tg AS (SELECT y.i::INT AS dy, x.i::INT AS dx, (-72.4::DOUBLE + 5.1::DOUBLE * y.i + 75) / 10 AS fy, (((-176.3::DOUBLE + 7.7::DOUBLE * x.i + 180) / 15) % 24) AS fx FROM range(29) y(i), range(46) x(i)),
  t AS (SELECT *, floor(fy)::INT AS y0, floor(fx)::INT AS x0, fy - floor(fy) AS ty, fx - floor(fx) AS tx FROM tg WHERE fy BETWEEN 0 AND 15),
  w AS (SELECT dy, dx, y0 + a.i AS iy, (x0 + b.i) % 24 AS ix, (CASE a.i WHEN 1 THEN ty ELSE 1 - ty END) * (CASE b.i WHEN 1 THEN tx ELSE 1 - tx END) AS w FROM t, range(2) a(i), range(2) b(i)),
  c AS (SELECT iz, iy, ix, avg(thetao) AS v FROM gl GROUP BY ALL),
  s AS (SELECT iz, dy, dx, sum(w * v) AS sv, sum(w) AS sw FROM w JOIN c USING (iy, ix) WHERE w > 0 GROUP BY ALL)
  SELECT iz, dy AS iy, dx AS ix, round(CASE WHEN abs(sw - 1) < 1e-9 THEN sv END, 6) AS value FROM s""")
def remap_bilinear(spark, sf_dir):
    cells = fix.series(spark, sf_dir, land=False).groupBy(*CELL).agg(F.avg("value").alias("value"))
    weights = remap.bilinear_weights(spark, remap.Grid(fix.NX, fix.NY, -180.0, 15.0, -75.0, 10.0), TARGET.cells(spark))
    return remap.apply_weights(cells, weights, ["iz"], "all").select(*CELL, r6())


@query(f"""WITH {G}, src AS (SELECT iy, ix, radians(lat) AS la, radians(lon + 2 * sin(radians(lat))) AS lo FROM grid),
  tg AS (SELECT y.i::INT AS dy, x.i::INT AS dx, radians(-70.0 + 14.0 * y.i) AS la, radians(-170.0 + 30.0 * x.i) AS lo FROM range(11) y(i), range(12) x(i)),
  d AS (SELECT dy, dx, iy, ix, sqrt((cos(t.la) * cos(t.lo) - cos(s.la) * cos(s.lo)) ** 2 + (cos(t.la) * sin(t.lo) - cos(s.la) * sin(s.lo)) ** 2 + (sin(t.la) - sin(s.la)) ** 2) AS d FROM tg t, src s),
  k AS (SELECT *, row_number() OVER (PARTITION BY dy, dx ORDER BY round(d, 12), iy, ix) AS n FROM d QUALIFY n <= 4), c AS (SELECT iz, iy, ix, avg(thetao) AS v FROM g GROUP BY ALL)
  SELECT iz, dy AS iy, dx AS ix, round(sum(v / d) / sum(1 / d), 6) AS value FROM k JOIN c USING (iy, ix) GROUP BY ALL""")
def remap_distance(spark, sf_dir):
    cells = fix.series(spark, sf_dir).groupBy(*CELL).agg(F.avg("value").alias("value"))
    source = _grid(spark).withColumn("lon", F.col("lon") + 2 * F.sin(F.radians("lat")))
    weights = remap.distance_weights(source, remap.Grid(12, 11, -170.0, 30.0, -70.0, 14.0).cells(spark), tile=40.0)
    return remap.apply_weights(cells, weights, ["iz"], "renormalise").select(*CELL, r6())


@query("SELECT l_returnflag AS source, l_linestatus AS status, CASE l_returnflag WHEN 'A' THEN 'lonlat' WHEN 'N' THEN 'curvilinear' ELSE 'Unstructured' END AS gridtype, CASE l_returnflag WHEN 'A' THEN 'bilinear' ELSE 'distance_weighted' END AS method, count(*) AS n FROM lineitem GROUP BY ALL")
def resolve_method(spark, sf_dir):
    kind = F.when(F.col("l_returnflag") == "A", "lonlat").when(F.col("l_returnflag") == "N", "curvilinear").otherwise("Unstructured")
    rows = fix.table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("status"), kind.alias("gridtype")).agg(F.count("*").alias("n"))
    return remap.resolve_method(rows)


@query(f"""WITH {G}, a AS (SELECT model, count(DISTINCT lon) AS width, count(DISTINCT lat) AS height, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM g GROUP BY model)
  SELECT model, width, height, (x1 - x0) / nullif(width - 1, 0) AS x_step, -(y1 - y0) / nullif(height - 1, 0) AS y_step, x0 - (x1 - x0) / nullif(width - 1, 0) / 2 AS x_origin, y1 + (y1 - y0) / nullif(height - 1, 0) / 2 AS y_origin FROM a""")
def raster_transform(spark, sf_dir):
    return remap.raster_transform(fix.series(spark, sf_dir), ["model"])


_CORNERS = """tg AS (SELECT y.i::INT AS dy, x.i::INT AS dx, (-72.4::DOUBLE + 5.1::DOUBLE * y.i + 75) / 10 AS fy, (((-176.3::DOUBLE + 7.7::DOUBLE * x.i + 180) / 15) % 24) AS fx FROM range(29) y(i), range(46) x(i)),
  t AS (SELECT *, floor(fy)::INT AS y0, floor(fx)::INT AS x0, fy - floor(fy) AS ty, fx - floor(fx) AS tx FROM tg WHERE fy BETWEEN 0 AND 15),
  w AS (SELECT dy, dx, y0 + a.i AS iy, (x0 + b.i) % 24 AS ix, (CASE a.i WHEN 1 THEN ty ELSE 1 - ty END) * (CASE b.i WHEN 1 THEN tx ELSE 1 - tx END) AS w FROM t, range(2) a(i), range(2) b(i))"""


@query(f"""WITH {G}, {_CORNERS}, c AS (SELECT time, iy, ix, avg(thetao) AS v FROM g GROUP BY ALL)
  SELECT time, dy AS iy, dx AS ix, round(sum(w * v) / sum(w), 6) AS value FROM w JOIN c USING (iy, ix) WHERE w > 0 GROUP BY ALL""")
def prepare_monthly(spark, sf_dir):
    weights = remap.bilinear_weights(spark, remap.Grid(fix.NX, fix.NY, -180.0, 15.0, -75.0, 10.0), TARGET.cells(spark))
    return jobs.prepare_monthly(fix.series(spark, sf_dir), ["variable"], weights, "renormalise").select("time", "iy", "ix", r6())


@query(f"""WITH q AS ({_bins_sql(FINE_BINS)}) SELECT label, 100 AS scale_factor, 'int16' AS encoded_dtype, -32768 AS nodata, 0 AS "offset", min(value) AS min_real, max(value) AS max_real,
  min(round_even(value * 100, 0)::INT) AS min_encoded, max(round_even(value * 100, 0)::INT) AS max_encoded FROM q GROUP BY label""")
def deliver(spark, sf_dir):
    wide = checkpointed(_wide(spark, sf_dir))
    table = spark.createDataFrame(list(FINE_BINS), "label string, lower double, upper double")
    return jobs.deliver(fix.with_top_gap(_base(wide)), _layers(spark, sf_dir, wide), table, ["label"], F.lit(100))[1]


# ------------------------------------------------------------------------------------- statistics


_AUDITED = "SELECT *, CASE model WHEN 'M1' THEN thetao + 273.15 ELSE thetao END AS v, CASE model WHEN 'M2' THEN depth * 100 ELSE depth END AS z FROM g"


@query(f"""WITH {G}, x AS ({_AUDITED}), s AS (SELECT model, scenario, min(concat_ws('/', model, scenario, strftime(time, '%Y%m'))) AS path, max(v) AS sx, max(z) AS zx FROM x GROUP BY ALL), b AS (SELECT max(thetao) AS bx FROM base),
  k AS (SELECT *, CASE WHEN model = 'M2' THEN '0.01' ELSE '1' END AS suggested_z_scale, CASE WHEN sx > 100 AND bx < 100 THEN 'K_to_C' ELSE '1' END AS suggested_var_scale FROM s, b)
  SELECT model, scenario, path, round(sx, 2) AS source_max, suggested_z_scale, suggested_var_scale, CASE WHEN suggested_z_scale <> '1' THEN 'review_depth_units' WHEN suggested_var_scale <> '1' THEN 'review_variable_units' ELSE 'ok_or_review_metadata' END AS status FROM k""")
def audit_inputs(spark, sf_dir):
    s = fix.series(spark, sf_dir)
    kelvin, cm = F.col("model") == "M1", F.col("model") == "M2"
    cells = s.withColumns({"value": F.when(kelvin, F.col("value") + 273.15).otherwise(F.col("value")), "depth": F.when(cm, F.col("depth") * 100).otherwise(F.col("depth"))})
    path = F.concat_ws("/", "model", "scenario", F.date_format("time", "yyyyMM"))
    files = s.select("model", "scenario", "variable", path.alias("path"), F.when(kelvin, "K").otherwise("degC").alias("source_units"), F.when(cm, "cm").otherwise("m").alias("z_units")).distinct()
    base = _clim(spark, sf_dir, "thetao", "hist").withColumn("baseline_units", F.lit("degC"))
    rows = jobs.audit_inputs(cells, files, base, ["model", "scenario", "variable"])
    return rows.select("model", "scenario", "path", F.round("source_max", 2).alias("source_max"), "suggested_z_scale", "suggested_var_scale", "status")


@query(f"""WITH {G}, p AS (SELECT *, sin(radians(least(lat + 5, 90))) - sin(radians(greatest(lat - 5, -90))) AS area FROM g WHERE NOT (model = 'M2' AND ix = 23)),
  sl AS (SELECT model, iz, time, sum(thetao * area) / sum(area) AS m FROM p GROUP BY ALL), mn AS (SELECT model, round(avg(m), 6) AS mean FROM sl GROUP BY model),
  gr AS (SELECT model, count(DISTINCT lon) AS xsize, count(DISTINCT lat) AS ysize, max(lon) - min(lon) AS dx, max(lat) - min(lat) AS dy, min(thetao) AS min, max(thetao) AS max, max(depth) AS z_max, count(DISTINCT depth) AS levels FROM p GROUP BY model),
  bg AS (SELECT count(DISTINCT lon) AS bx, count(DISTINCT lat) AS bye, max(lon) - min(lon) AS bdx, max(lat) - min(lat) AS bdy FROM base),
  j AS (SELECT *, xsize = bx AND ysize = bye AND abs(dx - bdx) < 1e-6 AND abs(dy - bdy) < 1e-6 AS same FROM gr JOIN mn USING (model), bg)
  SELECT model, xsize, ysize, min, max, mean, z_max, levels, same AND model <> 'M1' AS grid_matches_baseline, CASE WHEN model = 'M1' THEN 'unexpected_resolution' WHEN NOT same THEN 'grid_mismatch' ELSE 'ok' END AS status FROM j""")
def audit_products(spark, sf_dir):
    s = fix.series(spark, sf_dir).where("NOT (model = 'M2' AND ix = 23)")
    meta = s.select("model", "variable", F.when(F.col("model") == "M1", "0p25").otherwise("0p05").alias("resolution")).distinct()
    base = _clim(spark, sf_dir, "thetao", "hist").withColumn("baseline_path", F.lit("glorys/thetao"))
    known = spark.createDataFrame([("glorys", "thetao", "0p05", False, "glorys/thetao")], "family string, variable string, resolution string, is_fallback boolean, baseline_path string")
    rows = jobs.audit_products(s, meta, base, F.broadcast(known), ["model"], 5.0)
    return rows.select("model", "xsize", "ysize", "min", "max", r6("mean"), "z_max", "levels", "grid_matches_baseline", "status")




@query("SELECT event_type AS variable, min(value) AS min, max(value) AS max, count(value) AS n FROM (SELECT *, min(ts) OVER (PARTITION BY event_type) AS first_ts FROM events) WHERE ts = first_ts GROUP BY ALL")
def field_stats_first_step(spark, sf_dir):
    return audit.first_step_stats(fix.daily(spark, sf_dir), ["variable"])


@query(f"WITH {G} SELECT model, scenario, min(thetao) AS min, max(thetao) AS max, count(thetao) AS n FROM g GROUP BY ALL")
def field_stats(spark, sf_dir):
    return audit.field_stats(fix.series(spark, sf_dir), ["model", "scenario"])


@query(f"""WITH {G}, a AS (SELECT *, sin(radians(least(lat + 5, 90))) - sin(radians(greatest(lat - 5, -90))) AS area FROM g),
  s AS (SELECT model, scenario, iz, time, sum(thetao * area) / sum(area) AS m FROM a GROUP BY ALL) SELECT model, scenario, round(avg(m), 6) AS mean, count(m) AS slices FROM s GROUP BY ALL""")
def field_mean(spark, sf_dir):
    return audit.field_mean(fix.series(spark, sf_dir), ["model", "scenario"], ["iz", "time"], 5.0).select("model", "scenario", r6("mean"), "slices")


@query(f"WITH {G} SELECT model, scenario, min(depth) AS z_min, max(depth) AS z_max, count(DISTINCT depth) AS levels FROM g GROUP BY ALL")
def level_stats(spark, sf_dir):
    return audit.level_stats(fix.series(spark, sf_dir), ["model", "scenario"])


# ------------------------------------------------------------------------------------- delivery


@query(f"WITH {G} SELECT win AS \"window\", lon AS x, lat AS y, depth, round(thetao, 6) AS thetao_degC FROM (SELECT *, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS t FROM clim) WHERE t IS NOT NULL")
def export_parquet_table(spark, sf_dir):
    cells = fix.with_top_gap(climate.climatology(fix.series(spark, sf_dir), _windows(spark), PLACE)).withColumn("value", F.round("value", 6))
    return products.export_table(cells, ["window"], F.col("depth"), "thetao_degC")


@query(f"WITH {G} SELECT 'hist' AS \"window\", lon AS x, lat AS y, concat(lpad((floor(depth)::INT)::VARCHAR, 4, '0'), 'p', lpad((round((depth - floor(depth)) * 1000)::INT)::VARCHAR, 3, '0'), 'm') AS depth, round(thetao, 6) AS thetao_degC FROM base WHERE iz IN (0, 3)")
def export_csv_table(spark, sf_dir):
    cells = _clim(spark, sf_dir, "thetao", "hist").where("iz IN (0, 3)").withColumns({"value": F.round("value", 6), "window": F.lit("hist")})
    return products.export_table(cells, ["window"], fx.depth_token(F.col("depth")), "thetao_degC")


def _coded(spark, sf_dir):
    both = _base(_wide(spark, sf_dir)).unionByName(_base(_wide(spark, sf_dir, "chl")).withColumn("value", F.col("value") / 1000))
    both = checkpointed(fix.with_top_gap(both).withColumn("value", F.round("value", 6)))  # read for the types and for the rows
    return products.encode_integer(both, ["variable"], fx.scale_factor(F.concat(F.lit("future/"), F.col("variable"), F.lit("/x.nc"))))


_CODED = f"""WITH {G}, c AS (SELECT 'thetao' AS variable, iz, iy, ix, round(thetao, 6) AS x, 100 AS scale_factor FROM base UNION ALL SELECT 'chl', iz, iy, ix, round(chl / 1000, 6), 10000 FROM base),
  v AS (SELECT variable, iz, iy, ix, scale_factor, CASE WHEN iz >= (ix + iy) % 4 THEN x END AS x FROM c), r AS (SELECT *, round_even(x * scale_factor, 0) AS code FROM v),
  k AS (SELECT variable, CASE WHEN min(code) > -32768 AND max(code) <= 32767 THEN 'int16' ELSE 'int32' END AS encoded_dtype FROM r GROUP BY variable),
  o AS (SELECT r.*, encoded_dtype, CASE encoded_dtype WHEN 'int16' THEN -32768 ELSE -2147483648 END::INT AS nodata FROM r JOIN k USING (variable))"""


@query(f"{_CODED} SELECT variable, iz, iy, ix, coalesce(code::INT, nodata) AS stored_value, scale_factor, encoded_dtype, nodata FROM o")
def encode_integer(spark, sf_dir):
    return _coded(spark, sf_dir).select("variable", *CELL, "stored_value", "scale_factor", "encoded_dtype", "nodata")


@query(f'{_CODED} SELECT variable, scale_factor, encoded_dtype, nodata, 0 AS "offset", min(x) AS min_real, max(x) AS max_real, min(code::INT) AS min_encoded, max(code::INT) AS max_encoded FROM o GROUP BY ALL')
def encode_manifest(spark, sf_dir):
    return products.encode_manifest(_coded(spark, sf_dir), ["variable"])


@query(f"WITH {G} SELECT concat(lpad((floor(depth)::INT)::VARCHAR, 4, '0'), 'p', lpad((round((depth - floor(depth)) * 1000)::INT)::VARCHAR, 3, '0'), 'm') AS depth_token, count(*) AS cells, round(avg(thetao), 6) AS value FROM base WHERE depth <= 500 GROUP BY ALL")
def split_by_depth(spark, sf_dir):
    parts = products.split_by_depth(_clim(spark, sf_dir, "thetao", "hist"), ["variable"], 500.0)
    return parts.groupBy("depth_token").agg(F.count("*").alias("cells"), F.round(F.avg("value"), 6).alias("value"))


@query(f"""WITH {G}, {LAYERS}, fine AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {a}, {b})" for n, a, b in FINE_BINS)}) t(label, a, b)),
  d AS (SELECT b.iz, b.iy, b.ix, b.thetao + (f.thetao - b.thetao) AS v FROM (SELECT iz, iy, ix, CASE WHEN iz >= (ix + iy) % 4 THEN thetao END AS thetao FROM base) b LEFT JOIN fut f USING (iz, iy, ix)),
  t AS (SELECT iz, iy, ix, {TOP} AS v FROM d)
  SELECT label, iy, ix, round(sum(v * (upper - lower)) / sum(CASE WHEN v IS NOT NULL THEN upper - lower END), 6) AS value, count(DISTINCT iz) AS levels FROM t JOIN layers USING (iz) JOIN fine ON depth >= a AND depth < b GROUP BY label, iy, ix""")
def flagship(spark, sf_dir):
    """Two climatologies, their change, applied to the baseline, top fill, fine depth bins."""
    wide = checkpointed(_wide(spark, sf_dir).withColumn("hist", F.when(F.expr("iz >= (ix + iy) % 4"), F.col("hist"))))
    out = columns.fill_top(climate.apply_delta(_base(wide), _change(wide), CELL), ["variable", "iy", "ix"])
    table = spark.createDataFrame(list(FINE_BINS), "label string, lower double, upper double")
    return columns.depth_bins(out, _layers(spark, sf_dir, wide), table, ["iy", "ix"]).select("label", "iy", "ix", r6(), "levels")
