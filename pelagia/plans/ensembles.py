"""Queries over ensembles: every member and window of a variable downscaled in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.operators import climate, fill
from pelagia.plans import fields
from pelagia.plans.downscale import ensemble_downscale as run_ensemble
from pelagia.plans.fields import CELL, MASK, PLACE, G, r6
from pelagia.plans.registry import query
from pelagia.sources import fixtures as fix
from pelagia.staging import checkpointed

MEMBERS = ["model", "window"]
_TOP = "CASE WHEN v IS NULL AND count(v) OVER c = 0 THEN first_value(v IGNORE NULLS) OVER (PARTITION BY model, win, iy, ix ORDER BY iz ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) ELSE v END"

#: Every model and future window: gaps filled (up to 3 steps), top fill, fallback, half of it added, top fill, cut at both bounds.
ENSEMBLE = f"""WITH {G},
mem AS (SELECT model, win, iz, iy, ix, avg(thetao) AS thetao FROM g JOIN win ON time BETWEEN s AND e WHERE win <> 'hist' GROUP BY ALL),
an AS (SELECT m.model, m.win, iz, iy, ix, CASE WHEN (7 * ix + 11 * iy + 3 * iz) % 5 >= 2 THEN m.thetao - b.thetao END AS v FROM mem m JOIN (SELECT iz, iy, ix, thetao FROM base) b USING (iz, iy, ix)),
dom AS (SELECT r.model, r.win, b.iz, b.iy, b.ix, an.v FROM (SELECT iz, iy, ix FROM base) b CROSS JOIN (SELECT DISTINCT model, win FROM an) r LEFT JOIN an USING (model, win, iz, iy, ix)),
pr AS (SELECT p.model, p.win, p.iz, p.iy, p.ix, d.v, greatest(abs(d.iy - p.iy), abs(d.ix - p.ix)) AS rad, (d.iy - p.iy) * (d.iy - p.iy) + (d.ix - p.ix) * (d.ix - p.ix) AS d2
  FROM dom p JOIN dom d ON p.model = d.model AND p.win = d.win AND p.iz = d.iz AND p.v IS NULL AND d.v IS NOT NULL AND abs(d.iy - p.iy) <= 3 AND abs(d.ix - p.ix) <= 3),
ri AS (SELECT model, win, iz, iy, ix, rad, count(*) AS n, sum(v / d2) AS wv, sum(1.0::DOUBLE / d2) AS w FROM pr GROUP BY ALL),
gr AS (SELECT model, win, iz, iy, ix, rad, sum(n) OVER q AS n, sum(wv) OVER q AS wv, sum(w) OVER q AS w FROM ri WINDOW q AS (PARTITION BY model, win, iz, iy, ix ORDER BY rad)),
iw AS (SELECT model, win, iz, iy, ix, coalesce(arg_min(wv / w, rad) FILTER (WHERE n >= 4), arg_min(wv / w, rad)) AS fill FROM gr GROUP BY ALL),
e1 AS (SELECT o.model, o.win, o.iz, o.iy, o.ix, coalesce(o.v, i.fill) AS v, o.v IS NULL AND i.fill IS NOT NULL AS filled FROM dom o LEFT JOIN iw i USING (model, win, iz, iy, ix)),
e2 AS (SELECT model, win, iz, iy, ix, filled, {_TOP} AS v, v IS NULL AS was FROM e1 WINDOW c AS (PARTITION BY model, win, iy, ix ORDER BY iz)),
e4 AS (SELECT model, win, e2.iz, e2.iy, e2.ix, (CASE WHEN e2.iz >= (e2.ix + e2.iy) % 4 THEN b.thetao END) + 0.5 * coalesce(e2.v, 0) AS v, coalesce(e2.v, 0) AS anomaly_value,
  CASE WHEN e2.v IS NULL THEN 'fallback' WHEN filled THEN 'filled' WHEN was THEN 'top' END AS fill_kind FROM e2 JOIN (SELECT iz, iy, ix, thetao FROM base) b USING (iz, iy, ix)),
e5 AS (SELECT model, win, iz, iy, ix, anomaly_value, fill_kind, {_TOP} AS v FROM e4 WINDOW c AS (PARTITION BY model, win, iy, ix ORDER BY iz))"""


def _ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = [w for w in fix.WINDOWS if w[0] != "hist"]
    base = checkpointed(fields._base(fields._wide(spark, sf_dir)))
    means = climate.window_means(fix.series(spark, sf_dir), windows, ["model", *PLACE])
    each = [means.where(f"{w[0]}_rows > 0").select("model", F.lit(w[0]).alias("window"), *PLACE, F.col(w[0]).alias("future")) for w in windows]
    both = climate.merge_time(*each).join(base.select("variable", *CELL, F.col("value").alias("past")), ["variable", *CELL])
    anomaly = fix.with_gaps(both.withColumn("value", F.col("future") - F.col("past")))
    mask = fields._grid(spark).where(MASK).withColumn("value", F.lit(1.0))
    return run_ensemble(fix.with_top_gap(base), anomaly, MEMBERS, mask=mask, scale=0.5, max_steps=3, fallback=0.0, bounds={"thetao": (20.0, 30.0)})


@query(f"""{ENSEMBLE} SELECT model, win AS "window", iz, iy, ix, round(CASE WHEN v < 20 THEN 20 WHEN v > 30 THEN 30 ELSE v END, 6) AS value, round(anomaly_value, 6) AS anomaly_value, fill_kind,
  CASE WHEN v < 20 THEN 'below' WHEN v > 30 THEN 'above' END AS clipped FROM e5""")
def ensemble_downscale(spark, sf_dir):
    return _ensemble(spark, sf_dir).select(*MEMBERS, *CELL, r6(), r6("anomaly_value"), "fill_kind", "clipped")


@query(f"""{ENSEMBLE} SELECT model, win AS "window", iz, count(*) AS cells, count(v) AS valid, count(*) FILTER (WHERE fill_kind = 'filled') AS n_filled, count(*) FILTER (WHERE fill_kind = 'top') AS n_top, count(*) FILTER (WHERE fill_kind = 'forced') AS n_forced,
  count(*) FILTER (WHERE fill_kind = 'fallback') AS n_fallback, count(*) FILTER (WHERE v < 20) AS n_below, count(*) FILTER (WHERE v > 30) AS n_above FROM e5 GROUP BY ALL""")
def ensemble_report(spark, sf_dir):
    return fill.review_report(_ensemble(spark, sf_dir), [*MEMBERS, "iz"])


@query(f"""{ENSEMBLE}, wk AS (SELECT model, win, iz, iy, ix, coalesce(min(rad) FILTER (WHERE n >= 4), min(rad)) AS ring FROM gr GROUP BY ALL),
  wt AS (SELECT pr.model, pr.win, pr.iz, pr.iy, pr.ix, count(*) AS donors, max(1.0::DOUBLE / d2) / sum(1.0::DOUBLE / d2) AS heaviest FROM pr JOIN wk USING (model, win, iz, iy, ix) WHERE pr.rad <= ring GROUP BY ALL)
  SELECT model, win AS "window", iz, iy, ix, donors, round(heaviest, 6) AS heaviest, 1.0::DOUBLE AS total FROM wt""")
def ensemble_fill_weights(spark, sf_dir):
    """The donors of every field's gaps, as the shared table of their patterns gives them."""
    base = checkpointed(fields._base(fields._wide(spark, sf_dir)))
    windows = [w for w in fix.WINDOWS if w[0] != "hist"]
    means = climate.window_means(fix.series(spark, sf_dir), windows, ["model", *PLACE])
    each = [means.where(f"{w[0]}_rows > 0").select("model", F.lit(w[0]).alias("window"), "variable", *CELL, F.col(w[0]).alias("value")) for w in windows]
    from pelagia.plans.downscale import ensemble_domain

    domain = checkpointed(ensemble_domain(base.select("variable", *CELL, "value").withColumn("wet", F.lit(True)), fix.with_gaps(climate.merge_time(*each)), MEMBERS))
    patterns = checkpointed(fill.gap_patterns(domain, MEMBERS, ["variable", "iz"]))
    keys = ["variable", "iz", "pattern"]
    shown = patterns.groupBy(*keys).agg(F.min(F.struct(*MEMBERS)).alias("_one")).select(*keys, "_one.*")
    solved = fill.fill_weights(domain.join(shown, [*MEMBERS, "variable", "iz"]), keys, max_steps=3)
    counted = solved.groupBy(*keys, "iy", "ix").agg(F.count("*").alias("donors"), F.round(F.max("w"), 6).alias("heaviest"), F.round(F.sum("w"), 6).alias("total"))
    return patterns.join(counted, keys).select(*MEMBERS, *CELL, "donors", "heaviest", "total")
