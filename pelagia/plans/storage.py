"""Queries over stored tables and files: pruned reads, file listings, CSV manifests, commits, axes, buckets, raster blocks and pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagia.operators import climate, manifest, products, remap
from pelagia.plans import fields, jobs
from pelagia.plans.fields import _CODED, CELL, LAYERS, PLACE, TARGET, G, r6
from pelagia.plans.files import M
from pelagia.plans.registry import ORACLE_SQL, query
from pelagia.schema import FINE_BINS, filled_template, spec
from pelagia.sources import fixtures as fix
from pelagia.sources import store
from pelagia.staging import checkpointed, staged_path


# ------------------------------------------------------------------------------------- stored cells


@query(f"WITH {G} SELECT win AS \"window\", iz, iy, ix, round(thetao, 6) AS value FROM clim WHERE win = 'futB'")
def stored_window(spark, sf_dir):
    """A window's climatology from cells stored by variable and year: both choose the folders that are read."""
    cells, years = staged_path(spark, "cells"), staged_path(spark, "years")
    store.write_cells(fix.series(spark, sf_dir).unionByName(fix.series(spark, sf_dir, "chl")), cells)
    store.calendar(fields._windows(spark)).write.parquet(years)
    wanted = spark.read.parquet(years).where("window = 'futB'")
    read = store.read_window_years(spark, cells, "thetao", wanted)
    return read.groupBy("window", *CELL).agg(F.avg("value").alias("value")).select("window", *CELL, r6())


@query(f"""WITH {G} SELECT win AS "window", iz, count(*) AS cells, round(sum(CASE WHEN win = 'futA' THEN thetao + 1 ELSE thetao END), 4) AS total, CASE win WHEN 'futA' THEN 4 WHEN 'futB' THEN 3 ELSE 1 END AS version FROM clim GROUP BY ALL""")
def incremental_commit(spark, sf_dir):
    """Four runs over one store: the first does a window, the second dies before its commit, the third does what is missing in two parts, the last replaces one."""
    means = climate.climatology(fix.series(spark, sf_dir), fields._windows(spark), PLACE).select("window", *CELL, "value")
    means = checkpointed(means)
    tree = store.Store(spark, staged_path(spark, "tree"), ["window"])
    every = means.select("window").distinct()
    tree.commit(tree.stage(means.where("window = 'hist'").withColumn("version", F.lit(1))))
    tree.stage(means.where("window = 'futA'").withColumn("version", F.lit(2)))  # never committed
    left = means.join(F.broadcast(tree.missing(every)), "window", "left_semi").withColumn("version", F.lit(3))
    tree.commit(tree.stage(left.where("window = 'futA'")), tree.stage(left.where("window <> 'futA'")))
    tree.commit(tree.stage(means.where("window = 'futA'").withColumns({"value": F.col("value") + 1, "version": F.lit(4)})))
    return tree.read().groupBy("window", "iz", "version").agg(F.count("*").alias("cells"), F.round(F.sum("value"), 4).alias("total"))


# ------------------------------------------------------------------------------------- files


@query("""WITH d AS (SELECT event_type AS variable, ts::DATE AS day, (user_id // 15)::INT AS iy, (user_id % 15)::INT AS ix, avg(value) AS v FROM events GROUP BY ALL),
  f AS (SELECT variable, date_trunc('month', day)::DATE AS month, CASE WHEN max(ascii(variable)) % 2 = 1 THEN 1 ELSE count(DISTINCT day) END AS n_files FROM d GROUP BY 1, 2),
  c AS (SELECT variable, date_trunc('month', day)::DATE AS month, iy, ix, avg(v) AS v FROM d GROUP BY ALL)
  SELECT variable, month, iy, ix, n_files, n_files AS n_ok, CASE WHEN n_files = 1 THEN 'monthly' ELSE 'daily' END AS source_step, round(v, 6) AS value FROM c JOIN f USING (variable, month)""")
def stored_files(spark, sf_dir):
    """Daily and monthly fields as files: listed, verified against a manifest, their step told by the files of each month, then monthly means."""
    root = staged_path(spark, "fields")
    day = fix.daily(spark, sf_dir).groupBy("variable", F.to_date("time").alias("time"), "iy", "ix").agg(F.avg("value").alias("value"))
    day = checkpointed(day.withColumns({"year": F.year("time"), "month": F.month("time")}))
    monthly = F.ascii("variable") % 2 == 1
    daily = day.where(~monthly).withColumn("day", F.dayofmonth("time"))
    daily.repartition("variable", "year", "month", "day").write.partitionBy("variable", "year", "month", "day").csv(f"{root}/daily")
    means = day.where(monthly).groupBy("variable", "year", "month", "iy", "ix").agg(F.avg("value").alias("value")).withColumn("time", F.make_date("year", "month", F.lit(15)))
    means.select("time", "iy", "ix", "value", "variable", "year", "month").repartition("variable", "year", "month").write.partitionBy("variable", "year", "month").csv(f"{root}/monthly")
    stored = store.list_files(spark, root, "part-*", content=True)
    made = stored.select(F.col("path").alias("filename"), F.lit("sha256").alias("checksum_type"), F.upper(F.sha2("content", 256)).alias("checksum"))
    made.write.parquet(f"{root}-manifest")  # what a producer says of its files
    checked = manifest.verify_checksums(stored.withColumnRenamed("path", "filename").select("filename", "content"), spark.read.parquet(f"{root}-manifest"))
    part = lambda name, kind: F.regexp_extract("filename", f"{name}=([^/]+)", 1).cast(kind).alias(name)
    files = checkpointed(checked.select("filename", "status", part("variable", "string"), part("year", "int"), part("month", "int")))
    steps = store.month_steps(files, ["variable"])
    ok = files.groupBy("variable", F.make_date("year", "month", F.lit(1)).alias("month")).agg(F.count_if(F.col("status") == "ok").alias("n_ok"))
    schema = "time date, iy int, ix int, value double, variable string, year int, month int"
    cells = spark.read.schema(f"{schema}, day int").csv(f"{root}/daily").drop("day").unionByName(spark.read.schema(schema).csv(f"{root}/monthly"))
    out = climate.as_monthly(cells.select("variable", "time", "iy", "ix", "value"), ["variable"], steps)
    return out.withColumnRenamed("time", "month").join(steps.select("variable", "month", "n_files"), ["variable", "month"]).join(ok, ["variable", "month"]).select("variable", "month", "iy", "ix", "n_files", "n_ok", "source_step", r6())


@query(f"""WITH {M} SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN concat('"', title, '", of ', source_id) END AS note, CASE WHEN o_orderkey % 50 <> 0 THEN time_start END AS time_start,
  CASE WHEN o_orderkey % 50 = 0 THEN concat('"', title, '",', o_orderkey) END AS bad_row FROM m""")
def manifest_csv(spark, sf_dir):
    """A manifest written with quotes inside its texts and read back under a schema; every row that doesn't fit is reported."""
    at = staged_path(spark, "manifest")
    m = fix.files(spark, sf_dir)
    good = m.where("o_orderkey % 50 <> 0").select(F.concat(F.lit('"'), F.col("title"), F.lit('", of '), F.col("source_id")).alias("note"), "o_orderkey", "time_start")
    good.write.option("quoteAll", True).option("escape", '"').csv(f"{at}/rows")
    m.where("o_orderkey % 50 = 0").select(F.concat(F.lit('"'), F.col("title"), F.lit('",'), F.col("o_orderkey").cast("string"))).write.text(f"{at}/cut")  # a value short
    rows, bad = store.read_manifest(spark, f"{at}/*", "note string, o_orderkey long, time_start date", header=False)
    told = bad.select(F.regexp_extract("bad_row", r",(\d+)\s*$", 1).cast("long").alias("o_orderkey"), F.lit(None).cast("string").alias("note"), F.lit(None).cast("date").alias("time_start"), F.rtrim("bad_row").alias("bad_row"))
    return rows.select("o_orderkey", "note", "time_start", F.lit(None).cast("string").alias("bad_row")).unionByName(told)


# ------------------------------------------------------------------------------------- grids and axes


@query(f"""WITH {G}, tgt AS (SELECT * FROM (VALUES (0, 0.3), (1, 5), (2, 29.445), (3, 100), (4, 453.938), (5, 1000), (6, 2000)) t(iz_out, d)),
  c AS (SELECT model, iz, iy, ix, depth, avg(thetao) AS v FROM g WHERE NOT (model = 'M2' AND iz = 3) GROUP BY ALL),
  lv AS (SELECT DISTINCT model, iz, depth FROM c),
  src AS (SELECT model, iz AS z0, depth AS d0, lead(iz) OVER (PARTITION BY model ORDER BY depth) AS z1, lead(depth) OVER (PARTITION BY model ORDER BY depth) AS d1 FROM lv),
  hit AS (SELECT model, iz_out, d, z0, z1, CASE WHEN d1 IS NULL THEN 0 ELSE (d - d0) / (d1 - d0) END AS p FROM tgt JOIN src ON d >= d0 AND (d < d1 OR (d1 IS NULL AND d = d0))),
  wt AS (SELECT model, iz_out, d, z0 AS iz, 1 - p AS w FROM hit UNION ALL SELECT model, iz_out, d, z1, p FROM hit),
  s AS (SELECT model, iy, ix, iz_out, d, sum(w * v) AS sv, sum(w) AS sw FROM c JOIN wt USING (model, iz) WHERE w > 0 GROUP BY ALL)
  SELECT model, iy, ix, iz_out AS iz, d::DOUBLE AS depth, round(CASE WHEN sw >= 0.5 THEN sv / sw END, 6) AS value FROM s""")
def axes_to_reference(spark, sf_dir):
    """Three models, one with its depths in centimetres and one without a level, on the levels of one reference axis."""
    means = fix.series(spark, sf_dir).where("NOT (model = 'M2' AND iz = 3)").groupBy("model", *CELL, "depth").agg(F.avg("value").alias("value"))
    cells = checkpointed(means.withColumn("depth", F.when(F.col("model") == "M1", F.round(F.col("depth") * 100, 1)).otherwise(F.col("depth"))))
    target = spark.createDataFrame(list(enumerate((0.3, 5.0, 29.445, 100.0, 453.938, 1000.0, 2000.0))), "iz int, depth double")
    units = cells.select("model").distinct().withColumn("z_units", F.when(F.col("model") == "M1", "cm").otherwise("m"))
    return jobs.all_to_reference_levels(cells, target, ["model"], ["iy", "ix"], units).select("model", "iy", "ix", "iz", "depth", r6())


@query(ORACLE_SQL["remap_bilinear"])
def remap_bucketed(spark, sf_dir):
    """The bilinear remap with weights and fields written in buckets of source cells, which meet without an exchange."""
    cells = fix.series(spark, sf_dir, land=False).groupBy(*CELL).agg(F.avg("value").alias("value"))
    weights = remap.bilinear_weights(spark, fields.remap.Grid(fix.NX, fix.NY, -180.0, 15.0, -75.0, 10.0), TARGET.cells(spark))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return remap.apply_weights(remap.bucketed_field(cells, n), remap.bucketed_weights(weights, n), ["iz"], "all").select(*CELL, r6())


@query(f"""WITH {G}, src AS (SELECT iy, ix, radians(lat) AS la, radians(lon) AS lo FROM grid WHERE NOT (iy BETWEEN 4 AND 11 AND ix BETWEEN 6 AND 15)),
  tg AS (SELECT y.i::INT AS dy, x.i::INT AS dx, radians(-63.0 + 9.0 * y.i) AS la, radians(-171.0 + 20.0 * x.i) AS lo FROM range(15) y(i), range(18) x(i)),
  d AS (SELECT dy, dx, iy, ix, sqrt((cos(t.la) * cos(t.lo) - cos(s.la) * cos(s.lo)) ** 2 + (cos(t.la) * sin(t.lo) - cos(s.la) * sin(s.lo)) ** 2 + (sin(t.la) - sin(s.la)) ** 2) AS d FROM tg t, src s),
  k AS (SELECT *, row_number() OVER (PARTITION BY dy, dx ORDER BY round(d, 12), iy, ix) AS n FROM d QUALIFY n <= 4), c AS (SELECT iz, iy, ix, avg(thetao) AS v FROM g GROUP BY ALL)
  SELECT iz, dy AS iy, dx AS ix, round(sum(v / d) / sum(1 / d), 6) AS value FROM k JOIN c USING (iy, ix) GROUP BY ALL""")
def remap_over_hole(spark, sf_dir):
    """The distance-weighted remap where a continent of 80 by 150 degrees has no source at all."""
    cells = fix.series(spark, sf_dir).groupBy(*CELL).agg(F.avg("value").alias("value"))
    source = fields._grid(spark).where("NOT (iy BETWEEN 4 AND 11 AND ix BETWEEN 6 AND 15)")
    weights = remap.distance_weights(source, remap.Grid(18, 15, -171.0, 20.0, -63.0, 9.0).cells(spark), tile=12.0)
    return remap.apply_weights(cells, weights, ["iz"], "renormalise").select(*CELL, r6())


@query(f"""{_CODED}, e AS (SELECT *, 15 - iy AS row, ix AS col, max(15 - iy) OVER (PARTITION BY variable, iz) AS last_row FROM o), b AS (SELECT variable, iz, row // 8 AS block_row, col // 8 AS block_col, sum(code::BIGINT)::BIGINT AS total, count(code) AS held FROM e GROUP BY ALL)
  SELECT variable, iz, block_row::INT AS block_row, block_col::INT AS block_col, held, total, 64 AS places FROM b WHERE held > 0""")
def raster_blocks(spark, sf_dir):
    """Integer rasters as blocks of 8 x 8, and what the blocks hold when their cells are told by arithmetic."""
    coded = fields._coded(spark, sf_dir).withColumns({"row": F.lit(fix.NY - 1) - F.col("iy"), "col": F.col("ix")})
    blocks = checkpointed(products.raster_blocks(coded, ["variable", "iz"], 8))
    cells = products.unblocked(blocks, ["variable", "iz"], 8)
    held = cells.groupBy("variable", "iz", F.floor(F.col("row") / 8).cast("int").alias("block_row"), F.floor(F.col("col") / 8).cast("int").alias("block_col")).agg(F.count("*").alias("held"), F.sum("stored_value").alias("total"))
    return held.join(blocks.select("variable", "iz", "block_row", "block_col", F.size("values").alias("places")), ["variable", "iz", "block_row", "block_col"])


@query(f"""WITH {G}, p AS (SELECT DISTINCT model, lon, lat FROM g),
  x AS (SELECT model, lon, row_number() OVER (PARTITION BY model ORDER BY lon) - 1 AS col FROM (SELECT DISTINCT model, lon FROM p)), y AS (SELECT model, lat, row_number() OVER (PARTITION BY model ORDER BY lat DESC) - 1 AS row FROM (SELECT DISTINCT model, lat FROM p))
  SELECT model, lon, lat, row::INT AS row, col::INT AS col FROM p JOIN x USING (model, lon) JOIN y USING (model, lat)""")
def raster_position(spark, sf_dir):
    return remap.raster_position(fix.series(spark, sf_dir).select("model", "lon", "lat").distinct(), ["model"]).select("model", "lon", "lat", "row", "col")


@query(f"""WITH {G}, d AS (SELECT model, scenario, time, iz, iy, ix, avg(thetao) AS v FROM g GROUP BY ALL) SELECT model, scenario, time, iz, iy, ix, 'monthly' AS source_step, round(v, 6) AS value FROM d""")
def prepare_monthly_fields(spark, sf_dir):
    """Monthly fields of every model, scenario and level on its own."""
    s = fix.series(spark, sf_dir)
    return climate.as_monthly(s.select("model", "scenario", "time", *CELL, "value"), ["model", "scenario"], step="daily").withColumn("source_step", F.lit("monthly")).select("model", "scenario", "time", *CELL, "source_step", r6())


# ------------------------------------------------------------------------------------- delivery


@query(f"""WITH {G}, {LAYERS}, fine AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {a}, {b})" for n, a, b in FINE_BINS)}) t(label, a, b)),
  mem AS (SELECT model, win, iz, iy, ix, avg(thetao) AS v FROM g JOIN win ON time BETWEEN s AND e WHERE win <> 'hist' GROUP BY ALL),
  pr AS (SELECT concat('layers/future/ssp585/thetao/', win, '/0p25/', model, '.nc') AS p, 'future' AS kind, iz, iy, ix, v FROM mem WHERE win = 'futB' OR model <> 'M2'
    UNION ALL SELECT 'layers/baseline/thetao/0p25/filled.nc', 'baseline', iz, iy, ix, thetao FROM base),
  q AS (SELECT p, kind, label, iy, ix, round(sum(v * (upper - lower)) / sum(upper - lower), 6) AS x FROM pr JOIN layers USING (iz) JOIN fine ON depth >= a AND depth < b GROUP BY ALL)
  SELECT p AS staged_relative_path, kind, 'thetao' AS variable, label, 100 AS scale_factor, 'int16' AS encoded_dtype, -32768 AS nodata, 0 AS "offset", min(x) AS min_real, max(x) AS max_real,
    min(round_even(x * 100, 0)::INT) AS min_encoded, max(round_even(x * 100, 0)::INT) AS max_encoded FROM q GROUP BY p, kind, label""")
def deliver_products(spark, sf_dir):
    """The whole delivery, run twice over one store: new layout before legacy, filled baseline first, first realization, depth bins, integers, manifest."""
    s = fix.series(spark, sf_dir)
    windows = [w for w in fix.WINDOWS if w[0] != "hist"]
    wide = checkpointed(climate.window_means(s, windows, ["model", *PLACE]))
    each = climate.merge_time(*[wide.where(f"{w[0]}_rows > 0").select("model", F.lit(w[0]).alias("window"), *PLACE, F.col(w[0]).alias("value")) for w in windows])
    # A second realization, that is not delivered, and a baseline that a filled one goes before.
    both = each.withColumn("realization", F.explode(F.array(F.lit("r1i1p1f1"), F.lit("r2i1p1f1")))).withColumn("value", F.when(F.col("realization") == "r1i1p1f1", F.col("value")).otherwise(F.col("value") + 1))
    base = fields._base(fields._wide(spark, sf_dir))
    path = F.concat_ws("/", "window", "realization", F.concat("model", F.lit(".nc")))
    names = [*CELL, "depth", "variable", "value"]
    cells = checkpointed(both.select(path.alias("path"), *names).unionByName(base.select(F.lit("base/filled.nc").alias("path"), *names)).unionByName(base.select(F.lit("base/plain.nc").alias("path"), *names).withColumn("value", F.col("value") - 5)))
    found = both.select("model", "realization", F.lit("ssp585").alias("scenario"), "variable", "window", F.lit("0p25").alias("resolution"), path.alias("path")).distinct()
    known = lambda name: spark.createDataFrame([("thetao", "0p25", f"base/{name}.nc")], "variable string, resolution string, path string")
    tree = products.curate(found.where("window = 'futA' AND model <> 'M2'"), found, known("plain"), known("filled"))
    tree = checkpointed(tree.withColumns({"product_type": F.lit("layers"), "file_name": F.element_at(F.split("path", "/"), -1)}))
    bins = spark.createDataFrame(list(FINE_BINS), "label string, lower double, upper double")
    delivery = store.Store(spark, staged_path(spark, "delivery"), ["staged_relative_path"])
    layers = fields._layers(spark, sf_dir)
    jobs.deliver_tree(tree.where("window = 'futA'"), cells, layers, bins, delivery, "0p25", F.lit(100))
    return jobs.deliver_tree(tree, cells, layers, bins, delivery, "0p25", F.lit(100))


# ------------------------------------------------------------------------------------- pairing and specs


@query(f"""WITH {M}, v AS (SELECT * FROM m WHERE o_orderkey % 3 <> 0),
  own AS (SELECT DISTINCT source_id, variable_id, experiment_id, member_id FROM v WHERE experiment_id <> 'historical'),
  held AS (SELECT source_id, variable_id, list(DISTINCT member_id) AS members FROM v WHERE experiment_id = 'historical' AND year(time_start) < 2010 GROUP BY ALL),
  wn AS (SELECT * FROM (VALUES ('2030-2060', 2030, 2060), ('2090-2100', 2090, 2100)) t(win, a, b)),
  nf AS (SELECT source_id, variable_id, experiment_id, member_id, win, count(*) FILTER (WHERE year(time_start) <= b AND year(time_end) >= a) AS n FROM v, wn WHERE experiment_id <> 'historical' GROUP BY ALL)
  SELECT source_id, variable_id, experiment_id, member_id, win AS "window", CASE WHEN members IS NULL THEN 'no_baseline' WHEN NOT list_contains(members, member_id) THEN 'member_mismatch' WHEN n = 0 THEN 'no_file' ELSE 'ok' END AS status
  FROM own LEFT JOIN held USING (source_id, variable_id) JOIN nf USING (source_id, variable_id, experiment_id, member_id)""")
def pairing(spark, sf_dir):
    """What every future group and window lacks to be compared with its baseline."""
    f = fix.files(spark, sf_dir).where("o_orderkey % 3 <> 0")
    future, base = f.where("experiment_id <> 'historical'"), f.where("experiment_id = 'historical' AND year(time_start) < 2010")
    windows = F.broadcast(spark.createDataFrame([("2030-2060", 2030, 2060), ("2090-2100", 2090, 2100)], "window string, a int, b int"))
    key = ["source_id", "variable_id", "experiment_id", "member_id"]
    counts = future.crossJoin(windows).groupBy(*key, "window").agg(F.count_if((F.year("time_start") <= F.col("b")) & (F.year("time_end") >= F.col("a"))).alias("n_files"))
    pairs = [climate.paired(future.where(F.col("experiment_id") == e), base, ["source_id", "variable_id"], counts.where(F.col("experiment_id") == e).withColumnRenamed("member_id", "_member"), "member_id").where("member_id = _member").drop("_member") for e in ("ssp126", "ssp585")]
    return pairs[0].unionByName(pairs[1]).select(*key, "window", "status")


@query(f"""WITH {M}, s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'TEMP' WHEN 1 THEN 'SALT' WHEN 2 THEN 'zos' ELSE 'OTHER' END AS name, source_id, experiment_id, member_id FROM m)
  SELECT o_orderkey, CASE name WHEN 'TEMP' THEN 'thetao' WHEN 'SALT' THEN 'so' ELSE name END AS variable, concat('future/', source_id, '/', member_id, '/', experiment_id, '/', CASE name WHEN 'TEMP' THEN 'thetao' WHEN 'SALT' THEN 'so' ELSE name END, '_0p05.nc') AS path FROM s WHERE name <> 'OTHER'""")
def variable_specs(spark, sf_dir):
    """A run's own specification: which variables it takes, what they become, and where their files are."""
    wanted = spec("TEMP:thetao SALT:so zos")
    k = F.col("o_orderkey") % 4
    named = fix.files(spark, sf_dir).withColumn("name", F.when(k == 0, "TEMP").when(k == 1, "SALT").when(k == 2, "zos").otherwise("OTHER"))
    names = F.broadcast(spark.createDataFrame(list(wanted.items()), "name string, variable string"))  # the run's own few
    path = filled_template("future/{model}/{member}/{scenario}/{variable}_0p05.nc", model=F.col("source_id"), member=F.col("member_id"), scenario=F.col("experiment_id"), variable=F.col("variable"))
    return named.join(names, "name").select("o_orderkey", "variable", path.alias("path"))
