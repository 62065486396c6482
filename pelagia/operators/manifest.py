"""Discovery and manifests of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.functions.fields import MEMBER, SCENARIO, member_order

GROUP = ["source_id", "experiment_id", "variable_id"]


def discover_groups(files: DataFrame, stage: str) -> DataFrame:
    """model, member, scenario, variable of the folders that hold `stage`.

    Layout <model>/<member>/<scenario>/<var>/<stage>/...; the older <model>/<scenario>/<var>/<stage>/... takes the member from
    the file's name, and only where the newer layout has nothing for that model, scenario and variable.
    """
    p = F.split("path", "/")
    at = lambda i: F.try_element_at(p, F.lit(i))
    new = files.where((at(5) == stage) & at(2).rlike(MEMBER) & at(3).rlike(SCENARIO)).select(at(1).alias("model"), at(2).alias("member"), at(3).alias("scenario"), at(4).alias("variable"), F.lit(0).alias("_rank"))
    name = F.element_at(p, -1)
    member = F.split_part(name, F.lit("_"), F.lit(5))
    old = files.where((at(4) == stage) & at(2).rlike(SCENARIO) & member.rlike(MEMBER)).select(at(1).alias("model"), member.alias("member"), at(2).alias("scenario"), at(3).alias("variable"), F.lit(1).alias("_rank"))
    both = new.unionByName(old).distinct()
    best = F.min("_rank").over(W.partitionBy("model", "scenario", "variable"))
    return both.withColumn("_best", best).where("_rank = _best").select("model", "member", "scenario", "variable").distinct()


def resolve_member(groups: DataFrame, key: Sequence[str], requested: str | None = None, strict: bool = True) -> DataFrame:
    """The one member of each group.  Requested: it must exist.  Otherwise one is used, and several are an error.

    With strict off the outcome is a status instead of an error.
    """
    members = groups.groupBy(*key).agg(F.sort_array(F.collect_set("member")).alias("members"))
    n = F.size("members")
    if requested is None:
        status = F.when(n == 1, "ok").otherwise("ambiguous")
        member = F.when(n == 1, F.get("members", F.lit(0)))
    else:
        has = F.array_contains("members", requested)
        status, member = F.when(has, "ok").otherwise("missing"), F.when(has, F.lit(requested))
    out = members.withColumns({"member": member, "status": status})
    if strict:
        out = out.withColumn("member", F.when(F.col("status") == "ok", F.col("member")).otherwise(F.raise_error(F.concat(F.lit("member is "), F.col("status")))))
    return out.drop("members")


def extract_manifest(scripts: DataFrame) -> DataFrame:
    """script, filename, url, checksum_type, checksum of the table embedded in each script's text, between its markers."""
    # The marker and the line's form are fixed by the scripts that archives write.
    mark = "EOF--dataset\\.file\\.url\\.chksum_type\\.chksum"
    body = F.regexp_extract("text", f"(?s)download_files=\"\\$\\(cat <<{mark}\\n(.*?)\\n?{mark}", 1)
    line = "^'([^']+)'\\s+'([^']+)'\\s+'([^']+)'\\s+'([^']+)'$"
    rows = scripts.select("script", F.explode(F.split(body, "\n")).alias("line")).where(F.col("line").rlike(line))
    got = [F.regexp_extract("line", line, g) for g in (1, 2, 3, 4)]
    return rows.select("script", got[0].alias("filename"), got[1].alias("url"), F.lower(got[2]).alias("checksum_type"), F.lower(got[3]).alias("checksum"))


def flatten_docs(docs: DataFrame) -> DataFrame:
    """Archive-search documents (lists of values) as flat rows: the first of each list, and the HTTP address.

    urls are "address|mime type|service"; the HTTPServer one goes first, else the first netcdf one.
    """
    served = F.filter("url", lambda u: F.endswith(u, F.lit("HTTPServer")))
    netcdf = F.filter("url", lambda u: F.contains(u, F.lit("netcdf")))
    pick = F.coalesce(F.get(served, F.lit(0)), F.get(netcdf, F.lit(0)))
    first = [F.get(c, F.lit(0)).alias(c) for c, t in docs.dtypes if t.startswith("array<") and c != "url"]
    plain = [c for c, t in docs.dtypes if not t.startswith("array<")]
    return docs.select(*plain, *first, F.split_part(pick, F.lit("|"), F.lit(1)).alias("http_url"))


def dedup_prefer(rows: DataFrame, key: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """One row of each key: the first in the given order."""
    w = W.partitionBy(*key).orderBy(*prefer)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def url_preference(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("esgf.nci.org.au")), 0).when(F.startswith(url, F.lit("https://")), 1).otherwise(2)


def flag_first_member(files: DataFrame, key: Sequence[str] = tuple(GROUP)) -> DataFrame:
    """files with is_first_available_member: the smallest member of its group by its numbers, r2 before r10."""
    order = member_order(F.col("member_id"))
    first = files.groupBy(*key).agg(F.min(order).alias("_first"))
    return files.join(first, list(key), "left").withColumn("is_first_available_member", F.coalesce(order == F.col("_first"), F.lit(False))).drop("_first")


def in_any_window(files: DataFrame, windows: DataFrame) -> DataFrame:
    """The files whose dates overlap a window of their group; undated files are left out.  windows: experiment_group, start, end."""
    group = F.when(F.col("experiment_id") == "historical", "historical").otherwise("future")
    w = F.broadcast(windows.select(F.col("experiment_group").alias("_group"), F.col("start").alias("_from"), F.col("end").alias("_to")))
    return files.join(w, (group == F.col("_group")) & (F.col("time_start") <= F.col("_to")) & (F.col("time_end") >= F.col("_from")), "left_semi")


def coverage_checks(files: DataFrame, windows: DataFrame, experiments: DataFrame, variables: DataFrame) -> DataFrame:
    """For each source, experiment, variable and window of the experiment's group: how many first-member files overlap it.

    windows: experiment_group, window, start, end.  Any overlap counts.
    """
    group = F.when(F.col("experiment_id") == "historical", "historical").otherwise("future")
    frame = F.broadcast(experiments).withColumn("experiment_group", group).join(F.broadcast(windows), "experiment_group").crossJoin(F.broadcast(variables))
    skeleton = files.select("source_id").distinct().crossJoin(F.broadcast(frame))  # a source, not a file, for each row of the frame
    first = files.where("is_first_available_member").select(*GROUP, "time_start", "time_end", "member_id")
    hit = first.withColumn("experiment_group", group).join(F.broadcast(windows), "experiment_group").where((F.col("time_start") <= F.col("end")) & (F.col("time_end") >= F.col("start")))
    counts = hit.groupBy(*GROUP, "window").agg(F.count("*").alias("file_count"), F.min("member_id").alias("member_id"))
    out = skeleton.join(counts, [*GROUP, "window"], "left").withColumn("file_count", F.coalesce("file_count", F.lit(0)))
    return out.select(*GROUP, "member_id", "window", F.col("start").alias("window_start"), F.col("end").alias("window_end"), (F.col("file_count") > 0).alias("has_file_overlap"), "file_count")


def coverage_summary(checks: DataFrame) -> DataFrame:
    out = checks.groupBy("source_id").agg(F.sum(F.col("has_file_overlap").cast("int")).alias("covered_checks"), F.count("*").alias("total_checks"))
    return out.withColumn("coverage_fraction", F.col("covered_checks") / F.col("total_checks")).orderBy(F.desc("coverage_fraction"), "source_id")


def replica_candidates(wanted: DataFrame, replicas: DataFrame, key: Sequence[str]) -> DataFrame:
    """wanted with urls: its own address first, then those of replicas with the same key and checksum, none twice or empty."""
    same = replicas.select(*key, F.lower("checksum").alias("_sum"), F.col("url").alias("_url")).groupBy(*key, "_sum").agg(F.sort_array(F.collect_set("_url")).alias("_urls"))
    both = wanted.withColumn("_sum", F.lower("checksum")).join(same, [*key, "_sum"], "left")
    urls = F.array_distinct(F.concat(F.array("url"), F.coalesce("_urls", F.array().cast("array<string>"))))
    return both.withColumn("urls", F.filter(urls, lambda u: u.isNotNull() & (u != ""))).drop("_sum", "_urls")


def verify_checksums(stored: DataFrame, manifest: DataFrame, key: str = "filename") -> DataFrame:
    """manifest with status: ok, mismatch, missing or unsupported.  stored: key, content."""
    kind = F.lower("checksum_type")
    digests = stored.select(key, F.sha2("content", 256).alias("_sha256"), F.md5("content").alias("_md5"))
    own = F.when(kind == "sha256", F.col("_sha256")).when(kind == "md5", F.col("_md5"))
    status = F.when(F.col("_md5").isNull(), "missing").when(own.isNull(), "unsupported").when(own == F.lower("checksum"), "ok").otherwise("mismatch")
    return manifest.join(digests, key, "left").withColumn("status", status).drop("_sha256", "_md5")


def fetch_plan(manifest: DataFrame, root: str, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows to fetch in order with the path each goes to; limit is the user's own."""
    out = manifest.withColumn("target", F.concat_ws("/", F.lit(root), "source_id", "experiment_id", "member_id", "variable_id", "filename")).orderBy(*order)
    return out if limit is None else out.limit(limit)
