"""The queries of this subpackage: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.mixing import sizes_and_taken

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return sizes_and_taken(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pelagia.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.toxicity import scored, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    out = scored(docs, model, ["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.flac import media_column, media_digests

    return media_digests(media_column(_table(spark, sf_dir, "documents")))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.ann import PostingLists

    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return PostingLists.fit(vectors).search(vectors, F.col("vec_id") % 100 == 0, 10)


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.substring import digest, remove_repeats

    return digest(remove_repeats(_table(spark, sf_dir, "documents")))


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.near_dups import digest_rows

    return digest_rows(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.langid import identify

    return identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.licences import scan, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(docs))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pelagia.llm.pieces import digest, encoded

    return digest(encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 4)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pelagia.llm.runs import digest, planted, word_runs

    return digest(word_runs(_table(spark, sf_dir, "documents"), order=planted))


QUERIES = {"op13_runs": op13_runs, "op12_whitening": op12_whitening, "op11_pieces": op11_pieces, "op2_langid": op2_langid, "op5_licences": op5_licences, "op1_near_dups": op1_near_dups, "op8_substring": op8_substring, "op4_flac": op4_flac, "op10_ann": op10_ann, "op3_toxicity": op3_toxicity, "op9_packing": op9_packing, "op6_line_dedup": op6_line_dedup, "op7_mixing": op7_mixing}

#: The blanks [\x20\x09-\x0D] as DuckDB writes them.
_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

ORACLE_SQL = {
    "op6_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l),
hot AS (SELECT line_key, max(doc_id) AS keeper FROM k WHERE length(line_key) >= 40 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.line, k.pos, coalesce(hot.keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN hot USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op7_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w FROM d GROUP BY source),
o AS (SELECT *, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS pos FROM s),
c AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
             sum(w) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM o),
f AS (SELECT *, bool_and((3 * total - 4 * full_before) * w > 4 * source_size * w_left) OVER (ORDER BY pos) AS capped FROM c),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN (2 * source_size)::DOUBLE
                  ELSE (((3 * total - 4 * coalesce(sum(source_size) FILTER (WHERE capped) OVER (), 0)) * w)::DOUBLE
                        / (2 * sum(w) FILTER (WHERE NOT capped) OVER ())::DOUBLE) END AS target FROM f),
q AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
r AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.quota,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(concat('mix:', d.doc_id)), d.doc_id) - d.size AS before_it
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE size * (quota // source_size) + greatest(0, least(size, quota % source_size - before_it)) END)::BIGINT AS taken
FROM r""",
    "op8_substring": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first_doc FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, p + k.i AS pos FROM win JOIN f USING (h), range(50) k(i) WHERE first_doc < doc_id),
a AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
m AS (SELECT a.doc_id, a.word, a.pos, gone.pos IS NOT NULL AS is_gone FROM a LEFT JOIN gone ON gone.doc_id = a.doc_id AND gone.pos = a.pos),
r AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE is_gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT is_gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)""",
}
