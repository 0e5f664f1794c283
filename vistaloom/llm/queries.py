"""The registered queries of the training-data operators and what SQL can say of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, html, langid, mixing, neighbours, packing, pii, repeats, simhash, tokens
from .common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.secret(spark), found="found")
    return rows.select("doc_id", "text", F.size("found").alias("n_replaced"), F.array_join(F.array_sort(F.array_distinct("found.kind")), ",").alias("kinds"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(table(spark, sf_dir, "documents"), tokens.tokenizer_path(), end_id=2)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.planned(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokens.tokenizer_path(), end_id=1)


def queries() -> dict:
    return {f.__name__: f for f in (op1_fingerprints, op2_pii, op3_repeats, op4_main_text, op5_token_files, op6_neighbours, op7_language_id, op8_simhash, op9_mixing, op10_packing)}


OP9_SQL = r"""
WITH rows AS (
  SELECT doc_id, coalesce('s' || source, 't') AS k, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, '')))) AS h,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT k, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM rows GROUP BY k),
levels AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / w, k)),
water AS (SELECT arg_min(level, (cap / w, k)) AS level FROM levels WHERE level * w <= cap),
plan AS (
  SELECT l.k, l.source_size, least(l.cap, coalesce(water.level, 1e300::DOUBLE) * l.w) AS target FROM levels l CROSS JOIN water),
budgets AS (SELECT *, least(CAST(round(target) AS BIGINT), 3 * source_size) AS budget FROM plan),
cuts AS (
  SELECT r.doc_id, r.size, b.source_size, b.target, b.budget // greatest(b.source_size, 1) AS epochs, b.budget,
    coalesce(sum(r.size) OVER (PARTITION BY r.k ORDER BY r.h, r.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM rows r JOIN budgets b USING (k))
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM cuts
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_mixing": OP9_SQL}
