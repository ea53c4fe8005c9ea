"""The registered queries of the corpus operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import decontaminate, infill, language, licenses, lines, mixing, privacy, records, secrets, simhash, substrings, suffix_tree, treaps
from topicloom.llm.common import table


def op1_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens", "epoch", "before", "block", "key")


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encoded(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lines.judge(docs, lines.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")


def op5_relative_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_secret_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(docs))
    return found.select(F.col("_id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_tree.score(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op11_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = privacy.scan(docs, privacy.fit(docs))
    return found.select(F.col("_id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term")


def op12_inverted_treaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treaps.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.transform(table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return found.select(F.col("_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digests)


def queries() -> dict:
    return {f.__name__: f for f in (op1_temperature_mix, op2_token_records, op3_license_diagonals, op4_line_labels, op5_relative_parse, op6_decontaminate, op7_secret_models, op8_simhash, op9_suffix_tree, op10_language, op11_disclosure, op12_inverted_treaps, op13_infill)}


OP1_SQL = r"""
WITH RECURSIVE slim AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'null-' || md5(coalesce(text, ''))) AS ident, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n FROM documents),
totals AS (SELECT source, sum(n)::BIGINT AS n_tokens FROM slim GROUP BY source),
known AS (SELECT n_tokens, n_tokens / (SELECT sum(n_tokens) FROM totals)::DOUBLE AS p FROM totals WHERE n_tokens > 0),
search(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END FROM (
    SELECT step, low, high, (low + high) / 2 AS mid,
      (SELECT max(pow(p, (low + high) / 2) / p) / min(pow(p, (low + high) / 2) / p) FROM known) <= 1.25 AS ok FROM search WHERE step < 40)),
alpha AS (SELECT CASE WHEN (SELECT max(p) / min(p) FROM known) <= 1.25 THEN 0 ELSE round((low + high) / 2, 6) END AS a FROM search WHERE step = 40),
powers AS (SELECT source, n_tokens, CASE WHEN n_tokens > 0 THEN pow(n_tokens / (SELECT sum(n_tokens) FROM totals)::DOUBLE, a) ELSE 0 END AS w FROM totals, alpha),
shares AS (SELECT source, n_tokens, round((SELECT max(n_tokens / w) FROM powers WHERE n_tokens > 0) * w)::BIGINT AS budget FROM powers),
passes AS (SELECT *, CASE WHEN n_tokens > 0 THEN budget // n_tokens ELSE 1 END AS full_passes FROM shares),
emitted AS (SELECT s.doc_id, s.source, s.n, p.n_tokens, p.budget, p.full_passes, e.epoch,
    md5('mix|' || e.epoch || '|' || s.ident) AS key
  FROM slim s JOIN passes p ON s.source IS NOT DISTINCT FROM p.source, unnest(range(p.full_passes + 1)) AS e(epoch)),
placed AS (SELECT *, epoch * n_tokens + sum(n) OVER (PARTITION BY source, epoch ORDER BY key, n ROWS UNBOUNDED PRECEDING) - n AS before FROM emitted),
headed AS (SELECT *, max(CASE WHEN before < budget THEN key END) OVER (PARTITION BY source, epoch) AS last_key FROM placed)
SELECT doc_id, source, n AS n_tokens, epoch, before::BIGINT AS before,
  (CASE WHEN budget > 0 THEN least(999, floor(before * 1000 / budget::DOUBLE)) ELSE 0 END)::BIGINT AS block, key
FROM headed WHERE epoch < full_passes OR (n_tokens > 0 AND budget > full_passes * n_tokens AND key <= last_key)
"""

ORACLES = {"op1_temperature_mix": OP1_SQL, "op3_license_diagonals": licenses.SQL, "op5_relative_parse": substrings.SQL, "op6_decontaminate": decontaminate.SQL, "op12_inverted_treaps": treaps.SQL, "op13_infill": infill.SQL}
