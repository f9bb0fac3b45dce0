"""The queries of this subpackage and the SQL they are held against, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from telemetra.llm import (
    alignment,
    cross_polytope,
    decontamination,
    divergence,
    language_model,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
)
from telemetra.llm.common import table


def tokenizer_file(name: str) -> str:
    """Every worker has the tokenizer files at the same place."""
    return public_tokenizers.path(name)


def op1_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.learned_and_judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), keep_ids=False)


def op5_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.held_out_scores(table(spark, sf_dir, "documents"))


def op7_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.drop("passages")


def op8_multi_index_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op10_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_identity_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, files = table(spark, sf_dir, "documents"), map(tokenizer_file, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.Alignment(docs, *files).documents()


def op12_late_string_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_cross_polytope_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, run in globals().items() if name.startswith("op") and callable(run)}


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS total FROM counts GROUP BY ALL HAVING sum(docs) >= 3),
langs AS (SELECT lang, count(*) AS kinds, sum(total) AS n_lang FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(n) AS n_group FROM counts SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(n_group, 0) AS n_group, kinds, n_lang
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN sums USING (lang, source) LEFT JOIN langs USING (lang)),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (n_group + kinds) AS p,
    1 + (1000000000::HUGEINT * (total + 1)) // (n_lang + kinds) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    """SQL cannot express the other operators: tokenizers, hashes, compression and trained models."""
    return {"op12_late_string_divergence": OP12_SQL}
