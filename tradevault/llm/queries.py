"""The operators as queries over whole tables, with their production parameters, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevault.llm import alignment, chat, decontamination, language, mixing, pii, simhash, spelling, substring, tokens, topk, toxicity, winnowing
from tradevault.llm.columns import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(table(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(spark, table(spark, sf_dir, "conversations"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("piece_bpe_32k.model"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_language, op3_token_counts, op4_mixing, op5_toxicity, op6_pii, op7_substring, op8_chat, op9_simhash, op10_topk,
        op11_alignment, op12_spelling, op13_winnowing,
    )
}

OP1_SQL = r"""
WITH doc AS (
  SELECT rowid AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
), item AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), gram AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item WHERE len(words) > 0)
), hit AS (
  SELECT d.r, d.i, g.n, g.item_id
  FROM (
    SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS gram
    FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM gram) WHERE len(words) >= n)
  ) d JOIN gram g ON g.n = d.n AND g.gram = d.gram
), places AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""

OP7_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT r, doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM doc WHERE len(words) >= 50 AND doc_id IS NOT NULL)
), least_doc AS (
  SELECT h, min(doc_id) AS low FROM win GROUP BY h
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM win JOIN least_doc USING (h) WHERE low < doc_id
), word AS (
  SELECT r, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p FROM doc
), stay AS (
  SELECT word.r, string_agg(w, ' ' ORDER BY word.p) AS kept, count(*) AS n_kept
  FROM word ANTI JOIN gone ON word.r = gone.r AND word.p = gone.p GROUP BY word.r
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN stay USING (r)
"""

OP10_SQL = """
WITH vec AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM vec q JOIN vec c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

ORACLE = {"op1_decontamination": OP1_SQL, "op7_substring": OP7_SQL, "op8_chat": chat.REPORT_SQL, "op10_topk": OP10_SQL}
