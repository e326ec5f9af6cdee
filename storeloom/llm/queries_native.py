"""Queries of the operators that use DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storeloom.llm import decontaminate, line_dedup
from storeloom.llm.registry import query, table

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '{SEPARATOR}'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '{SEPARATOR}'), lambda x: x <> '') AS w
  FROM benchmark),
windows AS (
  SELECT item_id, least(13, len(w)) AS n, unnest([array_to_string(w[i : i + least(13, len(w)) - 1], ' ')
         for i in range(1, len(w) - least(13, len(w)) + 2)]) AS phrase
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
found AS (
  SELECT r, i, runs.n, item_id FROM (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM runs) runs
  JOIN (SELECT DISTINCT item_id, n, phrase FROM windows) q ON q.n = runs.n AND q.phrase = runs.phrase),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)) AS ids FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""


@query("op9_benchmark_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("n_near_items", "text_hash")


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_documents(documents).select("row.doc_id", "row.text", "n_lines", "n_removed")
