"""Queries of the filter audit, the periodic runs and the search for neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import adaptive_scan, filter_audit, periodic_runs
from storeloom.llm.registry import query, table
from storeloom.llm.words import BLANKS

OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
d AS (
  SELECT doc_id, part,
         len(w) < 200 AS a,
         100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS failed, count(*) AS n
  FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(range(5)) AS i),
orders AS (
  SELECT row_number() OVER () AS r, [p.i, q.i, s.i, t.i, u.i] AS o
  FROM letters p, letters q, letters s, letters t, letters u
  WHERE len(list_distinct([p.i, q.i, s.i, t.i, u.i])) = 5),
steps AS (
  SELECT array_to_string([substr('ABCDE', CAST(x AS INT) + 1, 1) for x in o], '') AS filter_order, k AS step,
         CAST(1 << o[k] AS INT) AS bit,
         CAST(coalesce(list_sum([1 << x for x in o[1:k - 1]]), 0) AS INT) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS k)),
parts AS (SELECT DISTINCT part FROM f),
counted AS (
  SELECT parts.part, filter_order, step, bit,
         coalesce(sum(n) FILTER (failed & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (failed & before = 0 AND failed & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (failed & before <> 0 AND failed & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (failed = bit), 0) AS unique_fails,
         coalesce(sum(n) FILTER (failed & before = 0 AND failed & bit <> 0 AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (failed & before = 0 AND failed & bit <> 0 AND toxic), 0) AS toxic_lost
  FROM steps, parts JOIN f USING (part) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


@query("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_runs(text: Column, doc_id: Column) -> Column:
    """Fixed by the output contract: the words of every tenth text (by checksum of the id) repeat from some place on."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    seed = F.floor(checksum / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")
        begin = seed % n
        period = 1 + F.floor((n - begin) / (3 + seed % 8))
        return F.when(n > 0, F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.get(words, F.when(i < begin, i).otherwise(begin + (i - begin) % period).cast("int"))), " ")).otherwise("")

    # The one-element array binds the words, which would be split anew for each of them otherwise.
    words = F.array(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), ""))
    return F.when(checksum % 10 == 0, F.transform(words, repeat)[0]).otherwise(text)


OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         xor(4294967295, list_reduce(
           list_concat([4294967295], [CAST(ascii(c) AS BIGINT) for c in string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                    lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))) AS h
  FROM documents),
s AS (
  SELECT r, doc_id, w, h, len(w) AS n, (h // 10) AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
d AS (
  SELECT r, doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0
              THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] for i in range(n)]
              ELSE w END AS w
  FROM s),
grams AS (
  SELECT r, i, array_to_string(w[i + 1 : i + 6], ' ') AS gram
  FROM (SELECT r, w, unnest(range(n - 5)) AS i FROM d WHERE n >= 12)),
same AS (SELECT x.r, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same),
cand AS (
  SELECT r, q, min(i) AS s, count(*) + 5 + q AS n FROM islands GROUP BY r, q, k HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
runs AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand o WHERE o.r = c.r AND o.q < c.q AND o.s <= c.s AND o.s + o.n >= c.s + c.n)),
by_doc AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(s, ',', n, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
         min({'n': -n, 's': s, 'q': q}) AS best
  FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + n)) AS i FROM runs),
words AS (SELECT r, unnest(range(n)) AS i, unnest(w) AS word FROM d),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start,
       CAST(-best.n AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
       CAST((-1000 * best.n) // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN by_doc USING (r) LEFT JOIN kept USING (r)
"""


@query("op12_periodic_runs", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = with_planted_runs(F.col("text"), F.col("doc_id"))
    found = periodic_runs.find(table(spark, sf_dir, "documents"), text, keep=("doc_id",))
    best = found.withColumn("best", periodic_runs.longest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return best.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op13_nearest_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_scan.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
