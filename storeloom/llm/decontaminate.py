"""Benchmark decontamination with a distributed positional inverted index (DataFrame functions only).

The benchmark items are cut into windows of consecutive words. For each window the two terms that are
rarest in the training documents are its anchors. One scan of the documents counts the benchmark's
terms; a second one stores the positions of the anchor terms. Position lists of a window's two anchors
are shifted by their place in the item and intersected, which leaves few places of few documents. Those
are compared word by word, so the result is exact: every occurrence of every window is found.

Defined cases: null or empty text has no words and is never hit; an item without words matches nothing;
a row with a null id is processed like any other; repeated rows get the same result each; benchmark rows
with a null item_id mark words as hit but are not counted as items. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm.words import split_words
from storeloom.scratch import stage

WINDOW = 13
SLACK = 2


@dataclass(frozen=True)
class Matches:
    """headers: one row per document. hits: exact word positions. items: exact items. near: proximity items."""

    headers: DataFrame
    hits: DataFrame
    items: DataFrame
    near: DataFrame


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Distinct word sequences of the benchmark with the ids that share them."""
    worded = benchmark.select(F.col("item_id"), split_words(F.col("text")).alias("item_words"))
    return (worded.where(F.size("item_words") > 0)
            .groupBy("item_words").agg(F.collect_set("item_id").alias("item_ids"))
            .select(F.md5(F.concat_ws(" ", "item_words").cast("binary")).alias("item_key"), "item_words", "item_ids"))


def _words(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), split_words(F.col("text")).alias("words"))


def _term_counts(documents: DataFrame, items: DataFrame) -> DataFrame:
    """How often each benchmark term occurs in all documents."""
    vocabulary = items.select(F.explode("item_words").alias("term")).distinct()
    return (_words(documents).select(F.explode("words").alias("term"))
            .join(stage(vocabulary, "vocabulary"), "term")
            .groupBy("term").agg(F.count("*").alias("n_training")))


def _anchors(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """The two rarest places of every window; a window with a term that no document has cannot occur."""
    n_words = F.size("item_words")
    length = F.least(F.lit(window), n_words)
    places = (items.select("item_key", n_words.alias("n_words"), F.posexplode("item_words").alias("place", "term"))
              .join(counts, "term", "left"))
    starts = items.select("item_key", length.alias("length"),
                          F.explode(F.sequence(F.lit(0), n_words - length)).alias("start"))
    inside = (places.select("item_key", "place", "term", F.coalesce("n_training", F.lit(0)).alias("n_training"),
                            F.explode(F.sequence(F.greatest(F.lit(0), F.col("place") - window + 1), "place")).alias("start"))
              .join(starts, ["item_key", "start"]))
    ranked = inside.groupBy("item_key", "start").agg(
        F.sort_array(F.collect_list(F.struct("n_training", "place", "term"))).alias("rare"))
    first, second = F.col("rare")[0], F.col("rare")[F.when(F.size("rare") > 1, 1).otherwise(0)]
    return (ranked.where(first["n_training"] > 0)
            .select("item_key", first["place"].alias("place_1"), first["term"].alias("term_1"),
                    second["place"].alias("place_2"), second["term"].alias("term_2"))
            .distinct())


def _marked(eq: Column, window: int, n_words: Column) -> Column:
    """Places of an item that lie in a run of at least one window of equal words. eq: array of 0 and 1."""
    length = F.least(F.lit(window), n_words)
    # run[i] = number of equal words that end at place i; a place is hit if some run end in reach is long enough.
    runs = F.aggregate(
        eq, F.array().cast("array<int>"),
        lambda seen, x: F.concat(seen, F.array(F.when(x == 1, F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit(0)) + 1)
                                               .otherwise(0))))
    ends = F.filter(F.transform(runs, lambda run, i: F.when(run >= length, i).otherwise(-1)), lambda i: i >= 0)
    return F.array_distinct(F.flatten(F.transform(ends, lambda e: F.sequence(e - length + 1, e))))


def find_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK) -> Matches:
    """Exact phrase matches of benchmark windows, and items whose two rarest terms stand within ``slack`` of
    their relative places (proximity). Intermediate tables are staged in the shared folder."""
    items = stage(benchmark_items(benchmark), "items")
    counts = stage(_term_counts(documents, items), "term-counts")
    anchors = stage(_anchors(items, counts, window), "anchors")
    terms = stage(anchors.select(F.explode(F.array("term_1", "term_2")).alias("word")).distinct()
                  .withColumn("is_anchor", F.lit(True)), "anchor-terms")

    words = F.col("words")
    tokens = _words(documents).select("doc_id", "text_hash", F.size(words).cast("long").alias("n_words"),
                                      F.posexplode_outer(words).alias("place", "word"))
    index = stage(tokens.join(terms, "word", "left")
                  .where("is_anchor or coalesce(place, 0) = 0"), "postings")
    headers = index.where("coalesce(place, 0) = 0").select("doc_id", "text_hash", "n_words")
    postings = index.where("is_anchor").select("doc_id", "text_hash", "place", "word").distinct()

    def side(k: int) -> DataFrame:
        at = F.col("place") - F.col(f"place_{k}")
        return (postings.join(anchors, postings["word"] == anchors[f"term_{k}"])
                .select("doc_id", "text_hash", "item_key", "place_1", "place_2", at.alias(f"at_{k}")))

    band = max(1, 2 * slack + 1)
    left = side(1).withColumn("band", F.floor(F.col("at_1") / band))
    right = side(2).withColumn("band", F.explode(F.sequence(F.floor((F.col("at_2") - slack) / band),
                                                            F.floor((F.col("at_2") + slack) / band))))
    a, b = left.alias("a"), right.alias("b")
    same = [F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))] + [
        F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("text_hash", "item_key", "place_1", "place_2", "band")]
    close = F.abs(F.col("at_1") - F.col("at_2")) <= slack
    met = stage(a.join(b, same).where(close)
                .groupBy("a.doc_id", "a.text_hash", "a.item_key", "at_1")
                .agg(F.max((F.col("at_1") == F.col("at_2")).cast("int")).alias("exact")), "alignments")

    aligned = met.where("exact = 1").select("doc_id", "text_hash", "item_key", F.col("at_1").alias("at"))
    wanted = aligned.select("doc_id", "text_hash").distinct().alias("k")
    d = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).alias("d")
    texts = (d.join(wanted, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                    & (F.col("d.text_hash") == F.col("k.text_hash")), "left_semi")
             .dropDuplicates(["doc_id", "text_hash"])
             .select("doc_id", "text_hash", split_words(F.col("text")).alias("words")).alias("t"))
    n_item, at = F.size("item_words"), F.col("at")
    equal = F.transform(F.col("item_words"), lambda w, i: F.when(
        w == F.get(F.col("words"), at + i), 1).otherwise(0))
    pairs = aligned.join(items, "item_key").alias("p")
    checked = (pairs.join(texts, F.col("p.doc_id").eqNullSafe(F.col("t.doc_id"))
                          & (F.col("p.text_hash") == F.col("t.text_hash")))
               .select("p.doc_id", "p.text_hash", "item_key", "item_ids", at,
                       _marked(equal, window, n_item).alias("marked"))
               .where(F.size("marked") > 0))
    found = stage(checked, "matches")
    hits = found.select("doc_id", "text_hash", F.explode("marked").alias("k"), "at").select(
        "doc_id", "text_hash", (F.col("at") + F.col("k")).alias("place"))
    per_item = found.select("doc_id", "text_hash", F.explode("item_ids").alias("item_id"))
    near = met.join(items, "item_key").select("doc_id", "text_hash", F.explode("item_ids").alias("item_id"))
    return Matches(headers, hits, per_item, near)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK,
                  share: int = 20) -> DataFrame:
    """One row per document row: n_words, n_hit, n_items, items_sha256, n_near_items, text_hash, and contaminated
    if some word is hit and at least one word in ``share`` is."""
    m = find_matches(documents, benchmark, window, slack)
    key = ["doc_id", "text_hash"]
    hit = m.hits.groupBy(*key).agg(F.countDistinct("place").alias("n_hit"))
    items = m.items.groupBy(*key).agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    near = m.near.groupBy(*key).agg(F.countDistinct("item_id").alias("n_near_items"))
    out = m.headers
    for extra in (hit, items, near):
        o, e = out.alias("o"), extra.alias("e")
        new = [c for c in extra.columns if c not in key]
        out = o.join(e, F.col("o.doc_id").eqNullSafe(F.col("e.doc_id"))
                     & (F.col("o.text_hash") == F.col("e.text_hash")), "left").select("o.*", *[f"e.{c}" for c in new])
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(ids), ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("n_near_items", F.lit(0)).alias("n_near_items"), "text_hash")


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK,
                    share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = (contamination(documents, benchmark, window, slack, share).where("contaminated")
           .select("doc_id", "text_hash").distinct().alias("bad"))
    d = documents.alias("d")
    return d.join(bad, F.col("d.doc_id").eqNullSafe(F.col("bad.doc_id"))
                  & (F.xxhash64(F.col("d.text")) == F.col("bad.text_hash")), "left_anti")
