"""How filters interact: which documents each filter removes, in whatever order the filters run.

Every document becomes a truth-table word: bit S of its 2^n bits is set if the document survives all filters of subset S
(S as a bit set, n up to 5, so a word has 32 bits). The number of survivors of every subset then is the positional
popcount of the words of a part and label. Tasks count with carry-save adders: three words of one weight become a sum
word of that weight and a carry word of twice the weight, until two words a weight are left. Copies of one text share
a word; their number says at which weights it enters. From the 32 counts of each part and label follow the results of
all orders, without another look at a document.

Whether an equal text has a smaller id is settled by counting rows by digest of the text, part, label and id, and then
by digest, so a text that holds a third of all rows crosses the shuffles as a few rows a task.

Defined cases: a null text is empty, a null part is the empty string. A null id neither makes another document a copy nor
is itself one. Repeated rows count as often as they are there; those of the smallest id all pass. Without a label
row (or with a null) a document is neither good nor toxic; several label rows of an id count if any of them says so.
No documents give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.texts import map_texts

# Fixed by the output contract: the limits of the five filters.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 3
MARKS = b"#$%&*|"
FILTERS = "ABCDE"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
COUNTS = "part string, subset int, n long, n_good long, n_toxic long"


def text_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    points = len(text.translate(None, _CONTINUATION))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > MOST_CAPITAL_PERCENT * points) << 2
            | (len(text.translate(None, MARKS)) < len(text)) << 3)


def judged(documents: DataFrame, text: Column, keep: Sequence[str],
           failures: Callable[[bytes], int] = text_failures) -> DataFrame:
    """Columns to keep in struct ``row``, ``digest`` of the whole text and ``failed``, the bits of the failed filters."""
    added = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("failed", T.IntegerType())])

    def run(slices: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        for texts in slices:
            held = [t or b"" for t in texts]
            yield [[hashlib.sha256(t).digest() for t in held], [failures(t) for t in held]]

    return map_texts(documents, text, added, run, keep=keep)


def labelled(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(id, part, digest, failed) rows with good and toxic flags of their id."""
    flags = labels.groupBy(F.col(doc_id).alias("label_id")).agg(
        *[F.max(F.coalesce(F.col(column) == 1, F.lit(False))).alias(name)
          for column, name in (("quality", "good"), ("toxic", "toxic"))])
    return (documents.join(flags, F.col("id") == F.col("label_id"), "left").drop("label_id")
            .fillna(False, ["good", "toxic"]))


def weighted_masks(documents: DataFrame, copy_bit: int) -> DataFrame:
    """(part, good, toxic, failed, n): documents counted by text, with the bit of the copy filter set for copies."""
    text = ["digest", "part", "good", "toxic"]
    by_id = documents.groupBy(*text, "id").agg(F.count("*").alias("n"), F.first("failed").alias("failed"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    grouped = by_id.groupBy(*text).agg(
        F.first("failed").alias("failed"), F.min(known).alias("first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"), F.sum("n").alias("n"))
    # A digest has at most one row for each part and label here.
    least = F.min("first.id").over(Window.partitionBy("digest"))
    passing = F.col("no_id") + F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0)
    parted = grouped.select(*text[1:], "failed", "n", passing.alias("passing"))
    both = F.array(F.struct("failed", F.col("passing").alias("n")),
                   F.struct(F.col("failed").bitwiseOR(F.lit(copy_bit)).alias("failed"), (F.col("n") - F.col("passing")).alias("n")))
    return parted.select(*text[1:], F.explode(both).alias("m")).select(*text[1:], "m.failed", "m.n").where("n > 0")


def truth_words(n_filters: int) -> np.ndarray:
    """Word of surviving subsets for each set of failed filters."""
    subsets = np.arange(1 << n_filters, dtype=np.uint32)
    survives = (subsets[:, None] & subsets[None, :]) == 0
    return (survives << subsets).sum(axis=1).astype(np.uint32)


def positional_counts(words: np.ndarray, weights: np.ndarray, lanes: int = 32) -> np.ndarray:
    """Sum of the weights of the words that have each bit set, by carry-save addition."""
    counts, carried, plane = np.zeros(lanes, np.int64), [], 0
    highest = int(weights.max(initial=0)).bit_length()
    while plane < highest or carried:
        here = np.concatenate([words[(weights >> plane) & 1 == 1], *carried])
        carried = []
        while len(here) > 2:
            third = len(here) // 3
            a, b, c = here[:third], here[third:2 * third], here[2 * third:3 * third]
            one = a ^ b
            carried.append((a & b) | (one & c))
            here = np.concatenate([one ^ c, here[3 * third:]])
        counts += ((here[:, None] >> np.arange(lanes, dtype=np.uint32)) & 1).sum(axis=0).astype(np.int64) << plane
        plane += 1
    return counts


def subset_survivors(masks: DataFrame, n_filters: int) -> DataFrame:
    """Survivors of every subset of filters by part: all, good and toxic ones."""
    if n_filters > 5:
        raise ValueError("a word holds the subsets of at most five filters")
    subsets = 1 << n_filters

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = truth_words(n_filters)
        for batch in batches:
            words = table[batch.column("failed").to_numpy()]
            weights = batch.column("n").to_numpy()
            part = batch.column("part").dictionary_encode()
            which = part.indices.to_numpy()
            label = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic")])
            for p, name in enumerate(part.dictionary.to_pylist()):
                by_label = {}
                for good, toxic in itertools.product((False, True), repeat=2):
                    mine = (which == p) & (label[0] == good) & (label[1] == toxic)
                    by_label[good, toxic] = positional_counts(words[mine], weights[mine], subsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * subsets, pa.string()), pa.array(range(subsets), pa.int32()),
                     *[pa.array(sum(v for k, v in by_label.items() if wanted(k)), pa.int64())
                       for wanted in (lambda k: True, lambda k: k[0], lambda k: k[1])]],
                    names=["part", "subset", "n", "n_good", "n_toxic"])

    return masks.mapInArrow(count, COUNTS).groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "n_good", "n_toxic")])


def all_orders(names: str = FILTERS) -> list[dict]:
    """Every step of every order of the filters, with the subsets before and after it."""
    out = []
    for order in itertools.permutations(range(len(names))):
        before = 0
        for step, chosen in enumerate(order, 1):
            out.append({"filter_order": "".join(names[i] for i in order), "step": step, "chosen": chosen,
                        "before": before, "after": before | 1 << chosen})
            before |= 1 << chosen
    return out


def order_report(survivors: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order and step from the counts of all subsets."""
    full = (1 << len(names)) - 1
    ordered = F.array_sort(F.collect_list(F.struct("subset", "n", "n_good", "n_toxic")))
    by_part = survivors.groupBy("part").agg(ordered.alias("s"))
    kind = "array<struct<filter_order: string, step: int, chosen: int, before: int, after: int>>"
    steps = by_part.select("part", "s", F.explode(F.from_json(F.lit(json.dumps(all_orders(names))), kind)).alias("o"))

    def at(subset: Column, column: str = "n") -> Column:
        return F.get("s", subset)[column]

    before, after, alone = F.col("o.before"), F.col("o.after"), F.col("o.after") - F.col("o.before")
    counted = steps.select(
        "part", "o.filter_order", "o.step", F.col("o.chosen").alias("chosen"), at(after).alias("kept"),
        (at(before) - at(after)).alias("removed"),
        (at(F.lit(0)) - at(alone) - (at(before) - at(after))).alias("redundant"),
        (at(F.lit(full) - alone) - at(F.lit(full))).alias("unique_fails"),
        (at(before, "n_good") - at(after, "n_good")).alias("good_lost"),
        (at(before, "n_toxic") - at(after, "n_toxic")).alias("toxic_lost"))
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "chosen"))).drop("chosen")


def audit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Documents kept, removed and lost at each step of all orders of the five filters, by part."""
    rows = judged(documents, F.col(f"`{text}`"), [doc_id, part]).select(
        F.col("row")[doc_id].alias("id"), F.coalesce(F.col("row")[part].cast("string"), F.lit("")).alias("part"), "digest", "failed")
    masks = weighted_masks(labelled(rows, labels, doc_id), 1 << FILTERS.index("E"))
    return order_report(subset_survivors(masks, len(FILTERS)))
