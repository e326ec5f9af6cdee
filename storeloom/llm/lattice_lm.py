"""Subword lattice language model: the marginal probability of a text over all its segmentations.

The pieces of an existing subword vocabulary get unigram scores from the training documents (the vocabulary's
own segmentation of every distinct word, weighted by how often training has it, plus one). The probability of a
word is the sum over all ways to cut it into pieces, by a forward recursion in log space; a character without a
piece is spelt with the vocabulary's byte pieces. A text is its words and one end. A word-count base score with
add-one smoothing comes along.

Plan: all words of all documents are counted with a partial count in each task; each distinct word is scored
once. Frequent words (at most ``frequent_words`` of them, found by a threshold on a histogram of counts) go
to the tasks in a broadcast; occurrences of all other words join their values in a shuffle. No word is left out.

Defined cases: null or blank text has only its end. Repeated rows get equal results. Nothing to learn from:
counts are 0 and every piece is equally likely. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.texts import map_texts
from storeloom.llm.words import blank_words
from storeloom.scratch import stage

WORD_START = "▁"
FLUSH_WORDS = 100_000


def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattice:
    """Forward recursion over the pieces of a vocabulary with given log probabilities."""

    def __init__(self, pieces: dict[str, float], spelt: np.ndarray):
        """pieces: log probability of each piece of text. spelt: log probability of each byte piece."""
        self.pieces = pieces
        self.spelt = spelt
        self.longest = max(map(len, pieces), default=1)

    def log_probability(self, word: str) -> float:
        """Natural log of the marginal probability of a word."""
        text = WORD_START + word
        alpha = [0.0]
        pieces, longest, log, exp = self.pieces, self.longest, math.log, math.exp
        for end in range(1, len(text) + 1):
            ways = []
            for start in range(max(0, end - longest), end):
                score = pieces.get(text[start:end])
                if score is not None:
                    ways.append(alpha[start] + score)
            if text[end - 1] not in pieces:
                ways.append(alpha[end - 1] + sum(self.spelt[b] for b in text[end - 1].encode("utf-8", "surrogatepass")))
            top = max(ways)
            alpha.append(top if len(ways) == 1 else top + log(sum([exp(w - top) for w in ways])))
        return alpha[-1]


def lattice(path: str, counts: np.ndarray, ends: int) -> tuple[Lattice, float]:
    """The lattice with scores from piece counts, and the log probability of an end."""
    model = _processor(path)
    total = math.log(counts.sum() + ends + len(counts) + 1)
    scores = np.log(counts + 1.0) - total
    pieces, spelt = {}, np.full(256, -total)
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            spelt[int(model.id_to_piece(i)[1:-1], 16)] = scores[i]
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = float(scores[i])
    return Lattice(pieces, spelt), math.log(ends + 1) - total


def count_words(documents: DataFrame, text: Column, in_training: Column) -> DataFrame:
    """(word, n, n_training) of all documents; words are UTF-8. A partial count leaves each task."""
    rows = documents.select(in_training.alias("train"), text.cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(everywhere: Counter, training: Counter) -> pa.RecordBatch:
            words = list(everywhere)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(everywhere.values(), pa.int64()),
                 pa.array(map(training.get, words, repeat(0)), pa.int64())], names=["word", "n", "n_training"])

        everywhere, training = Counter(), Counter()
        for batch in batches:
            # One text at a time: a batch of texts as objects, beside its buffers, would double what a worker holds.
            for learn, value in zip(batch.column("train"), batch.column("text"), strict=True):
                words = blank_words(value.as_py())
                everywhere.update(words)
                if learn.as_py():
                    training.update(words)
                if len(everywhere) > FLUSH_WORDS:
                    yield out(everywhere, training)
                    everywhere, training = Counter(), Counter()
        if everywhere:
            yield out(everywhere, training)

    counted = rows.mapInArrow(run, "word binary, n long, n_training long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_training").alias("n_training"))


def piece_counts(words: DataFrame, path: str) -> np.ndarray:
    """How often training uses each piece of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _processor(path)
        sums = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                ids = model.encode([w.decode("utf-8", "replace") for w in part.column("word").to_pylist()])
                times = np.repeat(part.column("n_training").to_numpy(), [len(x) for x in ids])
                sums += np.bincount(np.array([i for x in ids for i in x], dtype=np.int64), weights=times,
                                    minlength=len(sums)).astype(np.int64)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["piece", "n"])

    learnt = words.where("n_training > 0").select("word", "n_training")
    rows = learnt.mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_processor(path).get_piece_size())
    counts[rows["piece"]] = rows["n"]
    return counts


def _valued(words: DataFrame, path: str, counts: np.ndarray, ends: int, n_tokens: int, n_types: int) -> DataFrame:
    """Adds base and lattice log10 probabilities to each distinct word."""
    shared = words.sparkSession.sparkContext.broadcast(counts)
    base_total = math.log10(n_tokens + n_types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = lattice(path, shared.value, ends)
        for batch in batches:
            scores = [model.log_probability(w.decode("utf-8", "replace")) for w in batch.column("word").to_pylist()]
            learnt = batch.column("n_training").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(learnt > 0),
                 pa.array(np.log10(learnt + 1.0) - base_total), pa.array(np.array(scores) / math.log(10))],
                names=["word", "n", "known", "base", "score"])

    return words.mapInArrow(run, "word binary, n long, known boolean, base double, score double")


def _frequent(values: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Words above the lowest count threshold that at most ``most`` words pass, and the others."""
    bands = values.groupBy(F.floor(F.log2("n")).cast("int").alias("band")).count().orderBy(F.desc("band")).collect()
    held, least = 0, 64
    for row in bands:
        held += row["count"]
        if held > most:
            break
        least = row["band"]
    limit = F.lit(2 ** min(least, 62))
    return values.where(F.col("n") >= limit), values.where(F.col("n") < limit)


DOCUMENT = T.StructType([
    T.StructField("place", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("others", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()),
                                                      T.StructField("times", T.LongType())])))])


def score_documents(documents: DataFrame, text: Column, in_training: Column, path: str,
                    frequent_words: int = 150_000, keep: tuple[str, ...] | None = None) -> DataFrame:
    """All rows (with all columns or those to keep) in struct ``row`` with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = documents.sparkSession
    words = stage(count_words(documents, text, in_training), "words")
    ends = documents.where(in_training).count()
    sums = words.agg(F.sum("n_training"), F.sum((F.col("n_training") > 0).cast("long"))).first()
    n_tokens, n_types = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    counts = piece_counts(words, path)
    values = stage(_valued(words, path, counts, ends, n_tokens, n_types), "word-values")
    frequent, others = _frequent(values, frequent_words)
    top = frequent.select("word", "known", "base", "score").toArrow()
    shared = spark.sparkContext.broadcast((
        top.column("word").to_pylist(), *[top.column(c).to_numpy() for c in ("known", "base", "score")]))
    end_base = math.log10(ends + 1) - math.log10(n_tokens + n_types + 1)
    end_score = lattice(path, counts, ends)[1] / math.log(10)

    def run(parts: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        listed, known, base, score = shared.value
        index = {w: i for i, w in enumerate(listed)}
        known, base, score = (np.append(x, 0) for x in (known, base, score))  # the last one is for other words
        task = TaskContext.get().partitionId() << 40
        seen = 0
        for texts in parts:
            columns: list[list] = [[], [], [], [], [], []]
            for value in texts:
                found = blank_words(value)
                ids = np.fromiter(map(index.get, found, repeat(-1)), dtype=np.int64, count=len(found))
                rest = Counter([found[i] for i in np.flatnonzero(ids < 0)])
                row = (task + seen, len(found) + 1, int(known[ids].sum()) + (ends > 0), float(base[ids].sum()) + end_base,
                       float(score[ids].sum()) + end_score, [{"word": w, "times": n} for w, n in rest.items()])
                seen += 1
                for column, x in zip(columns, row, strict=True):
                    column.append(x)
            yield columns

    scored = stage(map_texts(documents, text, DOCUMENT, run, keep=keep), "document-scores")
    rare = (scored.select("place", F.explode("others").alias("o")).select("place", "o.word", "o.times")
            .join(others, "word")
            .groupBy("place").agg(F.sum(F.when(F.col("known"), F.col("times")).otherwise(0)).alias("more_known"),
                                  F.sum(F.col("times") * F.col("base")).alias("more_base"),
                                  F.sum(F.col("times") * F.col("score")).alias("more_score")))
    zero = F.lit(0)
    return scored.drop("others").join(rare, "place", "left").select(
        "row", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"))
