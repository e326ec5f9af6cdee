"""Language identification by prediction by partial matching over bytes.

Every language has a byte context tree: for each context of up to ``ORDER`` bytes, how often each byte
followed. A byte that a context has not seen is coded by an escape (method C: as many escape counts as
distinct successors) and then by the next shorter context, whose probabilities are renormalised without
the excluded bytes, down to the uniform distribution over bytes. The statistics are frozen after training,
so the probability of a byte depends on the last ``ORDER`` bytes only. All trees share one automaton whose
states are contexts; a text costs one step per byte, and many segments step together. The language with
the shortest exact code wins.

Training reads the labelled documents given to ``train``; ``sample_documents`` bounds how many per language
it uses (chosen by hash). Everything else covers all rows and whole texts.

Defined cases: null text or text without a letter is ``und`` with score 0; so is everything if nothing could be
learned. Ties go to the language that sorts first. Repeated rows get equal results; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.texts import map_texts, slices

ORDER = 3
SEGMENT = 256
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass(frozen=True)
class Model:
    """symbols: class of each byte. following: next state. bits: code length by state, class and language."""

    languages: tuple[str, ...]
    width: int
    symbols: np.ndarray
    following: np.ndarray
    bits: np.ndarray


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def count_grams(texts: list[bytes], order: int = ORDER) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, grams as big-endian integers, counts) of all byte grams up to order + 1 within each text."""
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64)
    left = np.concatenate([np.arange(len(t), 0, -1) for t in texts if t] or [np.zeros(0, np.int64)])
    gram = np.zeros(len(flat), dtype=np.int64)
    for length in range(1, order + 2):
        usable = len(flat) - length + 1
        if usable <= 0:
            return
        gram = gram[:usable] * 256 + flat[length - 1:]
        values, counts = np.unique(gram[left[:usable] >= length], return_counts=True)
        yield length, values, counts


def build(rows: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]], order: int = ORDER,
          max_states: int = 16_000) -> Model | None:
    """Frozen automaton and code lengths from each language's gram counts by length."""
    languages = tuple(sorted(rows))
    if not languages:
        return None
    totals: dict[bytes, int] = {b"": 1 << 62}
    for grams in rows.values():
        for length in range(1, order + 1):
            for value, n in zip(*grams.get(length, ((), ())), strict=True):
                key = int(value).to_bytes(length, "big")
                totals[key] = totals.get(key, 0) + int(n)
    # A threshold keeps the set closed under shortening: a part of a context is at least as frequent.
    ranked = sorted(totals.values(), reverse=True)
    least = max(2, ranked[max_states] + 1) if len(ranked) > max_states else 2
    contexts = sorted((c for c, n in totals.items() if n >= least), key=lambda c: (len(c), c))
    state = {c: i for i, c in enumerate(contexts)}

    seen = sorted({int(v) for grams in rows.values() for v in grams.get(1, ((), ()))[0]})
    symbols = np.full(256, len(seen), dtype=np.uint8 if len(seen) < 256 else np.uint16)
    symbols[seen] = np.arange(len(seen))
    width = len(seen) + 1
    column = {byte: i for i, byte in enumerate(seen)}

    following = np.zeros((len(contexts), width), dtype=np.int32)
    shorter = np.array([state[c[1:]] if c else 0 for c in contexts])
    for i, context in enumerate(contexts):
        if context:
            following[i] = following[shorter[i]]
        if len(context) < order:
            for byte, k in column.items():
                target = state.get(context + bytes([byte]))
                if target is not None:
                    following[i, k] = target

    bits = np.empty((len(contexts), width, len(languages)), dtype=np.float32)
    copies = np.ones(width)
    copies[-1] = 256 - len(seen)
    for j, language in enumerate(languages):
        counts = np.zeros((len(contexts), width))
        for length in range(1, order + 2):
            for value, n in zip(*rows[language].get(length, ((), ())), strict=True):
                gram = int(value).to_bytes(length, "big")
                i = state.get(gram[:-1])
                if i is not None:
                    counts[i, column[gram[-1]]] = n
        chance = np.empty((len(contexts), width))
        for i, context in enumerate(contexts):
            lower = chance[shorter[i]] if context else np.full(width, 1 / 256)
            total, distinct = counts[i].sum(), np.count_nonzero(counts[i])
            if not distinct:
                chance[i] = lower
                continue
            is_new = counts[i] == 0
            rest = (lower * copies)[is_new].sum()
            if rest <= 0:
                chance[i] = counts[i] / total
                continue
            chance[i] = np.where(is_new, distinct / (total + distinct) * lower / rest, counts[i] / (total + distinct))
        with np.errstate(divide="ignore"):
            bits[:, :, j] = -np.log2(chance)
    return Model(languages, width, symbols, following.reshape(-1), bits.reshape(-1, len(languages)))


def code_lengths(model: Model, texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """Bits of each text under each language; all segments of all texts step through the automaton together."""
    out = np.zeros((len(texts), len(model.languages)))
    width = model.width
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    if not sizes.sum():
        return out
    flat = model.symbols[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    n_segments = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), n_segments)
    within = (np.arange(len(owner)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)) * SEGMENT
    base = np.repeat(np.cumsum(sizes) - sizes, n_segments)
    length = np.minimum(sizes[owner] - within, SEGMENT)
    by_length = np.argsort(-length, kind="stable")
    owner, within, length, start = owner[by_length], within[by_length], length[by_length], (base + within)[by_length]
    state = np.zeros(len(start), dtype=np.int64)
    warm = np.flatnonzero(within > 0)
    for back in range(order, 0, -1):
        state[warm] = model.following[state[warm] * width + flat[start[warm] - back]]
    cost = np.zeros((len(start), len(model.languages)))
    active = np.searchsorted(-length, -np.arange(SEGMENT), side="left")
    for t in range(int(length[0])):
        n = active[t]
        k = state[:n] * width + flat[start[:n] + t]
        cost[:n] += model.bits[k]
        state[:n] = model.following[k]
    np.add.at(out, owner, cost)
    return out


def predict(model: Model | None, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    """Best language of each text and its share of the probability under equal priors."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    usable = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    if not usable:
        return labels, scores
    bits = code_lengths(model, [texts[i] for i in usable])
    best = bits.argmin(axis=1)
    share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
    for i, b, s in zip(usable, best, share, strict=True):
        labels[i], scores[i] = model.languages[b], float(s)
    return labels, scores


def train(labelled: DataFrame, text: Column, language: Column, order: int = ORDER, sample_documents: int = 1500,
          max_states: int = 16_000) -> Model | None:
    """Learn from rows with text and language: about ``sample_documents`` per language, chosen by a hash of the
    text, or all if there are fewer. The number of languages is taken to be small."""
    rows = labelled.select(text.cast("string").alias("text"), language.cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_documents / n))])
    place = F.pmod(F.xxhash64("text", F.lit(order)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(place < F.element_at(share, F.col("lang"))).select(
        "lang", F.col("text").cast("binary").alias("text"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                langs = np.array(part.column("lang").to_pylist())
                for lang in set(langs.tolist()):
                    for length, values, counts in count_grams([texts[i] for i in np.flatnonzero(langs == lang)], order):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(values)), pa.array(np.full(len(values), length, np.int32)),
                             pa.array(values), pa.array(counts.astype(np.int64))], names=["lang", "length", "gram", "n"])

    counted = (sample.mapInArrow(grams, "lang string, length int, gram long, n long")
               .groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")).toPandas())
    by_language = {lang: {int(length): (g["gram"].to_numpy(), g["n"].to_numpy()) for length, g in rows.groupby("length")}
                   for lang, rows in counted.groupby("lang")}
    return build(by_language, order, max_states)


ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(documents: DataFrame, text: Column, model: Model | None) -> DataFrame:
    """All rows in struct ``row`` with ``lang_pred`` and ``score``. The model's size is bounded by its states."""
    shared = documents.sparkSession.sparkContext.broadcast(model and astuple(model))

    def run(parts: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        model = shared.value and Model(*shared.value)
        for texts in parts:
            yield list(predict(model, texts))

    return map_texts(documents, text, ADDED, run)


def held_out(doc_id: Column, parts: int, kept_out: int = 2) -> Column:
    """Fold by the checksum of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == kept_out, F.lit(False))


def train_on_folds(documents: DataFrame, parts: int = 4) -> Model | None:
    return train(documents.where(~held_out(F.col("doc_id"), parts)), F.col("text"), F.col("lang"))


def keep_identified(documents: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents whose language is recognised, with all their columns."""
    found = identify(documents, F.col("text"), train_on_folds(documents))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
