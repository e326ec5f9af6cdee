"""Packing of tokenised documents into sequences of fixed capacity.

Only documents longer than a sequence are cut. Tokenising happens once, in tasks; every piece gets a number
among the pieces of its length (its number within the task plus the counts of earlier tasks, so that a length that
most pieces share is numbered without sorting it in one place). The plan is made from the histogram of lengths,
which has at most ``capacity`` entries, and goes to the tasks as a table of at most a few rows per
filling; each piece then finds its place from its length and number.

Defined cases: null text is empty; an empty document is its end token alone. Repeated rows are packed each.
Extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm import bin_completion
from storeloom.llm.texts import map_texts
from storeloom.scratch import stage

CAPACITY = 4096
CACHE = 400_000  # about 60 MB a worker for each of the two memories
SLICE_BYTES = 2 << 20
# Python splits at these, the tokenizer does not.
_NOT_BLANKS = "\x1c\x1d\x1e\x1f"
# Fixed by the tokenizer: how it cuts a lower-cased part, and its marks. Only ASCII and the letters of Latin-1 are cut
# here: they lower-case one to one and are never composed with their neighbours. Other parts take the tokenizer's whole way.
_PLAIN = re.compile(r"[\x00-\x7F\xC0-\xD6\xD8-\xF6\xF8-\xFF]+")
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^a-z0-9\xDF-\xF6\xF8-\xFF]+")
_MARK = "<|"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


class Ids:
    """Token ids as little-endian bytes, for a lower-casing byte-level tokenizer that never joins text across blanks.

    Each blank-separated part is encoded once and remembered, as are its pieces; a memory is emptied when it holds CACHE.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.written = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            # Printable ASCII stands for itself.
            plain = piece.isascii() and piece.isprintable()
            letters = piece if plain else "".join(map(_BYTE_LETTERS.__getitem__, piece.encode()))
            found = self.pieces[piece] = b"".join([self.written[t.id] for t in self.model.tokenize(letters)])
        return found

    def _part(self, part: str) -> bytes:
        if _MARK in part or not _PLAIN.fullmatch(part):
            return self._whole(part)
        pieces = _PIECE.findall(part.lower())
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self._piece, pieces))

    def __call__(self, text: str) -> bytes:
        if any(c in text for c in _NOT_BLANKS):
            return self._whole(text)
        if len(self.parts) > CACHE:
            self.parts.clear()
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        parts, known = text.split(), self.parts
        for part in set(parts).difference(known):
            known[part] = self._part(part)
        return b"".join(map(known.__getitem__, parts))


@functools.cache
def _ids(path: str) -> Ids:
    """One tokenizer for all tasks of a worker."""
    return Ids(path)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _pieces(with_ids: bool) -> T.StructType:
    fields = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("number", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return T.StructType([T.StructField("task", T.IntegerType()), T.StructField("pieces", T.ArrayType(T.StructType(fields)))])


def cut(documents: DataFrame, text: Column, path: str, end_id: int = 1, capacity: int = CAPACITY,
        with_ids: bool = False, keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row per piece: struct ``row`` (of the columns to keep, or all), task, piece, start, length, ids_crc32, number
    within task and length."""
    def run(parts: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        encode, end = _ids(path), struct.pack("<I", end_id)
        task, numbers = TaskContext.get().partitionId(), Counter()
        for texts in parts:
            out = []
            for value in texts:
                ids = encode((value or b"").decode("utf-8", "replace")) + end
                pieces = []
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    length = len(part) // 4
                    made = {"piece": k, "start": at // 4, "length": length, "ids_crc32": zlib.crc32(part),
                            "number": numbers[length]}
                    if with_ids:
                        made["ids"] = np.frombuffer(part, dtype="<u4").astype(np.int32)
                    pieces.append(made)
                    numbers[length] += 1
                out.append(pieces)
            yield [[task] * len(texts), out]

    found = map_texts(documents, text, _pieces(with_ids), run, SLICE_BYTES, keep)
    return found.select("row", "task", F.explode("pieces").alias("p")).select("row", "task", "p.*")


def _slots(plan: bin_completion.Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first number, pieces per sequence, first sequence and offset of every filling with that length."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Counter = Counter()
    sequence = 0
    for filling, times in plan:
        offset = 0
        for length, each in Counter(filling).items():
            rows.setdefault(length, []).append((taken[length], each, sequence, offset))
            taken[length] += each * times
            offset += each * length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*r, strict=True)) for length, r in rows.items()}


def pack(documents: DataFrame, text: Column, path: str, end_id: int = 1, capacity: int = CAPACITY,
         keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """One row per piece: the kept columns, piece, start, length, ids_crc32, sequence_id and offset (and ids)."""
    spark = documents.sparkSession
    pieces = cut(documents, text, path, end_id, capacity, with_ids, keep)
    pieces = stage(pieces.select(*[F.col(f"row.{c}").alias(c) for c in keep],
                                 *[c for c in pieces.columns if c != "row"]), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = stage(per_task.select("task", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")),
                   "piece-counts")
    histogram = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_slots(bin_completion.complete(histogram, capacity)))
    # There are as many counts as tasks and lengths, which grows with the input: no broadcast.
    numbered = pieces.join(before.select("task", "length", "before").hint("merge"), ["task", "length"]).select(
        *[c for c in pieces.columns if c not in ("task", "number")], (F.col("number") + F.col("before")).alias("number"))
    out = T.StructType([f for f in numbered.schema.fields if f.name != "number"]
                       + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                first, each, start, place_in = slots[int(length)]
                k = np.searchsorted(first, numbers[mine], side="right") - 1
                within = numbers[mine] - first[k]
                sequence[mine] = start[k] + within // each[k]
                offset[mine] = place_in[k] + within % each[k] * length
            names = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, out)
