"""Arrow passes over whole texts: every row keeps its columns, new columns are appended.

Rows travel as one struct column, so a document column of any name cannot clash with a helper column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts handled together in a task, in bytes; a longer single text is handled alone.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Parts of a batch with their texts, each of about ``size`` bytes."""
    texts, start, held = batch.column("text").to_pylist(), 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= size or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), texts[start:i + 1]
            start, held = i + 1, 0


def map_texts(documents: DataFrame, text: Column, added: T.StructType,
              function: Callable[[Iterator[list[bytes | None]]], Iterator[list[list]]],
              slice_bytes: int = SLICE_BYTES, keep: Sequence[str] | None = None) -> DataFrame:
    """All rows with their columns (or those to keep) in struct ``row`` and the ``added`` columns.

    A column that is kept travels to the task and back; columns that nobody reads, such as the text, are better left out.

    ``function`` gets the texts of a task slice by slice (UTF-8, null as None) and yields, for each slice,
    one list of values per added column.
    """
    frame = documents.select(F.struct(*[F.col(f"`{c}`") for c in (documents.columns if keep is None else keep)]).alias("row"),
                             text.cast("string").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("row", frame.schema["row"].dataType), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added.fields]
        rows: list[pa.Array] = []

        def texts() -> Iterator[list[bytes | None]]:
            for batch in batches:
                for part, values in slices(batch, slice_bytes):
                    rows.append(part.column("row"))
                    yield values

        for values in function(texts()):
            yield pa.RecordBatch.from_arrays(
                [rows.pop(0), *[pa.array(v, type=k) for v, k in zip(values, kinds, strict=True)]],
                names=["row", *[f.name for f in added.fields]])

    return frame.mapInArrow(run, schema)
