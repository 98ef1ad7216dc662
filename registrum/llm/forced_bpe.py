"""BPE encoding and decoding with forced boundaries.

A blank or line feed is in no token of a vocabulary that drops white space, and a byte pair
that stands inside no token is a place no merge can cross. Both are certain cuts: the text
between two cuts is encoded on its own and the ids are put one after the other. Fragments
recur, so a task encodes each of them once and looks the rest up (a bounded memory).

Null text counts as empty and gives no ids. Rows keep their order within a partition and
repeated rows are encoded alike. Columns that clash with ``output`` raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from registrum.llm.bpe_vocab import vocabulary

# Rows are handled in slices of about so many characters, which bounds a task's memory.
SLICE_CHARS = 2_000_000


def slices(sizes: Iterable[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` characters each."""
    start, total, stop = 0, 0, 0
    for stop, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield start, stop
            start, total = stop, 0
    if start < stop:
        yield start, stop


def encode(df: DataFrame, path: str, text: str = "text", output: str = "ids") -> DataFrame:
    """Adds the ids of ``text`` as an array of integers."""
    if output in df.columns:
        raise ValueError(f"there is a column {output} already")
    place = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for start, stop in slices(map(len, texts)):
                found = vocab.memo.ids(texts[start:stop])
                offsets = np.fromiter(accumulate((len(f) // 4 for f in found), initial=0), np.int32)
                values = np.frombuffer(b"".join(found), "<i4")
                ids = pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*batch.schema.names, output])

    schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Adds the text of ``ids``: their tokens with a blank between, special ones too, as the
    vocabulary names no decoder. Null ids give an empty text; an id without a token raises."""
    if output in df.columns:
        raise ValueError(f"there is a column {output} already")
    place = df.columns.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path).token_table()
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy()
            for start, stop in slices((8 * lengths).tolist()):
                part = batch.slice(start, stop - start)
                out = [" ".join(tokens[row.values.to_numpy()].tolist()) if row.is_valid else "" for row in part.column(place)]
                decoded = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], [*batch.schema.names, output])

    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    return df.mapInArrow(run, schema)
