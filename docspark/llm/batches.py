"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text that one step inside a Python worker handles at once.
STEP_CHARS = 4_000_000


def steps(batches: Iterable[pa.RecordBatch], text: str, chars: int = STEP_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches so that each step holds about ``chars`` bytes of text; whole texts, never prefixes."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        held = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = held[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(held, before + chars, "right")))
            yield batch.slice(start, end - start), column.slice(start, end - start).to_pylist()
            start = end


def put(batch: pa.RecordBatch, schema: pa.Schema, **columns: pa.Array) -> pa.RecordBatch:
    """The columns of ``schema``: those given, the others from ``batch``."""
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else batch.column(batch.schema.get_field_index(f.name)).cast(f.type)
         for f in schema], schema=schema)


def list_array(flat: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from the concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
