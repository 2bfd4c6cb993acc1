"""Small helpers for functions that run over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, null kept."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``most`` bytes of text, or one row: what is built beside them stays small."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def add_columns(
    docs: DataFrame, fields: list[T.StructField], work: Callable[[pa.RecordBatch], list[pa.Array]], text: str | None = None
) -> DataFrame:
    """docs with columns that ``work`` makes of each batch; columns of these names are replaced.

    With the name of a text column, batches come in slices of bounded size.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]
    at = docs.columns.index(text) if text else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at) if text else batches:
            made = work(batch)
            old = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(old + made, names + [f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(kept + fields))
