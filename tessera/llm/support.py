"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: White space of the query contracts: blank and the control characters 0x09 to 0x0D.
#: ``bytes.split()`` and ``bytes.strip()`` use exactly this set.
WORD = r"[^\x20\x09-\x0D]+"


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, under fixed names, so that other columns of a table cannot clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Mapping], schema: str) -> DataFrame:
    """Apply ``function`` to Arrow batches; it returns one array, or array-like, per column of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [_array(columns[field.name], field.type) for field in target], schema=target)
            del columns
            give_back()

    return df.mapInArrow(work, schema)


def give_back() -> None:
    """Hand memory that is free again to the system, where the C library can, so that a waiting worker does not hold it."""
    trim = _trim()
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join the sets of ``left[i]`` and ``right[i]``; ``parent`` holds the smallest member of every set."""
    while True:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            shorter = parent[parent]
            if np.array_equal(shorter, parent):
                break
            parent = shorter


def null_last_min(value: Column, *ties: Column) -> Column:
    """The smallest non-null value of a group, or null if there is none, with its ``ties``."""
    return F.min(F.struct(value.isNull().alias("missing"), value.alias("value"), *ties))
