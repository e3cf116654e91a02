"""Rows packed in blocks, one binary value for many rows of a key.

Spark hands a stateful processor one Python object a row and holds all that a call gives
back. A key with most of a micro-batch's rows then takes far more memory than the rows.
Packed as Arrow data, rows stay columns on their way in and out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = "block"
# Rows that are split into blocks together, and rows of a block given back.
ROWS_PER_BLOCK = 100_000


def to_block(rows: pa.Table) -> bytes:
    stream = pa.BufferOutputStream()
    with pa.ipc.new_stream(stream, rows.schema) as writer:
        writer.write_table(rows)
    return stream.getvalue().to_pybytes()


def from_block(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def _codes(key: pa.ChunkedArray) -> np.ndarray:
    """A number for each distinct key, the null key too."""
    try:
        encoded = key.combine_chunks().dictionary_encode(null_encoding="encode")
        return encoded.indices.to_numpy()
    except pa.ArrowNotImplementedError:  # nested keys
        seen: dict[str, int] = {}
        return np.array([seen.setdefault(repr(k), len(seen)) for k in key.to_pylist()])


def _split(rows: pa.Table, key: str, out: pa.Schema) -> pa.RecordBatch:
    codes = _codes(rows.column(key))
    places = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[places], prepend=-1))
    keys = rows.column(key).take(places[starts]).combine_chunks()
    dealt = rows.drop_columns([key]).take(places)
    lengths = np.diff(starts, append=len(codes))
    blocks = [to_block(dealt.slice(int(at), int(n))) for at, n in zip(starts, lengths)]
    return pa.RecordBatch.from_arrays([keys, pa.array(blocks, out.field(1).type)], names=out.names)


def packed(df: DataFrame, key: str) -> DataFrame:
    """``key, block``: the rows of each key in blocks of all other columns."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(BLOCK, T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([(key, pa.null()), (BLOCK, pa.binary())])
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= ROWS_PER_BLOCK:
                yield _split(pa.Table.from_batches(held), key, out)
                held, n = [], 0
        if n:
            yield _split(pa.Table.from_batches(held), key, out)

    return df.mapInArrow(pack, schema)


def unpacked(df: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """The rows of the blocks with their key, in the columns of ``schema``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            for i, block in enumerate(batch.column(BLOCK)):
                rows = from_block(block.as_buffer())
                rows = rows.append_column(key, keys.take(np.full(rows.num_rows, i)))
                yield from rows.select(schema.fieldNames()).combine_chunks().to_batches()

    return df.mapInArrow(unpack, schema)


def sorted_rows(rows: pa.Table, order: list[str]) -> pa.Table:
    """The rows in order, nulls first."""
    try:
        keys = [(name, "ascending") for name in order]
        places = pc.sort_indices(rows, sort_keys=keys, null_placement="at_start")
    except (pa.ArrowNotImplementedError, pa.ArrowTypeError):  # nested columns
        values = list(zip(*(rows.column(name).to_pylist() for name in order)))
        places = sorted(range(len(values)), key=lambda i: [(v is not None, v) for v in values[i]])
    return rows.take(pa.array(places))
