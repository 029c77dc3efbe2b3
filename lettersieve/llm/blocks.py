"""Blocks of documents: what a task gathers from its rows before anything is shuffled.

A block is a run of rows of one input partition whose texts begin within the same ``size``
bytes, so it holds at most ``size`` bytes and one more text. Where an operator needs something
back for each word or pair of a document, it asks once per block and the block's rows, packed,
meet the answers: the rows of a block are one bounded group whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

from lettersieve.llm.common import ships_its_code

ships_its_code(__name__)

BLOCK_BYTES = 32 << 20
PACK_BYTES = 2 << 20
LEVEL = 5
# Blocks of a partition are numbered below this bound: 32 TB of text.
BLOCKS_OF_PARTITION = 1 << 20


def text_bytes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def runs(numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(number, begin, end) of each stretch of equal numbers."""
    if len(numbers):
        begins = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1])
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(numbers)], strict=True):
            yield int(numbers[begin]), begin, end


def cut(batches: Iterator[pa.RecordBatch], text: int, size: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(block, rows): the rows of a partition in order, no piece over a block border."""
    first = TaskContext.get().partitionId() * BLOCKS_OF_PARTITION
    seen = 0
    for batch in batches:
        lengths = text_bytes(batch.column(text))
        begins = seen + np.cumsum(lengths) - lengths
        seen += int(lengths.sum())
        for number, begin, end in runs(begins // size):
            yield first + number, batch.slice(begin, end - begin)


def pieces(batch: pa.RecordBatch, text: int, size: int = PACK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in pieces of about ``size`` bytes of text."""
    lengths = text_bytes(batch.column(text))
    for _, begin, end in runs((np.cumsum(lengths) - lengths) // size):
        yield batch.slice(begin, end - begin)


def packed(rows: pa.RecordBatch | pa.Table) -> bytes:
    """Rows as one compressed value."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
        stream.write(rows)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()
