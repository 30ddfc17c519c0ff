"""Whole texts inside a task: Arrow batches cut to chunks of bounded size, words found by numpy on the UTF-8 bytes.

All word classes used here treat every byte of a multi-byte character alike (>= 0x80), so a byte table gives the same
words as a pattern on code points. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text that one step works on (one longer text is a chunk of its own).
CHUNK_BYTES = 4 << 20
#: Bytes of a batch that Spark hands to a task's Python at most.
BATCH_BYTES = 8 << 20


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes inside the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACE = byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x20\x09-\x0D]``
NON_SPACE = ~SPACE
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, a-z and everything beyond ASCII
WORD = ~byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Words:
    """Words of a chunk: byte spans, the text each lies in, and where each text's words begin."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        inside = table[data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        if len(before):
            before[0] = False
        edges = bounds[:-1][bounds[:-1] < len(data)]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        if len(after):
            after[-1] = False
        after[edges[edges > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(bounds) - 1), self.counts)
        self._data, self._inside = data, inside

    def __len__(self) -> int:
        return len(self.starts)

    def array(self) -> pa.Array:
        """The words as Arrow binary values."""
        offsets = np.zeros(len(self) + 1, np.int32)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        packed = self._data[self._inside]
        return pa.BinaryArray.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the distinct words by number."""
        found = self.array().dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False), found.dictionary

    def within(self, length: int) -> np.ndarray:
        """True where a window of so many words starts that stays inside one text."""
        fits = np.zeros(len(self), bool)
        if len(self) >= length:
            fits[: len(self) - length + 1] = self.doc[: len(self) - length + 1] == self.doc[length - 1 :]
        return fits


class Texts:
    """A chunk of texts: their bytes one after the other, and ``bounds`` with one more entry than texts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, table: np.ndarray, lower: bool = False) -> Words:
        return Words(LOWER[self.data] if lower else self.data, self.bounds, table)

    def bytes(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    def take(self, rows: np.ndarray) -> Texts:
        """The chosen texts as a chunk."""
        lengths = np.diff(self.bounds)[rows]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1][rows] - bounds[:-1], lengths)
        return Texts(self.data[at], bounds)

    def per_text(self, at: np.ndarray) -> np.ndarray:
        """How many of the sorted byte positions lie in each text."""
        return np.diff(np.searchsorted(at, self.bounds))


def texts_of(column: pa.Array) -> Texts:
    """A view of a string column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return Texts(data, offsets - offsets[0])


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch whose texts hold at most ``limit`` bytes, or one text."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        part = batch.slice(start, stop - start)
        yield part, texts_of(part.column(part.schema.get_field_index(text)))
        start = stop


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where the frame has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def list_array(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """One list a row, of so many of the values in turn."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_BYTES, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = spark.conf.get(key).strip().lower().rstrip("b")
    if not have.isdigit() or int(have) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def add_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    compute: Callable[[Texts, pa.RecordBatch], list],
    keep: Callable[[list], np.ndarray] | None = None,
    limit: int = CHUNK_BYTES,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with columns that ``compute`` makes from whole texts, a chunk at a time and without a shuffle.

    ``compute`` gets a chunk and its batch and gives an array for each field. ``keep`` may turn those arrays into a row
    mask; rows outside it are left out. Fields whose name the frame has already must be renamed by the caller (``fresh``).
    Columns in ``drop`` don't come back from the tasks' Python.
    """
    kept = [k for k, name in enumerate(df.columns) if name not in drop]
    schema = T.StructType([*(df.schema.fields[k] for k in kept), *fields])
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, text, limit):
                made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in compute(texts, part)]
                out = pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), *made], names=[*(part.schema.names[k] for k in kept), *(f.name for f in fields)])
                yield out if keep is None else out.filter(pa.array(keep(made)))

    return df.mapInArrow(run, schema)
