"""What the operators share: Arrow batches, word boundaries and word hashes.

Texts are handled as the UTF-8 bytes of an Arrow column, a few megabytes at a
time, so that a task's memory depends on neither batch nor partition size.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text bytes that a mapper looks at together; a longer text comes alone. Word
# hashes and their kin take some fifty times as much memory meanwhile.
SLICE_BYTES = 512 << 10

# Bytes of a batch that Spark hands to a mapper.
BATCH_BYTES = 4 << 20
# Fixed value: the setting that limits them.
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

# Bytes that separate words, as in [^\x20\x09-\x0D]+.
WORD_BREAK_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where its rows begin and end in them.

    Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, whole.offset * 8)
    raw = whole.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = int(offsets[0]) if len(whole) else 0
    last = int(offsets[-1]) if len(whole) else 0
    return data[first:last], offsets - first


def word_spans(
    data: np.ndarray, offsets: np.ndarray, breaks: Sequence[int] = WORD_BREAK_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one more at the end).

    ``breaks`` are the bytes that belong to no word.
    """
    is_break = np.zeros(256, bool)
    is_break[list(breaks)] = True
    inside = ~is_break[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside
    ends[:-1] &= ~ends[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix64(values: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads 64-bit values (splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0
) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span, in one pass.

    A polynomial modulo 2^64 over mixed values, read off prefix sums; equal
    spans get equal hashes wherever they stand.
    """
    base = 0x9E3779B97F4A7C15 + 2 * (seed * 0x632BE59BD9B4E019 & 0x3FFFFFFF)
    inverse = pow(base, -1, 1 << 64)
    mixed = mix64(values.astype(np.uint64) + np.uint64(seed * 0x1000193 + 1))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed * _powers(base & (1 << 64) - 1, len(values)), out=sums[1:])
    back = _powers(inverse, len(values) + 1)[starts]
    lengths = (ends - starts).astype(np.uint64)
    return mix64((sums[ends] - sums[starts]) * back + lengths * np.uint64(0xD1342543DE82EF95))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0):
    """64-bit hashes of words given as byte spans."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 10))
    base = 0xD6E8FEB86659FD93
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(base, len(data)), out=sums[1:])
    back = _powers(pow(base, -1, 1 << 64), len(data) + 1)[starts]
    lengths = (ends - starts).astype(np.uint64)
    return mix64((sums[ends] - sums[starts]) * back + lengths * np.uint64(0x9FB21C651E98DF25))


def release_memory() -> None:
    """Give memory that is free by now back to the machine, as workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_lean(df: DataFrame, mapper: Mapper, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` whose tasks get batches of some megabytes and give memory back.

    Spark makes batches of 10,000 rows otherwise, whatever their size, which a
    task holds outside the heap and once more in Python. The limit stays set for
    the session, as Spark reads it when the query runs; a smaller number of bytes is kept.
    """
    conf = df.sparkSession.conf
    given = re.fullmatch(r"(\d+)b?", conf.get(_BATCH_KEY))
    if given is None or int(given[1]) > BATCH_BYTES:
        conf.set(_BATCH_KEY, str(BATCH_BYTES))

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from mapper(batches)
        finally:
            release_memory()

    return df.mapInArrow(lean, schema)


def unclashing(taken: Iterable[str], name: str) -> str:
    """``name``, or a longer one that ``taken`` lacks (Spark ignores case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


@dataclass(frozen=True)
class Kept:
    """Rows for a mapper that keeps columns, reads one and adds others.

    ``source`` has the kept columns and, unless it is one of them, the one to
    read at the end; it is called ``value``. ``new`` maps the wanted names of
    the added columns to free ones.
    """

    source: DataFrame
    value: str
    new: dict[str, str]
    schema: T.StructType

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


def kept_batch(part: pa.RecordBatch, names: Sequence[str], *added: pa.Array) -> pa.RecordBatch:
    """The kept columns of ``part`` and the added ones."""
    kept = [part.column(i) for i in range(len(names) - len(added))]
    return pa.RecordBatch.from_arrays([*kept, *added], names=list(names))


def keeping(df: DataFrame, keep: Sequence[str], read: str, added: Sequence[tuple[str, str]]) -> Kept:
    """``keep`` and ``read`` of ``df``; ``added`` are names and types of new columns.

    New columns that ``keep`` has already get underscores in front.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    value, source = read, kept
    if read not in keep:
        value = unclashing(keep, "_value")
        source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{read}`").alias(value))
    fields = [*kept.schema.fields]
    new = {}
    for name, kind in added:
        new[name] = unclashing([f.name for f in fields], name)
        fields.append(T.StructField(new[name], T.DataType.fromDDL(kind)))
    return Kept(source, value, new, T.StructType(fields))


def crc_mod(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of a document's id as text, modulo ``modulus``: the fold of a row."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % modulus
