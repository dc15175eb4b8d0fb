"""Operators that depend on row order, without one task per series.

A series may hold most of the table, so no window here is partitioned by the
series key alone. Rows are range-sorted on (keys, order) into lanes of similar
size that may split a series anywhere; positions come from the lanes, and
look-back windows run over fixed-size chunks of positions, each with a copy of
the rows just before it.

Rows that tie on the order columns are taken by content. Say ``unique`` where
the order columns identify a row; that saves a local sort.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlemill.session import range_sort, small_table, stage

LANE = "_lane"
POSITION = "_position"
CHUNK = "_chunk"

# monotonically_increasing_id: partition number above, row number below this bit.
_ROW_BITS = 33
_MIN_CHUNK_ROWS = 8_192
_MAX_CHUNK_ROWS = 65_536


@dataclass(frozen=True)
class Lanes:
    """A staged, range-sorted table whose rows know their global position."""

    rows: DataFrame
    n_rows: int
    n_lanes: int


def sort_into_lanes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], unique: bool = False
) -> Lanes:
    """Range-sort ``df`` on (keys, order) and number the rows from 0.

    One range shuffle and one staged write. The only collected values are the
    row counts of the lanes, as many as the shuffle has partitions.
    """
    in_order = range_sort(df, [*keys, *order], unique)
    staged = stage(
        in_order.withColumn(POSITION, F.monotonically_increasing_id()), "lanes"
    ).withColumn(LANE, F.shiftright(POSITION, _ROW_BITS))
    counts = sorted(
        (r[LANE], r["n"])
        for r in staged.groupBy(LANE).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    shifts, total = [], 0
    for lane, n in counts:
        shifts.append(total - (lane << _ROW_BITS))
        total += n
    # One row per lane: bounded by the number of shuffle partitions.
    by_lane = small_table(
        df.sparkSession,
        **{LANE: (pa.int64(), [lane for lane, _ in counts]), "_shift": (pa.int64(), shifts)},
    )
    rows = (
        staged.join(F.broadcast(by_lane), LANE)
        .withColumn(POSITION, F.col(POSITION) + F.col("_shift"))
        .drop("_shift")
    )
    return Lanes(rows, total, len(counts))


def with_row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_index",
    unique: bool = False,
) -> DataFrame:
    """0-based row index inside each series."""
    rows = _index_lanes(sort_into_lanes(df, keys, order, unique).rows, keys, name)
    return rows.select(*df.columns, name)


def _index_lanes(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the index inside each series to rows with lanes and positions."""
    if not keys:
        return rows.withColumn(name, F.col(POSITION))
    # A series contributes one row per lane it touches, so neither the window
    # nor the join sees more rows of one series than there are lanes or than a
    # lane holds. Staged, its true size decides how Spark joins it.
    segments = rows.groupBy(*keys, LANE).agg(F.min(POSITION).alias("_first"))
    per_key = Window.partitionBy(*keys)
    first = segments.withColumn("_first", F.min("_first").over(per_key))
    indexed = join_null_safe(rows, stage(first, "segments"), [*keys, LANE])
    return indexed.withColumn(name, F.col(POSITION) - F.col("_first")).drop("_first")


def join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join that also matches NULL keys; the keys come from the left."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in on])


def every_nth(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, unique: bool = False
) -> DataFrame:
    """One row in ``n`` of each series in order, the first row included."""
    indexed = with_row_index(df, keys, order, "_index", unique)
    return indexed.filter(F.col("_index") % n == 0).drop("_index")


def _chunk_rows(n_rows: int, n_parts: int, lookback: int) -> int:
    even = n_rows // max(1, 16 * n_parts)
    return max(min(max(even, _MIN_CHUNK_ROWS), _MAX_CHUNK_ROWS), 4 * lookback, 1)


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    chunk_rows: int | None = None,
    unique: bool = False,
    index: str | None = None,
) -> DataFrame:
    """Add window columns that look at most ``lookback`` rows back.

    ``build(rows, w)`` adds columns over ``w``, the series in order; stacked
    windows add up their look-back. Equal to windows over whole series, but no
    task gets more than ``chunk_rows + lookback`` rows of one series at a time.
    ``index`` names a column for the row index inside each series, if wanted.
    """
    lanes = sort_into_lanes(df, keys, order, unique)
    if chunk_rows is None:
        chunk_rows = _chunk_rows(lanes.n_rows, lanes.n_lanes, lookback)
    if chunk_rows < lookback:
        raise ValueError("chunk_rows must be at least lookback")
    rows = lanes.rows if index is None else _index_lanes(lanes.rows, keys, index)
    position = F.col(POSITION)
    own = F.floor(position / F.lit(chunk_rows)).cast("long")
    in_tail = position % chunk_rows >= chunk_rows - lookback
    chunks = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.drop(LANE).withColumn(CHUNK, F.explode(chunks))
    w = Window.partitionBy(CHUNK, *keys).orderBy(POSITION)
    return build(spread, w).filter(F.col(CHUNK) == own).drop(CHUNK, POSITION)


