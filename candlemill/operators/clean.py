"""Typing, epoch conversion, null and price checks, de-duplication, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions.candle import all_known, epoch_to_ts, lenient, micros, ohlc_valid
from candlemill.operators.ordered import join_null_safe
from candlemill.schema import (
    BRONZE_ESSENTIAL,
    DOUBLE_COLUMNS,
    LONG_COLUMNS,
    SILVER_ESSENTIAL,
    present_only,
    require_columns,
)
from candlemill.session import stage

# A time chunk spans this many steps, so it holds at most that many candles of
# one series on the grid of the step.
CHUNK_STEPS = 10_080
# Denser series are cut into cells with about this many timestamps or cells in them at most.
CELL_PARTS = 65_536


def typed(df: DataFrame) -> DataFrame:
    """Re-type the candle columns that exist; what does not parse is NULL.

    Columns that have their type already are left alone.
    """
    kinds = {c: "bigint" for c in LONG_COLUMNS} | {c: "double" for c in DOUBLE_COLUMNS}
    casts = {
        c: lenient(F.col(c), kinds[c])
        for c in present_only(df, list(kinds))
        if df.schema[c].dataType.simpleString() != kinds[c]
    }
    return df.withColumns(casts) if casts else df


def with_timestamps(df: DataFrame, name: str = "candles") -> DataFrame:
    """Add ``open_ts`` and ``close_ts`` from the epochs, unless already there."""
    new = {
        ts: epoch_to_ts(F.col(epoch))
        for ts, epoch in (("open_ts", "open_time"), ("close_ts", "close_time"))
        if ts not in df.columns and epoch in df.columns
    }
    out = df.withColumns(new) if new else df
    return require_columns(out, ["open_ts"], name)


def bronze_rows(df: DataFrame) -> DataFrame:
    """Typed rows whose open and close time and four prices are present."""
    rows = typed(df)
    return rows.where(all_known(rows, BRONZE_ESSENTIAL))


def not_null_rows(df: DataFrame) -> DataFrame:
    """Rows with all essential values, timestamps included once they exist.

    A timestamp made from an epoch is missing exactly when the epoch is, so
    checking before making them asks for less.
    """
    return df.where(all_known(df, present_only(df, SILVER_ESSENTIAL)))


def keep_first(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str], ts: str = "open_ts"
) -> DataFrame:
    """First row per (series, timestamp) in ``tiebreak`` order.

    ``tiebreak`` should tell copies apart; which of equal ones stays is open.
    Spark limits each group to one row before the shuffle, so many copies of
    one candle do not meet in one task.
    """
    # Time first: the sort then goes by a number that differs from row to row.
    w = Window.partitionBy(ts, *keys).orderBy(*tiebreak)
    ranked = df.withColumn("_rank", F.row_number().over(w))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(ohlc_valid())


def first_rows(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]) -> DataFrame:
    """One candle with all essential values per (series, minute), valid or not."""
    return keep_first(with_timestamps(not_null_rows(typed(df))), keys, tiebreak)


def silver(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]) -> DataFrame:
    """Clean candles, one per (series, minute).

    The first copy is chosen before prices are checked: a minute whose first
    copy is invalid is lost even if a later copy is fine.
    """
    return valid_rows(first_rows(df, keys, tiebreak))


def _joined(
    parts: DataFrame, keys: Sequence[str], cell: Column, step: int, sums: Sequence[str]
) -> DataFrame:
    """Gap figures of cells from those of their parts, which follow each other in time.

    A part knows its first and last timestamp, its gaps and the largest; what
    lies between it and the part before is one more delta.
    """
    in_cell = Window.partitionBy("_cell", *keys).orderBy("_start")
    earlier = in_cell.rowsBetween(Window.unboundedPreceding, -1)
    border = F.col("_first") - F.max("_last").over(earlier)
    is_gap = F.col("_border") != step
    return (
        parts.withColumn("_cell", cell)
        .withColumn("_border", border)
        .groupBy(*keys, "_cell")
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            (F.sum("_gaps") + F.count_if(is_gap)).alias("_gaps"),
            F.max(F.greatest("_largest", F.when(is_gap, F.col("_border")))).alias("_largest"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
            F.min("_start").alias("_start"),
        )
        .drop("_cell")
    )


def _audit_timestamps(
    stamps: DataFrame, keys: Sequence[str], step_seconds: int, sums: Sequence[str]
) -> DataFrame:
    """Gap figures per series from distinct timestamps.

    ``stamps`` has one row per (series, ts), ``copies`` rows behind it and a
    flag ``counts`` for those that belong to the audited series. Figures merge
    from time cells to wider ones, so no window covers a whole series. A chunk
    of time has at most ``CHUNK_STEPS`` timestamps on the grid of steps; where
    any chunk has many more, narrower cells come first, each with about
    ``CELL_PARTS`` parts at most, whatever the timestamps are. Runs jobs.
    """
    step = step_seconds * 1_000_000
    at = F.when(F.col("counts"), micros(F.col("ts")))
    again = F.when(at.isNotNull(), F.col("copies") - 1)
    parts = stage(
        stamps.select(
            *keys,
            *sums,
            F.when(F.col("counts"), F.col("copies")).alias("rows"),
            at.isNotNull().cast("long").alias("distinct_ts"),
            # Every further copy of a timestamp is a delta of zero, a gap too.
            F.coalesce(again, F.lit(0)).alias("_gaps"),
            F.when(again > 0, F.lit(0).cast("long")).alias("_largest"),
            at.alias("_first"),
            at.alias("_last"),
            micros(F.col("ts")).alias("_start"),
        ),
        "stamps",
    )
    chunk = step * CHUNK_STEPS
    cell = lambda width: F.expr(f"_start div {width}L")

    def crowded(width: int) -> bool:
        sizes = parts.groupBy(*keys, cell(width).alias("_cell")).count()
        return not sizes.where(F.col("count") > CELL_PARTS).isEmpty()

    # Distinct timestamps are a microsecond apart at least, so this ends soon.
    widths = [chunk]
    while crowded(widths[0]):
        widths.insert(0, -(-widths[0] // CELL_PARTS))
    sums = [*sums, "rows", "distinct_ts"]
    for width in widths:
        parts = _joined(parts, keys, cell(width), step, sums)
    whole = _joined(parts, keys, F.lit(0), step, sums)
    to_ts = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return whole.select(
        *keys,
        *sums[:-2],
        F.coalesce("rows", F.lit(0)).alias("rows"),
        "distinct_ts",
        to_ts("_first").alias("min_ts"),
        to_ts("_last").alias("max_ts"),
        F.col("_gaps").alias("gaps"),
        F.floor(F.col("_largest") / 1_000_000).cast("long").alias("largest_gap_seconds"),
    )


def series_audit(
    df: DataFrame, keys: Sequence[str], step_seconds: int = 60, ts: str = "open_ts"
) -> DataFrame:
    """Rows, duplicates, time span and gaps of each series.

    A gap is any time from one row to the next other than one step; it does
    not matter which of the rows sharing a timestamp comes first.
    """
    stamps = (
        df.groupBy(*keys, F.col(ts).alias("ts"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumns(
            {
                "counts": F.col("ts").isNotNull(),
                "rows_in": F.col("copies"),
                "duplicates": F.col("copies") - 1,
            }
        )
    )
    audit = _audit_timestamps(stamps, keys, step_seconds, ["rows_in", "duplicates"])
    return audit.select(
        *keys, F.col("rows_in").alias("rows"), "duplicates", "min_ts", "max_ts",
        "gaps", "largest_gap_seconds",
    )


def cleaning_audit(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str], step_seconds: int = 60
) -> DataFrame:
    """What each cleaning step dropped, and the gaps of what is left.

    One pass: rows meet per (series, timestamp), combined before the shuffle;
    rows with a missing essential value share the group without timestamp.
    """
    rows = typed(df)
    essential = present_only(rows, SILVER_ESSENTIAL)
    candles = with_timestamps(rows.withColumn("_known", all_known(rows, essential)))
    first = F.struct(*tiebreak)
    stamps = (
        candles.withColumn("ts", F.when(F.col("_known"), F.col("open_ts")))
        .groupBy("ts", *keys)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min_by(F.coalesce(ohlc_valid(), F.lit(False)), first).alias("_valid"),
        )
    )
    known = F.col("ts").isNotNull()
    stamps = stamps.withColumns(
        {
            "rows_in": F.col("copies"),
            "dropped_null": F.when(known, 0).otherwise(F.col("copies")),
            "dropped_duplicate": F.when(known, F.col("copies") - 1).otherwise(0),
            "dropped_invalid": F.when(known & ~F.col("_valid"), 1).otherwise(0),
            "counts": known & F.col("_valid"),
        }
    ).withColumn("copies", F.lit(1))
    sums = ["rows_in", "dropped_null", "dropped_duplicate", "dropped_invalid"]
    audit = _audit_timestamps(stamps, keys, step_seconds, sums)
    return audit.select(
        *keys, *sums, F.col("distinct_ts").alias("rows_out"), "min_ts", "max_ts",
        "gaps", "largest_gap_seconds",
    )


def audit_of_first(
    df: DataFrame, first: DataFrame, keys: Sequence[str], step_seconds: int = 60
) -> DataFrame:
    """What ``cleaning_audit`` says, from rows and their ``first_rows``, stored before.

    No copies are compared again: rows are counted per series, and gaps need
    the timestamps of valid first rows only.
    """
    rows = typed(df)
    known = all_known(rows, present_only(rows, SILVER_ESSENTIAL))
    counted = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(known).alias("_known")
    )
    valid = F.coalesce(ohlc_valid(), F.lit(False))
    firsts = first.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_first"), F.count_if(valid).alias("_valid")
    )
    gaps = series_audit(valid_rows(first), keys, step_seconds).drop("rows", "duplicates")
    joined = join_null_safe(join_null_safe(counted, firsts, keys, "left"), gaps, keys, "left")
    n_first, n_valid = (F.coalesce(c, F.lit(0)) for c in ("_first", "_valid"))
    return joined.select(
        *keys,
        "rows_in",
        (F.col("rows_in") - F.col("_known")).alias("dropped_null"),
        (F.col("_known") - n_first).alias("dropped_duplicate"),
        (n_first - n_valid).alias("dropped_invalid"),
        n_valid.alias("rows_out"),
        "min_ts",
        "max_ts",
        F.coalesce("gaps", F.lit(0)).alias("gaps"),
        "largest_gap_seconds",
    )
