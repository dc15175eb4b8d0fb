"""Candles into larger bars, and bar completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions.order_key import packed_order
from candlemill.schema import SUM_COLUMNS, present_only


def bar_values(
    df: DataFrame, ts: str = "open_ts", tiebreak: Sequence[str] = ()
) -> list[Column]:
    """What a bar holds of its candles; all of it combines before the shuffle.

    First and last are taken by time (then ``tiebreak``), not by arrival. A
    sum over missing values only is 0.
    """
    at = F.col(ts)
    if tiebreak:
        # A number where it can be, so that a hash aggregate holds it.
        packed = packed_order(df, [ts, *tiebreak])
        at = F.struct(ts, *tiebreak) if packed is None else packed
    sums = present_only(df, SUM_COLUMNS)
    zero = {c: F.lit(0).cast(df.schema[c].dataType) for c in sums}
    return [
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at).alias("close"),
        *[F.coalesce(F.sum(c), zero[c]).alias(c) for c in sums],
        F.count(F.lit(1)).alias("rows_in_bar"),
    ]


def bars(
    df: DataFrame,
    every: str = "1 hour",
    keys: Sequence[str] = ("symbol",),
    ts: str = "open_ts",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Tumbling left-closed bars labelled by their start; empty bars are absent."""
    start = F.window(ts, every)["start"].cast("timestamp_ntz").alias("open_ts")
    return df.groupBy(*keys, start).agg(*bar_values(df, ts, tiebreak))


def ticks(df: DataFrame, price: str) -> DataFrame:
    """Priced events as one-price candles, ready for :func:`bars`."""
    return df.withColumns({c: F.col(price) for c in ("open", "high", "low", "close")})


def mark_complete(df: DataFrame, expected_rows: int) -> DataFrame:
    """A bar is complete when it was made of exactly ``expected_rows`` rows."""
    return df.withColumn("bar_complete", F.col("rows_in_bar") == expected_rows)


def complete_bars(df: DataFrame, expected_rows: int) -> DataFrame:
    return mark_complete(df, expected_rows).filter("bar_complete")


def bar_audit(
    df: DataFrame, expected_rows: int, keys: Sequence[str] = ()
) -> DataFrame:
    complete = F.count_if(F.col("bar_complete"))
    total = F.count(F.lit(1))
    return (
        mark_complete(df, expected_rows)
        .groupBy(*keys)
        .agg(
            total.alias("bars_total"),
            complete.alias("bars_complete"),
            (total - complete).alias("bars_incomplete"),
        )
    )
