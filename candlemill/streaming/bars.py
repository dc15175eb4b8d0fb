"""Closed bars of a candle stream, by the same rules as the batch operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.operators import resample
from candlemill.streaming.clean import timed_by


def stream_bars(
    candles: DataFrame,
    every: str = "1 hour",
    late_by: str = "10 minutes",
    keys: Sequence[str] = ("symbol",),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Bars that can no longer change; candles later than ``late_by`` are dropped.

    ``open_ts`` is read as UTC; a watermark that it has already stays.
    """
    timed = timed_by(candles, "open_ts", late_by)
    values = resample.bar_values(timed, tiebreak=tiebreak)
    closed = timed.groupBy(*keys, F.window("open_ts", every).alias("_bar")).agg(*values)
    start = F.col("_bar.start").cast("timestamp_ntz").alias("open_ts")
    return closed.select(*keys, start, *[c for c in closed.columns if c not in (*keys, "_bar")])
