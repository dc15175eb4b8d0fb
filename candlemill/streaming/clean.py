"""First copies and clean candles of a stream, by the same rules as in batch.

A minute's copies may come in any order and over several batches. The state
keeps, per (series, timestamp), the copy that is first in ``tiebreak`` order so
far, not the one that came first; a copy leaves the state, as a result, once
the watermark has passed its timestamp and no other can come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.operators.clean import not_null_rows, typed, valid_rows, with_timestamps

# Fixed value: how Spark marks a column that has a watermark.
_WATERMARK = "spark.watermarkDelayMs"


def timed_by(rows: DataFrame, ts: str, late_by: str) -> DataFrame:
    """Rows with a watermark on ``ts``, read as UTC, as watermarks need a zoned timestamp.

    One that a stateful operator before has set stays: a second one would wait
    for rows that the first operator holds back.
    """
    if _WATERMARK in rows.schema[ts].metadata:
        return rows
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late_by)


def stream_keep_first(
    rows: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str],
    late_by: str = "10 minutes",
    ts: str = "open_ts",
) -> DataFrame:
    """First row per (series, timestamp) in ``tiebreak`` order, once it is final.

    Rows that come after the watermark has passed them are dropped, as are rows
    without a timestamp, which would never be final. Within the watermark the
    result equals ``clean.keep_first``; which of equal rows stays is open. The
    timestamp stays zoned and keeps its watermark for what follows.
    """
    names = rows.columns
    rest = [c for c in names if c not in (*keys, ts)]
    timed = timed_by(rows, ts, late_by).where(F.col(ts).isNotNull())
    first = F.min_by(F.struct(*rest), F.struct(*tiebreak)) if rest else F.lit(None)
    kept = timed.groupBy(*keys, ts).agg(first.alias("_first"))
    return kept.select(*[c if c in (*keys, ts) else F.col("_first")[c].alias(c) for c in names])


def stream_silver(
    candles: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str],
    late_by: str = "10 minutes",
) -> DataFrame:
    """Clean candles of a raw stream, one per (series, minute): ``clean.silver`` on a stream."""
    present = with_timestamps(not_null_rows(typed(candles)))
    return valid_rows(stream_keep_first(present, keys, tiebreak, late_by))
