"""Per-row and windowed candle expressions built from native functions.

Division by zero and logarithms of non-positive numbers give NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlemill.schema import PRICE_SEASONS, Regimes

# Epochs from this value on are microseconds, smaller ones milliseconds.
MICROSECOND_EPOCH_FROM = 100_000_000_000_000


def epoch_to_ts(epoch: Column) -> Column:
    """Naive UTC timestamp of an epoch in milliseconds or microseconds."""
    return (
        F.when(epoch >= F.lit(MICROSECOND_EPOCH_FROM), F.timestamp_micros(epoch))
        .otherwise(F.timestamp_millis(epoch))
        .cast("timestamp_ntz")
    )


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a naive UTC timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def lenient(column: Column, type_name: str) -> Column:
    """Typed value, NULL where the text does not parse; NaN counts as NULL."""
    value = column.try_cast(type_name)
    return F.nanvl(value, F.lit(None).cast("double")) if type_name == "double" else value


def all_known(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether no column is NULL or NaN, as single tests that a scan can take over."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
        if df.schema[c].dataType.typeName() in ("double", "float"):
            known = known & ~F.isnan(c)
    return known


def range_hl(high: Column, low: Column) -> Column:
    return high - low


def body_oc(open_: Column, close: Column) -> Column:
    return close - open_


def range_hl_pct(high: Column, low: Column, close: Column) -> Column:
    return F.try_divide(high - low, close)


def body_abs(open_: Column, close: Column) -> Column:
    return F.abs(close - open_)


def body_pct(open_: Column, close: Column) -> Column:
    return F.try_divide(F.abs(close - open_), open_)


def ohlc_valid() -> Column:
    """High bounds everything from above, low from below, volume not negative.

    NULL, hence not kept by a filter, when a compared price is missing.
    """
    open_, high, low, close = (F.col(c) for c in ("open", "high", "low", "close"))
    top = (high >= open_) & (high >= close) & (high >= low)
    bottom = (low <= open_) & (low <= close)
    return top & bottom & (F.col("volume") >= 0)


def time_delta_micros(ts: Column, w: WindowSpec) -> Column:
    return micros(ts) - F.lag(micros(ts)).over(w)


def simple_return(price: Column, w: WindowSpec) -> Column:
    return F.try_divide(price, F.lag(price).over(w)) - 1


def log_return(price: Column, w: WindowSpec) -> Column:
    return F.ln(F.try_divide(price, F.lag(price).over(w)))


def log_difference(price: Column, w: WindowSpec) -> Column:
    return F.ln(price) - F.lag(F.ln(price)).over(w)


def difference(value: Column, w: WindowSpec) -> Column:
    return value - F.lag(value).over(w)


def rolling(
    aggregate: Callable[[Column], Column],
    value: Column,
    w: WindowSpec,
    rows: int,
    min_rows: int | None = None,
) -> Column:
    """Aggregate over the last ``rows`` rows.

    NULL until the frame holds ``min_rows`` (default ``rows``) non-null values.
    """
    frame = w.rowsBetween(1 - rows, 0)
    enough = F.count(value).over(frame) >= (rows if min_rows is None else min_rows)
    return F.when(enough, aggregate(value).over(frame))


def regime_label(ts: Column, regimes: Regimes) -> Column:
    before, middle, after = (F.lit(label) for label in regimes.labels)
    start = F.lit(regimes.middle_from).cast("timestamp_ntz")
    end = F.lit(regimes.middle_to).cast("timestamp_ntz")
    inside = ts <= end if regimes.include_end else ts < end
    return F.when(ts < start, before).when(inside, middle).otherwise(after)


def price_season_label(price: Column, q1: Column, q3: Column) -> Column:
    low, mid, high = (F.lit(label) for label in PRICE_SEASONS)
    return F.when(price <= q1, low).when(price >= q3, high).otherwise(mid)


def calendar(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def year_quarter(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def number_text(value: Column, decimals: int = 2) -> Column:
    """Fixed-decimals text for reports, ``N/A`` for a missing number."""
    text = F.format_string(f"%.{decimals}f", value.cast("double"))
    return F.when(value.isNull(), F.lit("N/A")).otherwise(text)
