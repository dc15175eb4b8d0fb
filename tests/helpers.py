"""Small candle fixtures."""

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)

CANDLE_DDL = (
    "symbol string, open_time bigint, open double, high double, low double, close double, "
    "volume double, close_time bigint, source_file string"
)


def minute(i: int) -> datetime:
    return START + timedelta(minutes=i)


def epoch_ms(ts: datetime) -> int:
    return int((ts - datetime(1970, 1, 1)).total_seconds() * 1000)


def candle(i, price=10.0, symbol="A", file="A-1m-2024-01.csv", **change):
    """Valid 1-minute candle number ``i``; keywords replace single values."""
    start = epoch_ms(minute(i))
    row = {
        "symbol": symbol,
        "open_time": start,
        "open": price,
        "high": price + 1,
        "low": price - 1,
        "close": price,
        "volume": 1.0,
        "close_time": start + 59_999,
        "source_file": file,
    }
    row.update(change)
    return tuple(row.values())


def rows_of(df, *columns):
    out = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(out, key=repr)
