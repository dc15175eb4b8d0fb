"""Column lists, label presets and the required-column contract."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The positional columns of a raw candle file.
RAW_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_volume",
    "taker_buy_quote_volume", "ignore",
]
LONG_COLUMNS = ["open_time", "close_time", "number_of_trades"]
DOUBLE_COLUMNS = [c for c in RAW_COLUMNS if c not in LONG_COLUMNS]
LINEAGE_COLUMNS = ["source_file", "file_period", "file_year", "file_month"]
SUM_COLUMNS = [
    "volume", "quote_asset_volume", "number_of_trades",
    "taker_buy_base_volume", "taker_buy_quote_volume",
]

BRONZE_ESSENTIAL = ["open_time", "close_time", "open", "high", "low", "close"]
SILVER_ESSENTIAL = BRONZE_ESSENTIAL + ["open_ts", "close_ts", "volume"]
CANDLE_COLUMNS = ["open_ts", "open", "high", "low", "close", "volume"]

RAW_SCHEMA = T.StructType(
    [
        T.StructField(c, T.LongType() if c in LONG_COLUMNS else T.DoubleType())
        for c in RAW_COLUMNS
    ]
)

# The columns of the model table.
MODEL_COLUMNS = [
    "open_ts", "year", "month", "day", "hour", "quarter", "year_quarter",
    "market_regime", "price_season", "open", "high", "low", "close", "volume",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_volume",
    "taker_buy_quote_volume", "range_hl", "body_oc", "return_1h",
    "log_return_1h", "sma_24h", "sma_168h", "volatility_24h",
    "volume_sma_24h", "target_close",
]
MODEL_NOT_REQUIRED = ["year", "month", "day", "hour", "quarter"]
MODEL_REQUIRED = [c for c in MODEL_COLUMNS if c not in MODEL_NOT_REQUIRED]

# The columns of the result tables.
CORRELATION_COLUMNS = [
    "open", "high", "low", "close", "volume", "number_of_trades",
    "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume",
]
GOLD_DESCRIBE_COLUMNS = [
    "open", "high", "low", "close", "volume", "number_of_trades",
    "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume",
    "range_hl", "body_oc", "return_1h", "log_return_1h", "volatility_24h",
]
MINUTE_DESCRIBE_COLUMNS = [
    "open", "high", "low", "close", "volume", "number_of_trades",
    "quote_asset_volume", "range_hl", "range_hl_pct", "body_abs", "body_pct",
    "return_1m", "log_return_1m", "abs_log_return_1m", "volatility_60",
]
OUTLIER_COLUMNS = ["volume", "range_hl_pct", "log_return_1m", "abs_log_return_1m"]


@dataclass(frozen=True)
class Regimes:
    """Three labels split by two dates; the end of the middle may be included."""

    middle_from: str
    middle_to: str
    include_end: bool
    labels: tuple[str, str, str] = ("pre_covid", "covid", "post_covid")


# The two rules in use. The gold layer's own rule, and the other
# one that applies only to a table arriving without a label.
GOLD_REGIMES = Regimes("2020-03-01 00:00:00", "2023-05-31 23:59:59", True)
BACKFILL_REGIMES = Regimes("2020-03-11 00:00:00", "2022-01-01 00:00:00", False)

PRICE_SEASONS = ("low", "mid", "high")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """Raise before any job runs when ``df`` lacks a required column."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{name} lacks required columns: {missing}")
    return df


def present_only(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The listed columns that ``df`` has, in the listed order."""
    present = set(df.columns)
    return [c for c in columns if c in present]
