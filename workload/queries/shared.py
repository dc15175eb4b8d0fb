"""What all query modules share: the registry, helpers and common inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.operators import features
from workload import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def run(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        name = query.__name__
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 digits, for comparison across engines."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), 6).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Nullable whole numbers as doubles and nullable booleans as text.

    Clients differ in how they show a column of them that holds NULLs.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return df.withColumns(
        {c: F.col(c).cast("string" if kinds[c] == "boolean" else "double") for c in columns}
    )


BAR_DOUBLES = (
    "open high low close volume quote_asset_volume taker_buy_base_volume taker_buy_quote_volume"
)
BAR_COLUMNS = (
    "symbol, open_ts, open, high, low, close, volume, quote_asset_volume, number_of_trades, "
    "taker_buy_base_volume, taker_buy_quote_volume, rows_in_bar"
)

ID_COLUMNS = ["symbol", "open_ts", "event_id"]
_MINUTE_INPUT = ["symbol", "open_ts", "source_file", "event_id", "open", "high", "low",
                 "close", "volume", "quote_asset_volume", "number_of_trades"]


def bronze_features(spark: SparkSession, sf: str, index: str | None = None) -> DataFrame:
    rows = T.bronze(spark, sf).select(*_MINUTE_INPUT)
    return features.minute_features(rows, T.KEYS, T.TIEBREAK, unique=True, index=index)


def silver_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.silver(spark, sf).select(*_MINUTE_INPUT)
    return features.minute_features(rows, T.KEYS, unique=True)
