"""Candle views derived from the test tables.

The test data holds no candles, so raw 1-minute candles are made from
``events``: natural duplicates, missing prices, impossible prices, negative
volume and epochs in two units.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.operators import clean, resample
from candlemill.schema import Regimes
from candlemill.session import use_utc

TIEBREAK = ["source_file", "event_id"]
KEYS = ["symbol"]
KLINE_REGIMES = Regimes("2024-01-10 00:00:00", "2024-01-20 23:59:59", True)
ORDER_REGIMES = Regimes("1997-03-01 00:00:00", "1999-05-31 23:59:59", True)
ORDER_REGIMES_2 = Regimes("1997-03-11 00:00:00", "1999-01-01 00:00:00", False)

# Same text for both engines but for the braces.
_KLINE_COLUMNS = """
  event_type AS symbol,
  CASE WHEN ts < {ntz} '2024-01-16 00:00:00' THEN {ms} ELSE {us} END AS open_time,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS open,
  value + (user_id % 10) * CAST(0.25 AS DOUBLE) - CAST(0.25 AS DOUBLE) AS high,
  value - (event_id % 5) * CAST(0.20 AS DOUBLE) AS low,
  CASE WHEN event_id % 101 = 0 THEN NULL
       ELSE value + ((event_id % 3) - 1) * CAST(0.10 AS DOUBLE) END AS close,
  CASE WHEN event_id % 89 = 0 THEN CAST(-1.0 AS DOUBLE)
       ELSE user_id / CAST(10.0 AS DOUBLE) END AS volume,
  CASE WHEN ts < {ntz} '2024-01-16 00:00:00'
       THEN {ms} + 59999 ELSE {us} + 59999999 END AS close_time,
  CASE WHEN event_id % 83 = 0 THEN NULL
       ELSE value * (user_id / CAST(10.0 AS DOUBLE)) END AS quote_asset_volume,
  1 + user_id % 13 AS number_of_trades,
  user_id / CAST(20.0 AS DOUBLE) AS taker_buy_base_volume,
  value * (user_id / CAST(20.0 AS DOUBLE)) AS taker_buy_quote_volume,
  CAST(0.0 AS DOUBLE) AS {ignore},
  concat(event_type, '-1m-2024-0', CAST(1 + event_id % 2 AS {text}), '.csv') AS source_file,
  event_id
"""

KLINES_SPARK = "SELECT " + _KLINE_COLUMNS.format(
    ntz="timestamp_ntz", ms="(us div 1000)", us="us", text="string", ignore="`ignore`"
) + """ FROM (SELECT *, t - t % 60000000 AS us FROM
          (SELECT *, unix_micros(CAST(ts AS timestamp)) AS t FROM {events}))"""

KLINES_DUCKDB = "SELECT " + _KLINE_COLUMNS.format(
    ntz="timestamp", ms="epoch_ms(m)", us="epoch_us(m)", text="varchar", ignore='"ignore"'
) + " FROM (SELECT *, date_trunc('minute', ts) AS m FROM events)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(KLINES_SPARK, events=table(spark, sf_dir, "events"))


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.with_timestamps(klines(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw candles whose times and prices are all present."""
    return clean.bronze_rows(stamped(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.silver(klines(spark, sf_dir), KEYS, TIEBREAK)


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.bars(silver(spark, sf_dir), "1 hour", KEYS)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order values, one series per order priority."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").alias("open_ts"),
        "o_totalprice",
        "o_orderkey",
    )
    prices = resample.ticks(orders, "o_totalprice")
    return resample.bars(prices, "1 day", KEYS, tiebreak=["o_orderkey"])
