"""Regimes, price seasons, calendar, backfill, geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schema
from candlemill.functions import candle as C
from candlemill.operators import features
from candlemill.session import stage
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import rounded, run

BACKFILL = schema.Regimes("2024-01-12 00:00:00", "2024-01-22 00:00:00", False)


@run(
    O.query(
        f"""SELECT o_orderkey, {O.ORDER_REGIME.replace('open_ts', 'o_orderdate')} AS market_regime,
          {O.regime('o_orderdate', '1997-03-11 00:00:00', '1999-01-01 00:00:00', False)}
            AS other_regime
        FROM orders"""
    )
)
def market_regime(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "orders")
    labelled = features.with_regime(rows, T.ORDER_REGIMES, "o_orderdate")
    other = C.regime_label(F.col("o_orderdate"), T.ORDER_REGIMES_2)
    return labelled.select("o_orderkey", "market_regime", other.alias("other_regime"))


@run(O.query("SELECT symbol, open_ts, close, price_season FROM model", ("model",)))
def price_season(spark: SparkSession, sf: str) -> DataFrame:
    bars = stage(T.hour_bars(spark, sf).select("symbol", "open_ts", "close"))
    return features.with_price_season(bars)


@run(
    O.query(
        """SELECT symbol, open_ts, close,
             CASE WHEN close <= max(CASE WHEN i = floor((n - 1) * 0.25 + 0.5) THEN close END)
                    OVER (PARTITION BY symbol) THEN 'low'
                  WHEN close >= max(CASE WHEN i = floor((n - 1) * 0.75 + 0.5) THEN close END)
                    OVER (PARTITION BY symbol) THEN 'high' ELSE 'mid' END AS price_season
           FROM (SELECT symbol, open_ts, close, count(*) OVER (PARTITION BY symbol) AS n,
                   row_number() OVER (PARTITION BY symbol ORDER BY close) - 1 AS i FROM bars)""",
        ("bars",),
    )
)
def price_season_by_symbol(spark: SparkSession, sf: str) -> DataFrame:
    bars = stage(T.hour_bars(spark, sf).select("symbol", "open_ts", "close"))
    return features.with_price_season(bars, T.KEYS)


@run(
    O.query(
        """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(month(o_orderdate) AS INTEGER) AS month,
             CAST(day(o_orderdate) AS INTEGER) AS day,
             CAST(hour(o_orderdate) AS INTEGER) AS hour,
             CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
             concat(CAST(year(o_orderdate) AS VARCHAR), '-Q',
                    CAST(quarter(o_orderdate) AS VARCHAR)) AS year_quarter
           FROM orders"""
    )
)
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    dated = features.with_calendar(rows, "o_orderdate")
    return features.with_quarter(dated, "o_orderdate").drop("o_orderdate")


_BACKFILL = "range_hl body_oc return_1h log_return_1h volatility_24h"


@run(
    O.query(
        f"""SELECT symbol, open_ts, market_regime, range_hl, body_oc, return_1h, log_return_1h,
              {O.rolled('stddev_samp', 'log_return_1h', 24, 2).format(order='open_ts')}
                AS volatility_24h
            FROM (SELECT symbol, open_ts, high - low AS range_hl,
                    abs(close - open) AS body_oc, {O.KLINE_BACKFILL} AS market_regime,
                    {O.ratio('(PARTITION BY symbol ORDER BY open_ts)')} - 1 AS return_1h,
                    {O.ln(O.ratio('(PARTITION BY symbol ORDER BY open_ts)'))} AS log_return_1h
                  FROM bars)""",
        ("bars",), _BACKFILL,
    )
)
def backfill(spark: SparkSession, sf: str) -> DataFrame:
    filled = features.backfill(T.hour_bars(spark, sf), T.KEYS, BACKFILL)
    return rounded(filled.select("symbol", "open_ts", "market_regime", *_BACKFILL.split()))


_GEOMETRY = "range_hl body_oc range_hl_pct body_abs body_pct"


@run(
    O.query(
        """SELECT event_id, high - low AS range_hl, close - open AS body_oc,
             (high - low) / nullif(close, 0) AS range_hl_pct, abs(close - open) AS body_abs,
             abs(close - open) / nullif(open, 0) AS body_pct FROM klines""",
        ("klines",), _GEOMETRY,
    )
)
def candle_geometry(spark: SparkSession, sf: str) -> DataFrame:
    open_, high, low, close = (F.col(c) for c in ("open", "high", "low", "close"))
    return rounded(
        T.klines(spark, sf).select(
            "event_id",
            C.range_hl(high, low).alias("range_hl"),
            C.body_oc(open_, close).alias("body_oc"),
            C.range_hl_pct(high, low, close).alias("range_hl_pct"),
            C.body_abs(open_, close).alias("body_abs"),
            C.body_pct(open_, close).alias("body_pct"),
        )
    )
