"""Bars and their completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlemill.operators import resample
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import BAR_COLUMNS, BAR_DOUBLES, rounded, run


@run(O.query(f"SELECT {BAR_COLUMNS} FROM bars", ("bars",), BAR_DOUBLES))
def bars_1h(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.hour_bars(spark, sf).select(*BAR_COLUMNS.split(", ")))


@run(
    O.query(f"SELECT {BAR_COLUMNS}, true AS bar_complete FROM bars WHERE rows_in_bar = 2",
            ("bars",), BAR_DOUBLES)
)
def bars_complete(spark: SparkSession, sf: str) -> DataFrame:
    kept = resample.complete_bars(T.hour_bars(spark, sf), 2)
    return rounded(kept.select(*BAR_COLUMNS.split(", "), "bar_complete"))


@run(
    O.query(
        """SELECT symbol, count(*) AS bars_total,
             count(*) FILTER (rows_in_bar = 2) AS bars_complete,
             count(*) FILTER (rows_in_bar <> 2) AS bars_incomplete
           FROM bars GROUP BY symbol""",
        ("bars",),
    )
)
def bar_audit(spark: SparkSession, sf: str) -> DataFrame:
    return resample.bar_audit(T.hour_bars(spark, sf), 2, T.KEYS)


@run(O.query("SELECT symbol, open_ts, open, high, low, close, rows_in_bar FROM days", ("days",)))
def bars_1d_orders(spark: SparkSession, sf: str) -> DataFrame:
    return T.order_days(spark, sf)
