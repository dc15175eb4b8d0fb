"""Typing, null and price checks, de-duplication, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schema
from candlemill.operators import clean
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import plain, run

_NUMBERS = "open_time, open, high, low, close, volume, number_of_trades"


@run(
    O.query(
        f"""SELECT event_id, {_NUMBERS} FROM (
              SELECT event_id, open_time, high, low, volume, close_time,
                CASE WHEN event_id % 211 = 0 THEN NULL ELSE open END AS open,
                CASE WHEN event_id % 223 = 0 THEN NULL ELSE close END AS close,
                CAST(CASE WHEN event_id % 227 = 0 THEN NULL ELSE number_of_trades END
                  AS DOUBLE) AS number_of_trades
              FROM klines)
            WHERE open_time IS NOT NULL AND close_time IS NOT NULL AND open IS NOT NULL
              AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL""",
        ("klines",),
    )
)
def typed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.klines(spark, sf)
    text = rows.select("event_id", *[F.col(c).cast("string") for c in schema.RAW_COLUMNS])

    def spoil(column: str, every: int, cell: str) -> Column:
        return F.when(F.col("event_id") % every == 0, F.lit(cell)).otherwise(F.col(column))

    spoiled = text.withColumns(
        {
            "open": spoil("open", 211, "x"),
            "close": spoil("close", 223, "NaN"),
            "number_of_trades": spoil("number_of_trades", 227, "12.5"),
        }
    )
    rows = clean.bronze_rows(spoiled).select("event_id", *_NUMBERS.split(", "))
    return plain(rows, "number_of_trades")


@run(O.query("SELECT event_id, open_time, open_ts, close_ts FROM stamped", ("stamped",)))
def epoch_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return T.stamped(spark, sf).select("event_id", "open_time", "open_ts", "close_ts")


@run(O.query("SELECT event_id, open_ts, close_ts, open, close, volume FROM present", ("present",)))
def not_null_silver(spark: SparkSession, sf: str) -> DataFrame:
    return clean.not_null_rows(T.stamped(spark, sf)).select(
        "event_id", "open_ts", "close_ts", "open", "close", "volume"
    )


@run(
    O.query("SELECT symbol, open_ts, source_file, event_id, open, close FROM first_rows",
            ("first_rows",))
)
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    present = clean.not_null_rows(T.stamped(spark, sf))
    return clean.keep_first(present, T.KEYS, T.TIEBREAK).select(
        "symbol", "open_ts", "source_file", "event_id", "open", "close"
    )


@run(
    O.query(
        """SELECT event_id, open, high, low, close, volume FROM klines
           WHERE high >= open AND high >= close AND high >= low AND low <= open
             AND low <= close AND volume >= 0""",
        ("klines",),
    )
)
def ohlc_valid(spark: SparkSession, sf: str) -> DataFrame:
    return clean.valid_rows(T.klines(spark, sf)).select(
        "event_id", "open", "high", "low", "close", "volume"
    )


_SILVER = (
    "symbol, open_ts, close_ts, open, high, low, close, volume, quote_asset_volume, "
    "number_of_trades, taker_buy_base_volume, taker_buy_quote_volume, source_file, event_id"
)


@run(O.query(f"SELECT {_SILVER} FROM silver", ("silver",)))
def silver(spark: SparkSession, sf: str) -> DataFrame:
    return T.silver(spark, sf).select(*_SILVER.split(", "))


@run(
    O.query(
        """SELECT i.symbol, i.rows_in, i.rows_in - p.n AS dropped_null,
             p.n - f.n AS dropped_duplicate, f.n - g.rows AS dropped_invalid,
             g.rows AS rows_out, g.min_ts, g.max_ts, g.gaps, g.largest_gap_seconds
           FROM (SELECT symbol, count(*) AS rows_in FROM klines GROUP BY symbol) i
           JOIN (SELECT symbol, count(*) AS n FROM present GROUP BY symbol) p USING (symbol)
           JOIN (SELECT symbol, count(*) AS n FROM first_rows GROUP BY symbol) f USING (symbol)
           JOIN gap_rows g USING (symbol)""",
        ("silver",),
        gap_rows=O.gaps("silver"),
    )
)
def cleaning_audit(spark: SparkSession, sf: str) -> DataFrame:
    return clean.cleaning_audit(T.klines(spark, sf), T.KEYS, T.TIEBREAK)


@run(
    O.query(
        "SELECT event_id, open_time, open_ts, open, close, volume FROM stamped", ("stamped",)
    )
)
def present_only(spark: SparkSession, sf: str) -> DataFrame:
    """Typing and timestamps on a table without close time and taker columns."""
    some = T.klines(spark, sf).select("event_id", "open_time", "open", "close", "volume")
    return clean.with_timestamps(clean.typed(some)).select(
        "event_id", "open_time", "open_ts", "open", "close", "volume"
    )


_MODEL_HAS = [c for c in schema.MODEL_REQUIRED if c in (
    "open", "high", "low", "close", *schema.SUM_COLUMNS)]
_MODEL_LACKS = [c for c in schema.MODEL_REQUIRED if c not in _MODEL_HAS]


@run(
    O.query(
        " UNION ALL ".join(
            [f"SELECT '{c}' AS variable, 'true' AS present, count({c}) AS known FROM klines"
             for c in _MODEL_HAS]
            + [f"SELECT '{c}' AS variable, 'false' AS present, 0 AS known" for c in _MODEL_LACKS]
        ),
        ("klines",),
    )
)
def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    """What the model table requires and raw candles have, with the rows that have a value."""
    rows = T.klines(spark, sf)
    missing = schema.missing_columns(rows, schema.MODEL_REQUIRED)
    known = [
        F.struct(
            F.lit(c).alias("variable"),
            F.lit("false" if c in missing else "true").alias("present"),
            (F.lit(0).cast("long") if c in missing else F.count(F.col(c))).alias("known"),
        )
        for c in schema.MODEL_REQUIRED
    ]
    return rows.agg(F.array(*known).alias("lines")).select(F.inline("lines"))
