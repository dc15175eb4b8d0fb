"""Returns, rolling statistics, row numbers, gaps, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from candlemill.functions import candle as C
from candlemill.operators import clean, features, ordered
from candlemill.operators.rolling import Rolling, add_rolling
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import (
    ID_COLUMNS,
    bronze_features,
    plain,
    rounded,
    run,
    silver_features,
)

_RETURNS = "close_diff_1m return_1m log_return_1m log_diff_close_1m"


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return features.bar_features(T.hour_bars(spark, sf), T.KEYS)


@run(
    O.query(
        "SELECT symbol, open_ts, event_id, close_diff_1m, return_1m, log_return_1m, "
        "log_diff_close_1m FROM silver_1m",
        ("silver_1m",), _RETURNS,
    )
)
def returns(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(silver_features(spark, sf).select(*ID_COLUMNS, *_RETURNS.split()))


@run(
    O.query(
        "SELECT symbol, open_ts, event_id, close_diff_1m, return_1m, log_return_1m, "
        "log_diff_close_1m FROM bronze_1m",
        ("bronze_1m",), _RETURNS,
    )
)
def returns_with_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(bronze_features(spark, sf).select(*ID_COLUMNS, *_RETURNS.split()))


@run(
    O.query(
        "SELECT symbol, open_ts, sma_24h, sma_168h, volume_sma_24h FROM features",
        ("features",), "sma_24h sma_168h volume_sma_24h",
    )
)
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        _features(spark, sf).select("symbol", "open_ts", "sma_24h", "sma_168h", "volume_sma_24h")
    )


@run(
    O.query(
        "SELECT symbol, open_ts, volatility_24h FROM features", ("features",), "volatility_24h"
    )
)
def rolling_std(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_features(spark, sf).select("symbol", "open_ts", "volatility_24h"))


@run(
    O.query(
        "SELECT symbol, open_ts, event_id, abs_log_return_1m, volatility_60 FROM bronze_1m",
        ("bronze_1m",), "abs_log_return_1m volatility_60",
    )
)
def rolling_noise(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze_features(spark, sf)
    return rounded(rows.select(*ID_COLUMNS, "abs_log_return_1m", "volatility_60"))


@run(
    O.query(
        """SELECT symbol, open_ts, event_id, row_number() OVER
             (PARTITION BY symbol ORDER BY open_ts, source_file, event_id) - 1 AS row_index
           FROM bronze""",
        ("bronze",),
    )
)
def row_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.bronze(spark, sf).select(*ID_COLUMNS, "source_file")
    indexed = ordered.with_row_index(rows, T.KEYS, ["open_ts", *T.TIEBREAK], unique=True)
    return indexed.drop("source_file")


@run(
    O.query(
        "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events"
    )
)
def row_index_one_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "events").select("event_id", "ts")
    return ordered.with_row_index(rows, [], ["ts", "event_id"], unique=True).drop("ts")


def _halo_sql(mean: str, std: str) -> str:
    w = "OVER (ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    return f"""SELECT event_id,
        CASE WHEN count(value) {w} >= 24 THEN avg(value) {w} END AS {mean},
        CASE WHEN count(value) {w} >= 24 THEN stddev_samp(value) {w} END AS {std}
        FROM events"""


@run(O.query(_halo_sql("mean_24", "std_24"), (), "mean_24 std_24"))
def rolling_halo(spark: SparkSession, sf: str) -> DataFrame:
    """One long series in chunks of 1,000 rows."""
    rows = T.table(spark, sf, "events").select("event_id", "ts", "value")

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        specs = [Rolling("mean_24", "mean", "value", 24), Rolling("std_24", "std", "value", 24)]
        return add_rolling(df, [ordered.CHUNK], ordered.POSITION, specs)

    out = ordered.over_rows(rows, [], ["ts", "event_id"], 23, build, 1_000, unique=True)
    return rounded(out.select("event_id", "mean_24", "std_24"))


@run(
    O.query(
        """SELECT symbol, open_ts, CAST(epoch_us(open_ts) - lag(epoch_us(open_ts)) OVER
             (PARTITION BY symbol ORDER BY open_ts) AS DOUBLE) AS delta_micros FROM silver""",
        ("silver",),
    )
)
def time_deltas(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.silver(spark, sf).select("symbol", "open_ts")

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        return df.withColumn("delta_micros", C.time_delta_micros(F.col("open_ts"), w))

    deltas = ordered.over_rows(rows, T.KEYS, ["open_ts"], 1, build, unique=True)
    return plain(deltas, "delta_micros")


@run(
    O.query("SELECT symbol, gaps, largest_gap_seconds FROM g", ("silver",), g=O.gaps("silver"))
)
def gap_audit(spark: SparkSession, sf: str) -> DataFrame:
    return clean.series_audit(T.silver(spark, sf), T.KEYS).select(
        "symbol", "gaps", "largest_gap_seconds"
    )


@run(
    O.query(
        """SELECT symbol, open_ts, event_id, close FROM (
             SELECT *, row_number() OVER (PARTITION BY symbol
               ORDER BY open_ts, source_file, event_id) - 1 AS i FROM bronze)
           WHERE i % 50 = 0""",
        ("bronze",),
    )
)
def sample_1_in_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.bronze(spark, sf).select(*ID_COLUMNS, "source_file", "close")
    kept = ordered.every_nth(rows, T.KEYS, ["open_ts", *T.TIEBREAK], 50, True)
    return kept.drop("source_file")
