"""Bronze, silver, gold, model input and quarters.

A stage writes its layer as zstd Parquet, range-sorted on its series and time,
and returns an audit table. What is dear to make, parsed rows, first copies and
bars, is stored once; the layer, the sample that range sorting takes, and the
audit all read it from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.candle import regime_label
from candlemill.operators import clean, features, report, resample
from candlemill.operators.quality import volume_check
from candlemill.schema import GOLD_REGIMES, RAW_COLUMNS, Regimes
from candlemill.session import stage
from candlemill.sources import klines, store

KEYS = ("symbol",)
EVERY = "1 hour"
ROWS_PER_BAR = 60
# What orders the copies of one candle: the file, then all raw values.
TIEBREAK = ("source_file", *RAW_COLUMNS)


def build_bronze(spark: SparkSession, csv_path: str, bronze_path: str) -> DataFrame:
    """Raw CSV files to typed rows; returns rows per source file and in total."""
    # Parsed once: the sample for the range sort then reads columns of Parquet.
    rows = stage(klines.read_bronze(spark, csv_path), "parsed")
    store.write_sorted(rows, bronze_path, [*KEYS, "open_time", "source_file"])
    return report.rows_per_file(spark.read.parquet(bronze_path))


def bronze_volume(spark: SparkSession, bronze_path: str) -> DataFrame:
    return volume_check(spark.read.parquet(bronze_path))


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    tiebreak: Sequence[str] = TIEBREAK,
) -> DataFrame:
    """Bronze to clean unique candles; returns the cleaning audit."""
    bronze = spark.read.parquet(bronze_path)
    first = stage(clean.first_rows(bronze, KEYS, tiebreak), "first-rows")
    store.write_sorted(clean.valid_rows(first), silver_path, [*KEYS, "open_ts"], unique=True)
    return clean.audit_of_first(bronze, first, KEYS)


def gold(
    silver: DataFrame,
    expected_rows: int | None = ROWS_PER_BAR,
    every: str = EVERY,
    regimes: Regimes = GOLD_REGIMES,
) -> DataFrame:
    """Bars with features, label and calendar; incomplete bars go first.

    ``expected_rows`` None keeps all bars (and their completeness unknown).
    """
    return gold_of_bars(resample.bars(silver, every, KEYS), expected_rows, regimes)


def gold_of_bars(
    bars: DataFrame, expected_rows: int | None = ROWS_PER_BAR, regimes: Regimes = GOLD_REGIMES
) -> DataFrame:
    if expected_rows is not None:
        made = resample.complete_bars(bars, expected_rows)
    else:
        made = bars.withColumn("bar_complete", F.lit(None).cast("boolean"))
    rows = features.bar_features(made, KEYS)
    return features.with_calendar(features.with_regime(rows, regimes))


def build_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    expected_rows: int = ROWS_PER_BAR,
    every: str = EVERY,
    regimes: Regimes = GOLD_REGIMES,
) -> DataFrame:
    """Silver to gold; returns the bar and regime audit."""
    bars = stage(resample.bars(spark.read.parquet(silver_path), every, KEYS), "bars")
    rows = gold_of_bars(bars, expected_rows, regimes)
    store.write_sorted(rows, gold_path, [*KEYS, "open_ts"], unique=True)
    marked = resample.mark_complete(bars, expected_rows)
    label = regime_label(F.col("open_ts"), regimes)
    return report.gold_audit(marked, label, regimes.labels)


def model_input(gold_rows: DataFrame, season_by: Sequence[str] = ()) -> DataFrame:
    """Gold to the labelled model table; ``gold_rows`` should be a stored layer."""
    labelled = features.with_price_season(
        features.with_target(features.with_quarter(gold_rows)), season_by
    )
    return features.select_model_columns(labelled, KEYS)


def build_model_input(
    spark: SparkSession, gold_path: str, model_path: str, season_by: Sequence[str] = ()
) -> DataFrame:
    """Gold to model input; returns rows per quarter."""
    rows = model_input(spark.read.parquet(gold_path), season_by)
    store.write_sorted(rows, model_path, [*KEYS, "open_ts"], unique=True)
    return report.row_counts(spark.read.parquet(model_path), "year_quarter")


def build_quarters(
    spark: SparkSession, model_path: str, quarters_path: str
) -> tuple[DataFrame, int]:
    """Model input to one folder per quarter.

    Returns the summary per quarter and the number of rows with missing values
    that were left out.
    """
    rows = spark.read.parquet(model_path)
    written = store.write_quarters(
        features.drop_incomplete_model_rows(rows), quarters_path, ["open_ts", *KEYS], True
    )
    summary = report.quarter_summary(spark.read.parquet(quarters_path), quarters_path)
    return summary, rows.count() - written
