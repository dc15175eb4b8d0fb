"""Report tables: months, regimes, quarters, top lists and chart data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions.candle import month_label
from candlemill.operators.order_stats import quantile_scalars
from candlemill.schema import present_only

QUARTILES = [(0.25, "linear"), (0.5, "linear"), (0.75, "linear")]


def _deviation_or_null(df: DataFrame, column: str) -> Column:
    """Deviation of an optional column, NULL when the table lacks it."""
    return F.stddev_samp(column) if column in df.columns else F.lit(None).cast("double")


def _by_month(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    month = F.date_trunc("MONTH", F.col("open_ts").cast("timestamp")).cast("timestamp_ntz")
    table = df.groupBy(*keys, month.alias("month_ts")).agg(*aggregates)
    return table.withColumn("period", month_label(F.col("month_ts")))


def monthly_close(
    df: DataFrame, keys: Sequence[str] = ("symbol",), log_return: str = "log_return_1h"
) -> DataFrame:
    """Level, range and volatility of the close per calendar month."""
    return _by_month(
        df,
        keys,
        [
            F.avg("close").alias("mean_close"),
            F.min("close").alias("min_close"),
            F.max("close").alias("max_close"),
            F.stddev_samp("close").alias("std_close"),
            F.count(F.lit(1)).alias("rows"),
            _deviation_or_null(df, log_return).alias("volatility"),
        ],
    )


def monthly_noise(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """1-minute noise per calendar month."""
    return _by_month(
        df,
        keys,
        [
            F.avg("close").alias("mean_close"),
            F.stddev_samp("log_return_1m").alias("volatility"),
            F.avg("abs_log_return_1m").alias("mean_abs_log_return"),
            F.avg("range_hl_pct").alias("mean_range_hl_pct"),
            F.avg("volume").alias("mean_volume"),
            F.count(F.lit(1)).alias("rows"),
        ],
    )


def _top(table: DataFrame, first: Column, tiebreak: Sequence[str], n: int) -> DataFrame:
    return table.orderBy(first, *tiebreak).limit(n)


def top_highest(
    monthly: DataFrame, tiebreak: Sequence[str] = ("period",), n: int = 10
) -> DataFrame:
    """Months with the highest mean close; a missing mean ranks first."""
    return _top(monthly, F.desc_nulls_first("mean_close"), tiebreak, n)


def top_lowest(monthly: DataFrame, tiebreak: Sequence[str] = ("period",), n: int = 10) -> DataFrame:
    return _top(monthly, F.asc_nulls_first("mean_close"), tiebreak, n)


def top_stable(monthly: DataFrame, tiebreak: Sequence[str] = ("period",), n: int = 10) -> DataFrame:
    """Months with the lowest known volatility."""
    return _top(monthly.dropna(subset=["volatility"]), F.asc("volatility"), tiebreak, n)


def top_noisy(monthly: DataFrame, tiebreak: Sequence[str] = ("period",), n: int = 10) -> DataFrame:
    """Months with the highest known volatility."""
    return _top(monthly.dropna(subset=["volatility"]), F.desc("volatility"), tiebreak, n)


def regime_table(df: DataFrame, log_return: str = "log_return_1h") -> DataFrame:
    """Close and return statistics per market regime; empty without labels."""
    if "market_regime" not in df.columns:
        return df.sparkSession.createDataFrame(
            [],
            "market_regime string, rows bigint, mean_close double, min_close double, "
            "max_close double, std_close double, return_volatility double",
        )
    return df.groupBy("market_regime").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("close").alias("mean_close"),
        F.min("close").alias("min_close"),
        F.max("close").alias("max_close"),
        F.stddev_samp("close").alias("std_close"),
        _deviation_or_null(df, log_return).alias("return_volatility"),
    )


def row_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value: regimes, quarters, source files."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per source file, and the total in the row without a file."""
    per_file = row_counts(df, "source_file")
    total = per_file.agg(
        F.lit(None).cast("string").alias("source_file"), F.sum("rows").alias("rows")
    )
    return per_file.unionByName(total)


def quarter_summary(df: DataFrame, root: str | None = None) -> DataFrame:
    """Rows and time span per quarter, with its folder when written under ``root``."""
    table = df.groupBy("year_quarter").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("open_ts").alias("min_ts"),
        F.max("open_ts").alias("max_ts"),
    )
    if root is None:
        return table
    folder = F.concat(F.lit(f"{root.rstrip('/')}/year_quarter="), F.col("year_quarter"))
    return table.withColumn("path", folder)


def quarters(df: DataFrame) -> DataFrame:
    """The quarters present, in order."""
    return df.select("year_quarter").distinct().orderBy("year_quarter")


def quarter_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("year_quarter").alias("quarters"))


def gold_audit(
    marked: DataFrame, regime: Column, labels: Sequence[str]
) -> DataFrame:
    """Bars made, kept and lost, and the regimes of the kept ones.

    ``marked`` holds all bars with ``rows_in_bar`` and ``bar_complete``.
    """
    kept = F.col("bar_complete")
    total = F.count(F.lit(1))
    return marked.withColumn("_regime", regime).agg(
        F.coalesce(F.sum("rows_in_bar"), F.lit(0)).alias("rows_in"),
        total.alias("bars_total"),
        (total - F.count_if(kept)).alias("bars_incomplete"),
        F.count_if(kept).alias("rows_out"),
        F.min(F.when(kept, F.col("open_ts"))).alias("min_ts"),
        F.max(F.when(kept, F.col("open_ts"))).alias("max_ts"),
        *[F.count_if(kept & (F.col("_regime") == x)).alias(f"rows_{x}") for x in labels],
    )


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist."""
    return df.select(present_only(df, columns))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the known values, empty ones included.

    The last bin is closed on the right; a constant column gets a unit-wide
    range around its value.
    """
    value = F.col(column).cast("double")
    known = df.select(value.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    low, high = known.agg(F.min("_x"), F.max("_x")).first()
    if low is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, lower double, upper double, rows bigint"
        )
    if low == high:
        low, high = low - 0.5, high + 0.5
    scaled = F.floor((F.col("_x") - low) / (high - low) * bins)
    counts = known.groupBy(F.least(scaled, F.lit(bins - 1)).alias("id")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    width = (high - low) / bins
    all_bins = df.sparkSession.range(bins)
    return all_bins.join(F.broadcast(counts), "id", "left").select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * width).alias("lower"),
        (F.lit(low) + (F.col("id") + 1) * width).alias("upper"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def box_stats(
    df: DataFrame, column: str, by: str, groups: Sequence[str]
) -> DataFrame:
    """Quartiles, whiskers and outlier counts of the listed groups, in order.

    Quartiles interpolate. Whiskers are the extreme values within 1.5 box
    heights of the box. A group without values yields a row of NULLs. Each
    group becomes a column, so a group of any size is only ever aggregated.
    """
    value = F.col(column).cast("double")
    names = [f"g{i}" for i in range(len(groups))]
    wide = df.select(
        *[
            F.when((F.col(by) == g) & ~F.isnan(value), value).alias(name)
            for g, name in zip(groups, names)
        ]
    )
    q = quantile_scalars(wide, names, QUARTILES)
    lines = []
    for place, (group, name) in enumerate(zip(groups, names)):
        q1, q2, q3 = (F.lit(q[name, p, rule]).cast("double") for p, rule in QUARTILES)
        x, reach = F.col(name), 1.5 * (q3 - q1)
        below, above = x < q1 - reach, x > q3 + reach
        none = F.count(name) == 0
        lines.append(
            F.struct(
                F.lit(place).alias("place"),
                F.lit(group).alias(by),
                q1.alias("q1"),
                q2.alias("median"),
                q3.alias("q3"),
                F.least(F.min(F.when(~below, x)), q1).alias("whisker_low"),
                F.greatest(F.max(F.when(~above, x)), q3).alias("whisker_high"),
                F.when(~none, F.count_if(below | above)).alias("outliers"),
                F.when(~none, F.count(name)).alias("rows"),
            )
        )
    return wide.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))
