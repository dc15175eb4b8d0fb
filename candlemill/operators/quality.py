"""Data-quality tables: state, nulls, descriptives, outliers, noise, correlation.

Each table is one aggregate over its input; quantiles add a few more passes.
Inputs that are expensive to derive should be staged by the caller first.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.operators.clean import series_audit
from candlemill.operators.order_stats import quantile_scalars
from candlemill.schema import OUTLIER_COLUMNS, present_only
from candlemill.session import small_table

NEAREST = "nearest"
QUARTILES = [(0.25, NEAREST), (0.5, NEAREST), (0.75, NEAREST)]


def _tagged(dataset: str | None) -> list[Column]:
    return [] if dataset is None else [F.lit(dataset).alias("dataset")]


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def _known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, NaN as NULL."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    none = F.lit(None)
    return df.select(
        *[F.nanvl(F.col(c), none).alias(c) if c in floats else F.col(c) for c in columns]
    )


def dataset_state(
    df: DataFrame,
    dataset: str,
    keys: Sequence[str] = ("symbol",),
    step_seconds: int | None = 60,
    ts: str = "open_ts",
) -> DataFrame:
    """One row: size, time span, duplicates and gaps of a layer.

    Without a step (bars after filtering), duplicates and gaps are NULL.
    """
    width = F.lit(len(df.columns)).cast("long").alias("columns")
    if step_seconds is None:
        none = F.lit(None).cast("long")
        return df.agg(
            F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
        ).select(
            *_tagged(dataset), "rows", width, "min_ts", "max_ts",
            none.alias("duplicates"), none.alias("gaps"), none.alias("largest_gap_seconds"),
        )
    total = series_audit(df, keys, step_seconds, ts).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"),
        F.max("largest_gap_seconds").alias("largest_gap_seconds"),
    )
    return total.select(
        *_tagged(dataset), "rows", width, "min_ts", "max_ts",
        "duplicates", "gaps", "largest_gap_seconds",
    )


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types, in column order."""
    fields = df.schema.fields
    return small_table(
        df.sparkSession,
        variable=(pa.string(), [f.name for f in fields]),
        type=(pa.string(), [f.dataType.simpleString() for f in fields]),
    )


def null_counts(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """Nulls of every column, one row each."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], list(df.columns), "variable", "nulls").select(
        *_tagged(dataset), "variable", "nulls"
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, nulls, mean, deviation, extremes and nearest quartiles.

    One row per statistic, one column per variable; listed columns that do
    not exist are left out, and NaN counts as missing.
    """
    columns = present_only(df, columns)
    if not columns:
        raise ValueError("none of the columns to describe exists")
    df = _known(df, columns)
    q = quantile_scalars(df, columns, QUARTILES)
    aggregates = {}
    for c in columns:
        aggregates |= {
            ("count", c): F.count(c).cast("double"),
            ("null_count", c): F.count_if(F.col(c).isNull()).cast("double"),
            ("mean", c): F.avg(c),
            ("std", c): F.stddev_samp(c),
            ("min", c): F.min(c).cast("double"),
            ("max", c): F.max(c).cast("double"),
        }
    one = df.agg(*[v.alias(f"{s}:{c}") for (s, c), v in aggregates.items()])

    def line(statistic: str) -> Column:
        return F.struct(
            F.lit(statistic).alias("statistic"),
            *[F.col(f"`{statistic}:{c}`").alias(c) for c in columns],
        )

    def quantile_line(statistic: str, prob: float) -> Column:
        return F.struct(
            F.lit(statistic).alias("statistic"),
            *[_number(q.get((c, prob, NEAREST))).alias(c) for c in columns],
        )

    lines = F.array(
        *[line(s) for s in ("count", "null_count", "mean", "std", "min")],
        quantile_line("25%", 0.25),
        quantile_line("50%", 0.5),
        quantile_line("75%", 0.75),
        line("max"),
    )
    return one.select(F.inline(lines))


def noise_metrics(df: DataFrame, dataset: str) -> DataFrame:
    """Level and tails of 1-minute noise, one row; NaN is no value."""
    used = ["abs_log_return_1m", "range_hl_pct", "log_return_1m", "volatility_60"]
    df = _known(df, used)
    q = quantile_scalars(
        df,
        ["abs_log_return_1m", "range_hl_pct"],
        [(0.5, "linear"), (0.99, NEAREST), (0.999, NEAREST)],
    )
    absolute, spread = "abs_log_return_1m", "range_hl_pct"
    means = df.agg(
        F.avg(absolute).alias("mean_abs_log_return"),
        F.stddev_samp("log_return_1m").alias("std_log_return"),
        F.avg(spread).alias("mean_range_hl_pct"),
        F.avg("volatility_60").alias("mean_volatility_60"),
    )
    return means.select(
        *_tagged(dataset),
        "mean_abs_log_return",
        _number(q.get((absolute, 0.5, "linear"))).alias("median_abs_log_return"),
        "std_log_return",
        _number(q.get((absolute, 0.99, NEAREST))).alias("p99_abs_log_return"),
        _number(q.get((absolute, 0.999, NEAREST))).alias("p999_abs_log_return"),
        "mean_range_hl_pct",
        _number(q.get((spread, 0.99, NEAREST))).alias("p99_range_hl_pct"),
        "mean_volatility_60",
    )


def iqr_outliers(
    df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS, dataset: str | None = None
) -> DataFrame:
    """Quartile fences and how many values lie strictly outside of them.

    The share is over all rows, also those without a value; NaN is none.
    """
    df = _known(df, columns)
    q = quantile_scalars(df, columns, [(0.25, NEAREST), (0.75, NEAREST)])
    total = F.count(F.lit(1))
    lines = []
    for c in columns:
        q1, q3 = (q.get((c, p, NEAREST)) for p in (0.25, 0.75))
        spread = None if q1 is None else q3 - q1
        low = None if q1 is None else q1 - 1.5 * spread
        high = None if q1 is None else q3 + 1.5 * spread
        outside = F.count_if((F.col(c) < _number(low)) | (F.col(c) > _number(high)))
        share = F.coalesce(F.try_divide(outside, total) * 100, F.lit(0.0))
        lines.append(
            F.struct(
                F.lit(c).alias("variable"),
                _number(q1).alias("q1"),
                _number(q3).alias("q3"),
                _number(spread).alias("iqr"),
                _number(low).alias("lower_limit"),
                _number(high).alias("upper_limit"),
                outside.alias("outliers"),
                share.alias("outlier_pct"),
            )
        )
    table = df.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))
    return table.select(*_tagged(dataset), "*")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations over rows without nulls: one row per variable.

    All pairs come from one aggregate. A constant column correlates to NULL;
    fewer than two rows or columns give an empty table.
    """
    columns = present_only(df, columns)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pairs = list(combinations_with_replacement(columns, 2))

    def correlation(a: str, b: str) -> Column:
        scale = F.stddev_pop(a) * F.stddev_pop(b)
        return F.try_divide(F.covar_pop(a, b), scale)

    one = rows.agg(
        F.count(F.lit(1)).alias("_n"),
        *[correlation(a, b).alias(f"{a}:{b}") for a, b in pairs],
    ).filter((F.col("_n") >= 2) & F.lit(len(columns) >= 2))
    known = set(pairs)

    def cell(a: str, b: str) -> Column:
        x, y = (a, b) if (a, b) in known else (b, a)
        return F.col(f"`{x}:{y}`").alias(b)

    lines = [F.struct(F.lit(a).alias("variable"), *[cell(a, b) for b in columns]) for a in columns]
    return one.select(F.inline(F.array(*lines)))


def volume_check(df: DataFrame, more_than: int = 3_000_000) -> DataFrame:
    """Row count of a layer against the size it should exceed; reports only."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("rows"), (n > more_than).alias("large_enough"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())
