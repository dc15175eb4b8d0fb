"""The two analysis stages: tables by name, built from stored layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from candlemill import schema
from candlemill.operators import features, ordered, quality, report
from candlemill.session import stage
from candlemill.sources.store import write_report

KEYS = ("symbol",)


def result_tables(silver: DataFrame, gold: DataFrame) -> dict[str, DataFrame]:
    """State, structure, nulls, descriptives, months, regimes, outliers, charts."""
    schema.require_columns(silver, schema.CANDLE_COLUMNS, "silver")
    schema.require_columns(gold, schema.CANDLE_COLUMNS, "gold")
    gold = stage(features.backfill(gold, KEYS), "results-gold")
    monthly = stage(report.monthly_close(gold, KEYS), "results-monthly")
    tiebreak = ["period", *KEYS]
    top, change = [*KEYS, "period", "mean_close"], ["volatility", "rows"]
    labels = schema.BACKFILL_REGIMES.labels
    sampled = ordered.every_nth(gold, KEYS, ["open_ts"], 50, unique=True)
    return {
        "dataset_state": quality.dataset_state(silver, "silver_1m", KEYS).unionByName(
            quality.dataset_state(gold, "gold_1h", KEYS, step_seconds=None)
        ),
        "structure_silver": quality.schema_table(silver),
        "nulls_silver": quality.null_counts(silver),
        "nulls_gold": quality.null_counts(gold),
        "describe_gold": quality.describe(gold, schema.GOLD_DESCRIBE_COLUMNS),
        "monthly_close": monthly,
        "top_highest": report.project(
            report.top_highest(monthly, tiebreak), [*top, "max_close", *change]
        ),
        "top_lowest": report.project(
            report.top_lowest(monthly, tiebreak), [*top, "min_close", *change]
        ),
        "top_stable": report.project(report.top_stable(monthly, tiebreak), [*top, *change]),
        "regimes": report.regime_table(gold),
        "outliers": quality.iqr_outliers(gold, ["close", "volume"]),
        "correlation": quality.correlation_matrix(gold, schema.CORRELATION_COLUMNS),
        "series_close": report.project(gold, [*KEYS, "open_ts", "close"]),
        "histogram_close": report.histogram(gold, "close", 60),
        "histogram_volume": report.histogram(gold, "volume", 60),
        "box_close": report.box_stats(gold, "close", "market_regime", labels),
        "box_log_return": report.box_stats(gold, "log_return_1h", "market_regime", labels),
        "scatter_close_volume": report.project(sampled, ["close", "volume"]),
    }


def noise_tables(
    bronze: DataFrame, silver: DataFrame, tiebreak: Sequence[str] = ("source_file",)
) -> dict[str, DataFrame]:
    """The same questions about 1-minute noise, before and after cleaning."""
    indexed = features.minute_features(bronze, KEYS, tiebreak, "bronze", index="_index")
    indexed = stage(indexed, "noise-bronze")
    raw = indexed.drop("_index")
    kept = stage(features.minute_features(silver, KEYS, (), "silver", unique=True), "noise-silver")
    named = (("bronze_1m", raw), ("silver_1m", kept))
    monthly = stage(report.monthly_noise(raw, KEYS), "noise-monthly")
    by_month = ["period", *KEYS]
    top = [
        *KEYS, "period", "mean_close", "volatility", "mean_abs_log_return",
        "mean_range_hl_pct", "rows",
    ]
    boxes = raw.selectExpr("'all' AS dataset", "log_return_1m", "range_hl_pct")
    def sample(n: int, columns: Sequence[str]) -> DataFrame:
        return indexed.filter(indexed["_index"] % n == 0).select(*columns)

    tables = {
        "dataset_state": quality.dataset_state(raw, "bronze_1m", KEYS).unionByName(
            quality.dataset_state(kept, "silver_1m", KEYS)
        ),
        "metrics": quality.noise_metrics(raw, "bronze_1m").unionByName(
            quality.noise_metrics(kept, "silver_1m")
        ),
        "outliers": quality.iqr_outliers(raw, dataset="bronze_1m").unionByName(
            quality.iqr_outliers(kept, dataset="silver_1m")
        ),
        "monthly_noise": monthly,
        "top_noisy": report.project(report.top_noisy(monthly, by_month), top),
        "top_stable": report.project(report.top_stable(monthly, by_month), top),
        "histogram_close": report.histogram(raw, "close", 60),
        "histogram_volume": report.histogram(raw, "volume", 60),
        "histogram_log_return": report.histogram(raw, "log_return_1m", 80),
        "box_log_return": report.box_stats(boxes, "log_return_1m", "dataset", ["all"]),
        "box_range_hl_pct": report.box_stats(boxes, "range_hl_pct", "dataset", ["all"]),
        "series_close": sample(240, [*KEYS, "open_ts", "close"]),
        "series_volatility": sample(240, [*KEYS, "open_ts", "volatility_60"]).dropna(),
        "scatter_return_volume": sample(120, ["abs_log_return_1m", "volume"]).dropna(),
    }
    for name, df in named:
        tables[f"nulls_{name}"] = quality.null_counts(df, name)
        tables[f"describe_{name}"] = quality.describe(df, schema.MINUTE_DESCRIBE_COLUMNS)
    return tables


# Row order of the tables that have one, and tables that grow with the data.
TABLE_ORDER = {
    "monthly_close": [*KEYS, "month_ts"],
    "monthly_noise": [*KEYS, "month_ts"],
    "regimes": ["market_regime"],
    "series_close": [*KEYS, "open_ts"],
    "series_volatility": [*KEYS, "open_ts"],
    "histogram_close": ["bin"],
    "histogram_volume": ["bin"],
    "histogram_log_return": ["bin"],
    "box_close": ["place"],
    "box_log_return": ["place"],
    "box_range_hl_pct": ["place"],
}
GROWING = ("series_close", "series_volatility", "scatter_close_volume", "scatter_return_volume")


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per table: one file in key order, several for growing tables."""
    for name, table in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_report(table, path, TABLE_ORDER.get(name, ()), single=name not in GROWING)
