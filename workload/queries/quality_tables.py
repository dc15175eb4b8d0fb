"""State, nulls, descriptives, noise, outliers, quantiles, correlation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schema
from candlemill.operators import clean, order_stats, quality
from candlemill.plans import layers
from candlemill.session import small_table, stage
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import bronze_features, plain, rounded, run, silver_features

_WIDTH = 17
_STATE_SQL = (
    O.state("bronze", "bronze_1m", _WIDTH)
    + " UNION ALL " + O.state("silver", "silver_1m", _WIDTH)
    + """ UNION ALL SELECT 'gold_1h', count(*), CAST(12 AS BIGINT), min(open_ts),
          max(open_ts), NULL, NULL, NULL FROM bars"""
)


@run(
    O.query(
        f"""SELECT * REPLACE (CAST(duplicates AS DOUBLE) AS duplicates,
              CAST(gaps AS DOUBLE) AS gaps,
              CAST(largest_gap_seconds AS DOUBLE) AS largest_gap_seconds)
            FROM ({_STATE_SQL})""",
        ("bars",),
    )
)
def dataset_state(spark: SparkSession, sf: str) -> DataFrame:
    raw, kept, bars = T.bronze(spark, sf), T.silver(spark, sf), T.hour_bars(spark, sf)
    state = (
        quality.dataset_state(raw, "bronze_1m", T.KEYS)
        .unionByName(quality.dataset_state(kept, "silver_1m", T.KEYS))
        .unionByName(quality.dataset_state(bars, "gold_1h", T.KEYS, step_seconds=None))
    )
    return plain(state, "duplicates", "gaps", "largest_gap_seconds")


@run(
    O.query(
        "SELECT symbol, count(*) AS rows, count(*) - count(DISTINCT open_ts) AS duplicates "
        "FROM bronze GROUP BY symbol",
        ("bronze",),
    )
)
def dup_count(spark: SparkSession, sf: str) -> DataFrame:
    return clean.series_audit(T.bronze(spark, sf), T.KEYS).select("symbol", "rows", "duplicates")


_NULL_COLUMNS = ["symbol", *schema.RAW_COLUMNS, "source_file", "event_id", "open_ts", "close_ts"]


@run(
    O.query(
        " UNION ALL ".join(
            f"SELECT 'raw' AS dataset, '{c}' AS variable, "
            f"count(*) - count(\"{c}\") AS nulls FROM stamped"
            for c in _NULL_COLUMNS
        ),
        ("stamped",),
    )
)
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(T.stamped(spark, sf), "raw")


_DESCRIBED = schema.MINUTE_DESCRIBE_COLUMNS


@run(
    O.query("SELECT * FROM d", ("silver_1m",), tuple(_DESCRIBED),
            d=O.describe("silver_1m", _DESCRIBED))
)
def describe(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(silver_features(spark, sf).select(*_DESCRIBED), "described")
    return rounded(quality.describe(rows, _DESCRIBED))


_GOLD_DESCRIBED = schema.GOLD_DESCRIBE_COLUMNS


@run(
    O.query("SELECT * FROM d", ("gold",), tuple(_GOLD_DESCRIBED),
            d=O.describe("gold", _GOLD_DESCRIBED))
)
def describe_gold(spark: SparkSession, sf: str) -> DataFrame:
    rows = layers.gold(T.silver(spark, sf), None, regimes=T.KLINE_REGIMES)
    rows = stage(rows.select(*_GOLD_DESCRIBED), "described")
    return rounded(quality.describe(rows, _GOLD_DESCRIBED))


# Every 13th value is not a number, which counts as missing.
_NAN_SQL = """SELECT CASE WHEN event_id % 13 <> 0 THEN value END AS value,
    CAST(user_id AS DOUBLE) AS user_id FROM events"""


def _with_nan(spark: SparkSession, sf: str) -> DataFrame:
    nan = F.lit(float("nan"))
    value = F.when(F.col("event_id") % 13 == 0, nan).otherwise(F.col("value"))
    return T.table(spark, sf, "events").select(
        value.alias("value"), F.col("user_id").cast("double").alias("user_id")
    )


@run(
    O.query("SELECT * FROM d", (), ("value", "user_id"), holed=_NAN_SQL,
            d=O.describe("holed", ["value", "user_id"]))
)
def describe_nan(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.describe(_with_nan(spark, sf), ["value", "user_id"]))


@run(
    O.query(
        " UNION ALL ".join(O.quartile_line("holed", c) for c in ("value", "user_id")),
        (), "q1 q3 iqr lower_limit upper_limit outlier_pct", holed=_NAN_SQL,
    )
)
def outliers_nan(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.iqr_outliers(_with_nan(spark, sf), ["value", "user_id"]))


_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@run(
    O.query("SELECT * FROM d", (), tuple(_LINE_COLUMNS),
            d=O.describe("lineitem", _LINE_COLUMNS))
)
def describe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.describe(T.table(spark, sf, "lineitem"), _LINE_COLUMNS))


def _noise_sql(source: str, dataset: str) -> str:
    return f"""SELECT '{dataset}' AS dataset,
        (SELECT avg(abs_log_return_1m) FROM {source}) AS mean_abs_log_return,
        (SELECT median(abs_log_return_1m) FROM {source}) AS median_abs_log_return,
        (SELECT stddev_samp(log_return_1m) FROM {source}) AS std_log_return,
        {O.nearest(source, 'abs_log_return_1m', 0.99)} AS p99_abs_log_return,
        {O.nearest(source, 'abs_log_return_1m', 0.999)} AS p999_abs_log_return,
        (SELECT avg(range_hl_pct) FROM {source}) AS mean_range_hl_pct,
        {O.nearest(source, 'range_hl_pct', 0.99)} AS p99_range_hl_pct,
        (SELECT avg(volatility_60) FROM {source}) AS mean_volatility_60"""


@run(
    O.query(
        _noise_sql("bronze_1m", "bronze_1m") + " UNION ALL " + _noise_sql("silver_1m", "silver_1m"),
        ("bronze_1m", "silver_1m"),
        "mean_abs_log_return median_abs_log_return std_log_return p99_abs_log_return "
        "p999_abs_log_return mean_range_hl_pct p99_range_hl_pct mean_volatility_60",
    )
)
def noise_metrics(spark: SparkSession, sf: str) -> DataFrame:
    used = ["log_return_1m", "abs_log_return_1m", "range_hl_pct", "volatility_60"]
    raw = stage(bronze_features(spark, sf).select(*used), "noise")
    kept = stage(silver_features(spark, sf).select(*used), "noise")
    return rounded(
        quality.noise_metrics(raw, "bronze_1m").unionByName(
            quality.noise_metrics(kept, "silver_1m")
        )
    )


_OUTLIER_DOUBLES = "q1 q3 iqr lower_limit upper_limit outlier_pct"


@run(
    O.query(
        " UNION ALL ".join(
            O.quartile_line(f"{d}", c, d)
            for d in ("bronze_1m", "silver_1m") for c in schema.OUTLIER_COLUMNS
        ),
        ("bronze_1m", "silver_1m"), _OUTLIER_DOUBLES,
    )
)
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    used = schema.OUTLIER_COLUMNS
    raw = stage(bronze_features(spark, sf).select(*used), "outliers")
    kept = stage(silver_features(spark, sf).select(*used), "outliers")
    return rounded(
        quality.iqr_outliers(raw, dataset="bronze_1m").unionByName(
            quality.iqr_outliers(kept, dataset="silver_1m")
        )
    )


@run(
    O.query(
        " UNION ALL ".join(O.quartile_line("bars", c) for c in ("close", "volume")),
        ("bars",), _OUTLIER_DOUBLES,
    )
)
def outliers_close_volume(spark: SparkSession, sf: str) -> DataFrame:
    bars = stage(T.hour_bars(spark, sf).select("close", "volume"), "outliers")
    return rounded(quality.iqr_outliers(bars, ["close", "volume"]))


_PROBS = (0.25, 0.75, 0.99, 0.999)


@run(
    O.query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS prob, "
            f"{O.nearest('lineitem', c, p)} AS value"
            for c in ("l_extendedprice", "l_quantity") for p in _PROBS
        )
    )
)
def quantiles(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "lineitem")
    probs = [(p, "nearest") for p in _PROBS]
    values = order_stats.quantile_scalars(rows, ["l_extendedprice", "l_quantity"], probs)
    return small_table(
        spark,
        variable=(pa.string(), [c for c, _, _ in values]),
        prob=(pa.float64(), [p for _, p, _ in values]),
        value=(pa.float64(), list(values.values())),
    )


@run(
    O.query(
        """SELECT l_returnflag, 'l_extendedprice' AS variable,
             median(l_extendedprice) AS median FROM lineitem GROUP BY l_returnflag""",
        (), "median",
    )
)
def median(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "lineitem")
    out = order_stats.quantiles(rows, ["l_extendedprice"], [(0.5, "linear")], ["l_returnflag"])
    return rounded(out.select("l_returnflag", "variable", F.col("value").alias("median")))


def _corr_sql(source: str, columns: list[str]) -> str:
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    lines = []
    for a in columns:
        cells = ", ".join(
            f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) AS {b}"
            for b in columns
        )
        lines.append(f"SELECT '{a}' AS variable, {cells} FROM {source} WHERE {known}")
    return " UNION ALL ".join(lines)


@run(O.query(_corr_sql("lineitem", _LINE_COLUMNS), (), tuple(_LINE_COLUMNS)))
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.correlation_matrix(T.table(spark, sf, "lineitem"), _LINE_COLUMNS))


@run(
    O.query(_corr_sql("bars", schema.CORRELATION_COLUMNS), ("bars",),
            tuple(schema.CORRELATION_COLUMNS))
)
def corr_matrix_bars(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        quality.correlation_matrix(T.hour_bars(spark, sf), schema.CORRELATION_COLUMNS)
    )


@run(
    O.query("SELECT event_id, symbol, close FROM klines WHERE close IS NOT NULL", ("klines",))
)
def not_null_metric(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null(T.klines(spark, sf), "close").select("event_id", "symbol", "close")


@run(
    O.query("SELECT count(*) AS rows, count(*) > 3000000 AS large_enough FROM klines", ("klines",))
)
def min_volume(spark: SparkSession, sf: str) -> DataFrame:
    return quality.volume_check(T.klines(spark, sf))


_SILVER_TYPES = {
    "symbol": "string", "open_time": "bigint", "open": "double", "high": "double",
    "low": "double", "close": "double", "volume": "double", "close_time": "bigint",
    "quote_asset_volume": "double", "number_of_trades": "bigint",
    "taker_buy_base_volume": "double", "taker_buy_quote_volume": "double", "ignore": "double",
    "source_file": "string", "event_id": "bigint", "open_ts": "timestamp_ntz",
    "close_ts": "timestamp_ntz",
}


@run(
    O.query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, '{kind}' AS type, count(\"{c}\") AS known FROM silver"
            for c, kind in _SILVER_TYPES.items()
        ),
        ("silver",),
    )
)
def schema_table(spark: SparkSession, sf: str) -> DataFrame:
    """Structure of the silver layer: columns, types, and how many values each has."""
    rows = T.silver(spark, sf)
    known = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns])
    counts = known.unpivot([], rows.columns, "variable", "known")
    return quality.schema_table(rows).join(counts, "variable")
