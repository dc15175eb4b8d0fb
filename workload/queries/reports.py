"""Months, top lists, regimes, quarters, histograms, boxes, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from candlemill.functions import candle as C
from candlemill.operators import features, ordered, report
from candlemill.plans import analysis
from candlemill.session import new_folder, stage
from candlemill.sources import store
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import ID_COLUMNS, bronze_features, plain, rounded, run

_MONTH_DOUBLES = "mean_close min_close max_close std_close volatility"
_MONTH_SQL = """SELECT symbol, CAST(date_trunc('month', open_ts) AS TIMESTAMP) AS month_ts,
    avg(close) AS mean_close, min(close) AS min_close, max(close) AS max_close,
    stddev_samp(close) AS std_close, count(*) AS rows,
    stddev_samp(log_return_1h) AS volatility,
    strftime(date_trunc('month', open_ts), '%Y-%m') AS period
    FROM day_returns GROUP BY symbol, date_trunc('month', open_ts)"""


def _order_months(spark: SparkSession, sf: str) -> DataFrame:
    days = T.order_days(spark, sf).select("symbol", "open_ts", "close")

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        return df.withColumn("log_return_1h", C.log_return(F.col("close"), w))

    returns = ordered.over_rows(days, T.KEYS, ["open_ts"], 1, build, unique=True)
    return report.monthly_close(returns, T.KEYS)


@run(O.query(_MONTH_SQL, ("day_returns",), _MONTH_DOUBLES))
def monthly_close(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_order_months(spark, sf))


_NOISE_MONTH_SQL = """SELECT symbol, CAST(date_trunc('month', open_ts) AS TIMESTAMP) AS month_ts,
    avg(close) AS mean_close, stddev_samp(log_return_1m) AS volatility,
    avg(abs_log_return_1m) AS mean_abs_log_return, avg(range_hl_pct) AS mean_range_hl_pct,
    avg(volume) AS mean_volume, count(*) AS rows,
    strftime(date_trunc('month', open_ts), '%Y-%m') AS period
    FROM bronze_1m GROUP BY symbol, date_trunc('month', open_ts)"""


@run(
    O.query(_NOISE_MONTH_SQL, ("bronze_1m",),
            "mean_close volatility mean_abs_log_return mean_range_hl_pct mean_volume")
)
def monthly_noise(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.monthly_noise(bronze_features(spark, sf), T.KEYS))


def _top_sql(order: str, where: str = "true") -> str:
    return O.query(
        f"SELECT * FROM m WHERE {where} ORDER BY {order}, period, symbol LIMIT 10",
        ("day_returns",), _MONTH_DOUBLES, m=_MONTH_SQL,
    )


_BY_MONTH = ["period", "symbol"]


@run(_top_sql("mean_close DESC NULLS FIRST"))
def top10_max(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.top_highest(_order_months(spark, sf), _BY_MONTH))


@run(_top_sql("mean_close NULLS FIRST"))
def top10_min(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.top_lowest(_order_months(spark, sf), _BY_MONTH))


@run(_top_sql("volatility", "volatility IS NOT NULL"))
def top10_stable(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.top_stable(_order_months(spark, sf), _BY_MONTH))


@run(_top_sql("volatility DESC", "volatility IS NOT NULL"))
def top10_noisy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.top_noisy(_order_months(spark, sf), _BY_MONTH))


_NOISE_DOUBLES = (
    "mean_close volatility mean_abs_log_return mean_range_hl_pct mean_volume"
)


def _top_noise_sql(order: str) -> str:
    return O.query(
        f"SELECT * FROM m WHERE volatility IS NOT NULL ORDER BY {order}, period, symbol LIMIT 10",
        ("bronze_1m",), _NOISE_DOUBLES, m=_NOISE_MONTH_SQL,
    )


@run(_top_noise_sql("volatility DESC"))
def top10_noisy_1m(spark: SparkSession, sf: str) -> DataFrame:
    monthly = report.monthly_noise(bronze_features(spark, sf), T.KEYS)
    return rounded(report.top_noisy(monthly, _BY_MONTH))


@run(_top_noise_sql("volatility"))
def top10_stable_1m(spark: SparkSession, sf: str) -> DataFrame:
    monthly = report.monthly_noise(bronze_features(spark, sf), T.KEYS)
    return rounded(report.top_stable(monthly, _BY_MONTH))


@run(O.query(_MONTH_SQL, ("day_returns",), _MONTH_DOUBLES))
def report_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly table, written as a CSV report and read back."""
    table = _order_months(spark, sf)
    folder = new_folder(spark, "report")
    store.write_report(table, folder, _BY_MONTH)
    return rounded(spark.read.schema(table.schema).option("header", True).csv(folder))


@run(
    O.query(
        "SELECT symbol, period, row_number() OVER (ORDER BY symbol, month_ts) AS place "
        "FROM (SELECT DISTINCT symbol, CAST(date_trunc('month', open_ts) AS TIMESTAMP) AS month_ts, "
        "strftime(date_trunc('month', open_ts), '%Y-%m') AS period FROM day_returns)",
        ("day_returns",),
    )
)
def report_order(spark: SparkSession, sf: str) -> DataFrame:
    """Place of each row in the report file: one file, so row numbers follow it."""
    folder = new_folder(spark, "reports")
    analysis.write_tables({"monthly_close": _order_months(spark, sf)}, folder)
    rows = spark.read.option("header", True).csv(f"{folder}/monthly_close")
    return rows.select("symbol", "period", (F.monotonically_increasing_id() + 1).alias("place"))


@run(
    O.query(
        "SELECT symbol, open_ts, close, row_number() OVER (ORDER BY symbol, open_ts) AS place "
        "FROM bars", ("bars",), "close",
    )
)
def sorted_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a layer in the order of its files: names, then places inside them."""
    folder = new_folder(spark, "sorted")
    bars = T.hour_bars(spark, sf).select("symbol", "open_ts", "close")
    store.write_sorted(bars, folder, ["symbol", "open_ts"], unique=True)
    rows = spark.read.parquet(folder).select(
        "*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")
    )
    placed = ordered.with_row_index(rows, [], ["file", "row"], "place", unique=True)
    return rounded(placed.select("symbol", "open_ts", "close", (F.col("place") + 1).alias("place")))


@run(
    O.query(
        """SELECT symbol, CAST(date_trunc('month', open_ts) AS TIMESTAMP) AS month_ts,
             avg(close) AS mean_close, count(*) AS rows, CAST(NULL AS DOUBLE) AS volatility
           FROM bars GROUP BY symbol, date_trunc('month', open_ts)""",
        ("bars",), "mean_close",
    )
)
def monthly_without_returns(spark: SparkSession, sf: str) -> DataFrame:
    """A metric whose column is missing is NULL."""
    monthly = report.monthly_close(T.hour_bars(spark, sf).select("symbol", "open_ts", "close"))
    return rounded(monthly.select("symbol", "month_ts", "mean_close", "rows", "volatility"))


@run(
    O.query(
        "SELECT count(*) AS bars, CAST(0 AS BIGINT) AS regimes FROM bars", ("bars",)
    )
)
def regime_table_without_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Bars without a label column give an empty regime table."""
    bars = T.hour_bars(spark, sf).select("open_ts", "close")
    n = report.regime_table(bars).count()
    return bars.agg(F.count(F.lit(1)).alias("bars"), F.lit(n).cast("long").alias("regimes"))


def _labelled_bars(spark: SparkSession, sf: str) -> DataFrame:
    close = T.hour_bars(spark, sf).select("symbol", "open_ts", "close")

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        return df.withColumn("log_return_1h", C.log_return(F.col("close"), w))

    returns = ordered.over_rows(close, T.KEYS, ["open_ts"], 1, build, unique=True)
    return features.with_regime(returns, T.KLINE_REGIMES)


@run(
    O.query(
        """SELECT market_regime, count(*) AS rows, avg(close) AS mean_close,
             min(close) AS min_close, max(close) AS max_close, stddev_samp(close) AS std_close,
             stddev_samp(log_return_1h) AS return_volatility
           FROM gold GROUP BY market_regime""",
        ("gold",), "mean_close min_close max_close std_close return_volatility",
    )
)
def regime_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.regime_table(_labelled_bars(spark, sf)))


@run(
    O.query(
        f"SELECT {O.ORDER_REGIME} AS market_regime, count(*) AS rows FROM days "
        "GROUP BY market_regime",
        ("days",),
    )
)
def regime_counts(spark: SparkSession, sf: str) -> DataFrame:
    labelled = features.with_regime(T.order_days(spark, sf), T.ORDER_REGIMES)
    return report.row_counts(labelled, "market_regime")


_QUARTER_OF_DAY = O._YEAR_QUARTER


@run(
    O.query(
        f"SELECT {_QUARTER_OF_DAY} AS year_quarter, count(*) AS rows FROM days "
        "GROUP BY year_quarter",
        ("days",),
    )
)
def quarter_counts(spark: SparkSession, sf: str) -> DataFrame:
    return report.row_counts(features.with_quarter(T.order_days(spark, sf)), "year_quarter")


@run(
    O.query(
        f"SELECT count(DISTINCT {_QUARTER_OF_DAY}) AS quarters FROM days", ("days",)
    )
)
def quarter_count(spark: SparkSession, sf: str) -> DataFrame:
    return report.quarter_count(features.with_quarter(T.order_days(spark, sf)))


@run(O.query(f"SELECT DISTINCT {_QUARTER_OF_DAY} AS year_quarter FROM days", ("days",)))
def quarters(spark: SparkSession, sf: str) -> DataFrame:
    return report.quarters(features.with_quarter(T.order_days(spark, sf)))


@run(
    O.query(
        f"""SELECT {_QUARTER_OF_DAY} AS year_quarter, count(*) AS rows,
              min(open_ts) AS min_ts, max(open_ts) AS max_ts FROM days GROUP BY year_quarter""",
        ("days",),
    )
)
def quarter_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.quarter_summary(features.with_quarter(T.order_days(spark, sf)))


@run(
    O.query(
        f"""SELECT {_QUARTER_OF_DAY} AS year_quarter, count(*) AS rows,
              concat('/out/year_quarter=', {_QUARTER_OF_DAY}) AS path FROM days
            GROUP BY year_quarter""",
        ("days",),
    )
)
def quarter_paths(spark: SparkSession, sf: str) -> DataFrame:
    table = report.quarter_summary(features.with_quarter(T.order_days(spark, sf)), "/out/")
    return table.select("year_quarter", "rows", "path")


@run(O.query(O.histogram("bars", "close", 60), ("bars",), "lower upper"))
def hist_close(spark: SparkSession, sf: str) -> DataFrame:
    bars = stage(T.hour_bars(spark, sf).select("close"), "histogram")
    return rounded(report.histogram(bars, "close", 60))


@run(O.query(O.histogram("bronze", "volume", 60), ("bronze",), "lower upper"))
def hist_volume(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.histogram(T.bronze(spark, sf), "volume", 60))


@run(O.query(O.histogram("bronze_1m", "log_return_1m", 80), ("bronze_1m",), "lower upper"))
def hist_log_return(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(bronze_features(spark, sf).select("log_return_1m"), "histogram")
    return rounded(report.histogram(rows, "log_return_1m", 80))


_BOX_DOUBLES = "q1 median q3 whisker_low whisker_high"
_LABELS = list(T.KLINE_REGIMES.labels)


@run(O.query(O.box("gold", "close", "market_regime", _LABELS), ("gold",), _BOX_DOUBLES))
def box_by_regime(spark: SparkSession, sf: str) -> DataFrame:
    bars = features.with_regime(T.hour_bars(spark, sf), T.KLINE_REGIMES)
    rows = stage(bars.select("market_regime", "close"), "box")
    boxes = report.box_stats(rows, "close", "market_regime", _LABELS)
    return rounded(plain(boxes, "outliers", "rows"))


@run(
    O.query(O.box("gold", "log_return_1h", "market_regime", _LABELS), ("gold",), _BOX_DOUBLES)
)
def box_return_by_regime(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled_bars(spark, sf).select("market_regime", "log_return_1h")
    boxes = report.box_stats(stage(rows, "box"), "log_return_1h", "market_regime", _LABELS)
    return rounded(plain(boxes, "outliers", "rows"))


@run(
    O.query(
        O.box("priced", "range_hl_pct", "dataset", ["all", "none"]),
        ("bronze_1m",), _BOX_DOUBLES,
        priced="SELECT 'all' AS dataset, range_hl_pct FROM bronze_1m",
    )
)
def box_range(spark: SparkSession, sf: str) -> DataFrame:
    """One group with values and one without."""
    spread = C.range_hl_pct(F.col("high"), F.col("low"), F.col("close"))
    rows = T.bronze(spark, sf).select(F.lit("all").alias("dataset"), spread.alias("range_hl_pct"))
    boxes = report.box_stats(rows, "range_hl_pct", "dataset", ["all", "none"])
    return rounded(plain(boxes, "outliers", "rows"))


@run(O.query("SELECT symbol, open_ts, close FROM bars", ("bars",)))
def close_series(spark: SparkSession, sf: str) -> DataFrame:
    return report.project(T.hour_bars(spark, sf), ["symbol", "open_ts", "close", "absent"])


def _sampled(source: str, order: str, n: int) -> str:
    return (
        f"(SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) - 1 AS i "
        f"FROM {source}) WHERE i % {n} = 0"
    )


_FULL_ORDER = "open_ts, source_file, event_id"


@run(
    O.query(f"SELECT symbol, open_ts, close FROM {_sampled('bronze', _FULL_ORDER, 240)}",
            ("bronze",))
)
def sample_close(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.bronze(spark, sf).select(*ID_COLUMNS, "source_file", "close")
    kept = ordered.every_nth(rows, T.KEYS, ["open_ts", *T.TIEBREAK], 240, True)
    return kept.select("symbol", "open_ts", "close")


@run(
    O.query(
        f"SELECT symbol, open_ts, volatility_60 FROM {_sampled('bronze_1m', _FULL_ORDER, 240)} "
        "AND volatility_60 IS NOT NULL",
        ("bronze_1m",), "volatility_60",
    )
)
def sample_volatility(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze_features(spark, sf, index="row_index")
    kept = rows.filter(F.col("row_index") % 240 == 0)
    return rounded(kept.select("symbol", "open_ts", "volatility_60").dropna())


@run(
    O.query(f"SELECT symbol, close, volume FROM {_sampled('bars', 'open_ts', 50)}", ("bars",),
            "close volume")
)
def sample_close_volume(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.hour_bars(spark, sf).select("symbol", "open_ts", "close", "volume")
    kept = ordered.every_nth(rows, T.KEYS, ["open_ts"], 50, True)
    return rounded(kept.select("symbol", "close", "volume"))


@run(
    O.query(
        f"SELECT symbol, abs_log_return_1m, volume FROM "
        f"{_sampled('bronze_1m', _FULL_ORDER, 120)} AND abs_log_return_1m IS NOT NULL "
        "AND volume IS NOT NULL",
        ("bronze_1m",), "abs_log_return_1m",
    )
)
def sample_return_volume(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze_features(spark, sf, index="row_index")
    kept = rows.filter(F.col("row_index") % 120 == 0)
    return rounded(kept.select("symbol", "abs_log_return_1m", "volume").dropna())
