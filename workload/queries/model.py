"""Gold and the model table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions import candle as C
from candlemill.operators import features, report, resample
from candlemill.plans import layers
from candlemill.session import new_folder, stage
from candlemill.sources import store
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import BAR_COLUMNS, BAR_DOUBLES, rounded, run

_FEATURES = (
    "range_hl body_oc return_1h log_return_1h sma_24h sma_168h volatility_24h volume_sma_24h"
)
_GOLD = f"{BAR_COLUMNS}, market_regime, year, month, day, hour, " + ", ".join(_FEATURES.split())


@run(O.query(f"SELECT {_GOLD} FROM gold", ("gold",), f"{BAR_DOUBLES} {_FEATURES}"))
def gold(spark: SparkSession, sf: str) -> DataFrame:
    rows = layers.gold(T.silver(spark, sf), None, regimes=T.KLINE_REGIMES)
    return rounded(rows.select(*_GOLD.split(", ")))


_COMPLETE = O._features("(SELECT * FROM bars WHERE rows_in_bar = 2)")


@run(
    O.query(
        f"SELECT {BAR_COLUMNS}, {', '.join(_FEATURES.split())}, true AS bar_complete FROM complete",
        ("bars",), f"{BAR_DOUBLES} {_FEATURES}", complete=_COMPLETE,
    )
)
def gold_complete(spark: SparkSession, sf: str) -> DataFrame:
    """Incomplete bars go before the windows run."""
    rows = layers.gold(T.silver(spark, sf), 2, regimes=T.KLINE_REGIMES)
    names = [*BAR_COLUMNS.split(", "), *_FEATURES.split(), "bar_complete"]
    return rounded(rows.select(*names))


@run(
    O.query(
        f"""SELECT CAST(sum(rows_in_bar) AS BIGINT) AS rows_in, count(*) AS bars_total,
              count(*) FILTER (rows_in_bar <> 2) AS bars_incomplete,
              count(*) FILTER (rows_in_bar = 2) AS rows_out,
              min(open_ts) FILTER (rows_in_bar = 2) AS min_ts,
              max(open_ts) FILTER (rows_in_bar = 2) AS max_ts,
              count(*) FILTER (rows_in_bar = 2 AND {O.KLINE_REGIME} = 'pre_covid')
                AS rows_pre_covid,
              count(*) FILTER (rows_in_bar = 2 AND {O.KLINE_REGIME} = 'covid') AS rows_covid,
              count(*) FILTER (rows_in_bar = 2 AND {O.KLINE_REGIME} = 'post_covid')
                AS rows_post_covid
            FROM bars""",
        ("bars",),
    )
)
def gold_audit(spark: SparkSession, sf: str) -> DataFrame:
    marked = resample.mark_complete(T.hour_bars(spark, sf), 2)
    label = C.regime_label(F.col("open_ts"), T.KLINE_REGIMES)
    return report.gold_audit(marked, label, T.KLINE_REGIMES.labels)


_MODEL_DOUBLES = f"{BAR_DOUBLES} {_FEATURES} target_close"


def _model(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(layers.gold(T.silver(spark, sf), None, regimes=T.KLINE_REGIMES), "gold")
    return layers.model_input(rows)


@run(O.query("SELECT * FROM model", ("model",), _MODEL_DOUBLES))
def model_input(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_model(spark, sf))


@run(O.query("SELECT * FROM model_clean", ("model_clean",), _MODEL_DOUBLES))
def model_clean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.drop_incomplete_model_rows(_model(spark, sf)))


@run(O.query("SELECT * FROM model_clean", ("model_clean",), _MODEL_DOUBLES))
def quarter_split(spark: SparkSession, sf: str) -> DataFrame:
    """Written one folder per quarter, then read back."""
    folder = new_folder(spark, "quarters")
    kept = features.drop_incomplete_model_rows(_model(spark, sf))
    store.write_quarters(kept, folder, ["open_ts", *T.KEYS], unique=True)
    back = spark.read.schema(kept.schema).parquet(folder)
    return rounded(back.select(*kept.columns))
