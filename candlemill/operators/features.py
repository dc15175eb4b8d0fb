"""Returns, rolling statistics, geometry, labels and the model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlemill.functions import candle as C
from candlemill.operators.clean import typed, with_timestamps
from candlemill.operators.order_stats import quantile_scalars, quantiles
from candlemill.operators.ordered import CHUNK, POSITION, join_null_safe, over_rows
from candlemill.operators.rolling import Rolling, add_rolling
from candlemill.schema import (
    BACKFILL_REGIMES,
    GOLD_REGIMES,
    MODEL_COLUMNS,
    MODEL_REQUIRED,
    Regimes,
    require_columns,
)
from candlemill.session import stage

DAY_BARS = 24
WEEK_BARS = 168
MINUTE_WINDOW = 60


def bar_features(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Signed geometry, returns and rolling statistics of bars, one per time.

    Windows count rows, not hours: what was filtered out before leaves no hole.
    """
    close = F.col("close")

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        returns = {
            "range_hl": C.range_hl(F.col("high"), F.col("low")),
            "body_oc": C.body_oc(F.col("open"), close),
            "return_1h": C.simple_return(close, w),
            "log_return_1h": C.log_return(close, w),
        }
        stats = [
            Rolling("sma_24h", "mean", "close", DAY_BARS),
            Rolling("sma_168h", "mean", "close", WEEK_BARS),
            Rolling("volatility_24h", "std", "log_return_1h", DAY_BARS),
            Rolling("volume_sma_24h", "mean", "volume", DAY_BARS),
        ]
        return add_rolling(rows.withColumns(returns), [CHUNK, *keys], POSITION, stats)

    return over_rows(df, keys, ["open_ts"], WEEK_BARS - 1, build, unique=True)


def minute_features(
    df: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str] = (),
    name: str = "candles",
    unique: bool = False,
    index: str | None = None,
) -> DataFrame:
    """Candle rows with 1-row returns, relative geometry and rolling noise.

    Types and timestamps are set only for columns that exist. Rows sharing a
    timestamp are taken in ``tiebreak`` order; say ``unique`` if that leaves
    no ties. ``index`` names a column for the row index, if wanted.
    """
    close, open_ = F.col("close"), F.col("open")
    high, low = F.col("high"), F.col("low")

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        first = {
            "close_diff_1m": C.difference(close, w),
            "return_1m": C.simple_return(close, w),
            "log_return_1m": C.log_return(close, w),
            "log_diff_close_1m": C.log_difference(close, w),
            "range_hl": C.range_hl(high, low),
            "range_hl_pct": C.range_hl_pct(high, low, close),
            "body_abs": C.body_abs(open_, close),
            "body_pct": C.body_pct(open_, close),
        }
        out = rows.withColumns(first).withColumn("abs_log_return_1m", F.abs("log_return_1m"))
        noise = Rolling("volatility_60", "std", "log_return_1m", MINUTE_WINDOW)
        return add_rolling(out, [CHUNK, *keys], POSITION, [noise])

    ready = with_timestamps(typed(df), name)
    order = ["open_ts", *tiebreak]
    return over_rows(ready, keys, order, MINUTE_WINDOW, build, unique=unique, index=index)


def backfill(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    regimes: Regimes = BACKFILL_REGIMES,
) -> DataFrame:
    """Add the bar features a table lacks; columns it has stay as they are.

    Not the gold rules: the body is absolute, volatility needs only two
    returns, and the label dates differ.
    """
    have = set(df.columns)
    plain = {
        name: expression
        for name, needs, expression in (
            ("range_hl", {"high", "low"}, C.range_hl(F.col("high"), F.col("low"))),
            ("body_oc", {"open", "close"}, C.body_abs(F.col("open"), F.col("close"))),
            ("market_regime", {"open_ts"}, C.regime_label(F.col("open_ts"), regimes)),
        )
        if name not in have and needs <= have
    }
    out = df.withColumns(plain) if plain else df
    returns = {
        name
        for name in ("return_1h", "log_return_1h")
        if name not in have and "close" in have
    }
    volatile = "volatility_24h" not in have and (have | returns) >= {"log_return_1h"}
    if not returns and not volatile:
        return out

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        made = {
            "return_1h": lambda: C.simple_return(F.col("close"), w),
            "log_return_1h": lambda: C.log_return(F.col("close"), w),
        }
        new = {name: made[name]() for name in made if name in returns}
        rows = rows.withColumns(new) if new else rows
        if not volatile:
            return rows
        volatility = Rolling("volatility_24h", "std", "log_return_1h", DAY_BARS, min_rows=2)
        return add_rolling(rows, [CHUNK, *keys], POSITION, [volatility])

    return over_rows(out, keys, ["open_ts"], DAY_BARS, build, unique=True)


def with_regime(
    df: DataFrame, regimes: Regimes = GOLD_REGIMES, ts: str = "open_ts"
) -> DataFrame:
    return df.withColumn("market_regime", C.regime_label(F.col(ts), regimes))


def with_calendar(df: DataFrame, ts: str = "open_ts") -> DataFrame:
    return df.withColumns(C.calendar(F.col(ts)))


def with_quarter(df: DataFrame, ts: str = "open_ts") -> DataFrame:
    stamp = F.col(ts)
    return df.withColumns({"quarter": F.quarter(stamp), "year_quarter": C.year_quarter(stamp)})


def with_target(df: DataFrame) -> DataFrame:
    """The target is the close of the same row, not of a later one."""
    return df.withColumn("target_close", F.col("close"))


def with_price_season(
    df: DataFrame, by: Sequence[str] = (), price: str = "close"
) -> DataFrame:
    """Label prices against the first and third quartile.

    Over the whole table, or within each ``by`` group. The quartiles see all
    rows, later ones too.
    """
    close = F.col(price)
    if not by:
        q = quantile_scalars(df, [price], [(0.25, "nearest"), (0.75, "nearest")])
        q1, q3 = (q.get((price, p, "nearest")) for p in (0.25, 0.75))
        label = C.price_season_label(
            close, F.lit(q1).cast("double"), F.lit(q3).cast("double")
        )
        return df.withColumn("price_season", label)
    values = quantiles(df, [price], [(0.25, "nearest"), (0.75, "nearest")], by)
    limits = values.groupBy(*by).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("_q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("_q3"),
    )
    # One row per group. Staged, so that its true size decides the join.
    joined = join_null_safe(df, stage(limits, "limits"), by, "left")
    label = C.price_season_label(close, F.col("_q1"), F.col("_q3"))
    return joined.select(*df.columns, label.alias("price_season"))


def select_model_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The model table's columns in their fixed order, after ``extra`` ones."""
    require_columns(df, MODEL_COLUMNS, "gold")
    return df.select(*extra, *MODEL_COLUMNS)


def drop_incomplete_model_rows(df: DataFrame) -> DataFrame:
    """Keep rows with every required value; long windows cost the first rows."""
    require_columns(df, MODEL_REQUIRED, "model input")
    return df.where(C.all_known(df, MODEL_REQUIRED))
