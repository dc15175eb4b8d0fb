import math
from datetime import datetime, timedelta

import pytest
from helpers import START
from pyspark.sql import functions as F

from candlemill import schema
from candlemill.functions import candle as C
from candlemill.operators import features

DDL = (
    "symbol string, open_ts timestamp_ntz, open double, high double, low double, close double, "
    "volume double"
)


def hours(closes, symbol="A"):
    return [
        (symbol, START + timedelta(hours=i), 10.0, 12.0, 9.0, c, float(i))
        for i, c in enumerate(closes)
    ]


def by_time(df):
    return [r for r in df.orderBy("symbol", "open_ts").collect()]


def test_bar_features(frame):
    closes = [10.0 + (i * i) % 7 for i in range(200)]
    rows = by_time(features.bar_features(frame(hours(closes), DDL)))
    assert rows[0].return_1h is None and rows[0].log_return_1h is None
    assert rows[5].return_1h == pytest.approx(closes[5] / closes[4] - 1)
    assert rows[5].log_return_1h == pytest.approx(math.log(closes[5] / closes[4]))
    assert rows[5].body_oc == closes[5] - 10.0 and rows[5].range_hl == 3.0
    assert rows[22].sma_24h is None
    assert rows[23].sma_24h == pytest.approx(sum(closes[:24]) / 24)
    assert rows[23].volatility_24h is None and rows[24].volatility_24h is not None
    assert rows[166].sma_168h is None
    assert rows[199].sma_168h == pytest.approx(sum(closes[32:]) / 168)
    assert rows[30].volume_sma_24h == pytest.approx(sum(range(7, 31)) / 24)


def test_series_do_not_mix(frame):
    rows = hours([10.0, 11.0], "A") + hours([50.0, 55.0], "B")
    got = by_time(features.bar_features(frame(rows, DDL)))
    assert [r.return_1h and round(r.return_1h, 6) for r in got] == [None, 0.1, None, 0.1]


def test_rolling_waits_for_known_values(frame):
    closes = [float(i) for i in range(30)]
    closes[5] = None
    rows = by_time(features.bar_features(frame(hours(closes), DDL)))
    assert [i for i, r in enumerate(rows) if r.sma_24h is not None] == [29]


def test_zero_and_negative_prices_give_null(frame):
    rows = by_time(features.bar_features(frame(hours([0.0, 5.0, -5.0, 5.0]), DDL)))
    assert [r.return_1h for r in rows] == [None, None, -2.0, -2.0]
    assert [r.log_return_1h for r in rows] == [None] * 4
    minute = by_time(features.minute_features(frame(hours([0.0, 5.0]), DDL), ["symbol"]))
    assert minute[0].range_hl_pct is None
    assert minute[1].log_diff_close_1m is None


@pytest.mark.parametrize(
    "regimes, ts, label",
    [
        (schema.GOLD_REGIMES, datetime(2020, 2, 29, 23), "pre_covid"),
        (schema.GOLD_REGIMES, datetime(2020, 3, 1), "covid"),
        (schema.GOLD_REGIMES, datetime(2023, 5, 31, 23, 59, 59), "covid"),
        (schema.GOLD_REGIMES, datetime(2023, 6, 1), "post_covid"),
        (schema.BACKFILL_REGIMES, datetime(2020, 3, 10, 23), "pre_covid"),
        (schema.BACKFILL_REGIMES, datetime(2020, 3, 11), "covid"),
        (schema.BACKFILL_REGIMES, datetime(2022, 1, 1), "post_covid"),
        (schema.GOLD_REGIMES, None, "post_covid"),
    ],
)
def test_regimes(frame, regimes, ts, label):
    df = features.with_regime(frame([(ts,)], "open_ts timestamp_ntz"), regimes)
    assert df.first().market_regime == label


def test_backfill_adds_only_what_is_missing(frame):
    df = frame(hours([10.0, 12.0, 9.0]), DDL)
    full = by_time(features.backfill(df))
    assert full[2].body_oc == 1.0
    assert full[1].volatility_24h is None and full[2].volatility_24h is not None
    kept = features.backfill(df.withColumns({"body_oc": F.lit(-7.0), "return_1h": F.lit(0.0)}))
    assert {r.body_oc for r in kept.collect()} == {-7.0}
    assert {r.return_1h for r in kept.collect()} == {0.0}
    bare = frame([(START,)], "open_ts timestamp_ntz")
    assert features.backfill(bare).columns == ["open_ts", "market_regime"]


def test_price_seasons(frame):
    df = frame(hours([float(i) for i in range(1, 9)] + [None]), DDL)
    seasons = {r.close: r.price_season for r in features.with_price_season(df).collect()}
    assert [seasons[float(i)] for i in (3, 4, 5, 6)] == ["low", "mid", "mid", "high"]
    assert seasons[None] == "mid"
    grouped = hours([float(i) for i in range(1, 9)]) + hours([100.0 * i for i in range(1, 9)], "B")
    by = features.with_price_season(frame(grouped, DDL), ["symbol"])
    got = {(r.symbol, r.close): r.price_season for r in by.collect()}
    assert got["A", 8.0] == "high" and got["B", 100.0] == "low" and got["B", 500.0] == "mid"


def test_quarters_and_calendar(frame):
    df = frame([(datetime(2025, 12, 31, 23),)], "open_ts timestamp_ntz")
    row = features.with_quarter(features.with_calendar(df)).first()
    assert (row.year, row.month, row.day, row.hour) == (2025, 12, 31, 23)
    assert (row.quarter, row.year_quarter) == (4, "2025-Q4")


def test_model_columns_are_required(frame):
    with pytest.raises(ValueError, match="sma_168h"):
        features.select_model_columns(frame(hours([1.0]), DDL))


def test_number_text(frame):
    df = frame([(1.005,), (None,), (12345.678,)], "x double")
    got = [r[0] for r in df.select(C.number_text(F.col("x"))).collect()]
    assert got[1:] == ["N/A", "12345.68"]
