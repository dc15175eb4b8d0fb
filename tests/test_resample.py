from datetime import datetime

from helpers import minute, rows_of

from candlemill.operators import resample

DDL = (
    "symbol string, open_ts timestamp_ntz, open double, high double, low double, close double, "
    "volume double, quote_asset_volume double, number_of_trades bigint"
)


def row(i, price, symbol="A", quote=1.0):
    return (symbol, minute(i), price, price + 1, price - 1, price + 0.5, 2.0, quote, 3)


def test_first_and_last_go_by_time(frame):
    rows = [row(59, 7.0), row(0, 5.0), row(30, 9.0), row(60, 1.0)]
    bars = resample.bars(frame(rows, DDL))
    got = {r.open_ts: r for r in bars.collect()}
    first = got[datetime(2024, 1, 1)]
    assert (first.open, first.high, first.low, first.close) == (5.0, 10.0, 4.0, 7.5)
    assert (first.volume, first.number_of_trades, first.rows_in_bar) == (6.0, 9, 3)
    assert got[datetime(2024, 1, 1, 1)].rows_in_bar == 1


def test_missing_values_sum_to_zero(frame):
    rows = [row(i, 5.0, quote=None) for i in range(60)]
    bar = resample.bars(frame(rows, DDL)).first()
    assert bar.quote_asset_volume == 0.0 and bar.rows_in_bar == 60


def test_only_exactly_full_bars_are_complete(frame):
    rows = [row(i, 5.0) for i in range(59)]
    rows += [row(60 + i, 5.0) for i in range(60)]
    rows += [row(120 + i % 60, 5.0) for i in range(61)]
    bars = resample.bars(frame(rows, DDL))
    assert rows_of(resample.complete_bars(bars, 60), "open_ts") == [(minute(60),)]
    audit = resample.bar_audit(bars, 60).first()
    assert (audit.bars_total, audit.bars_complete, audit.bars_incomplete) == (3, 1, 2)


def test_bars_conserve_sums_and_extremes(frame):
    rows = [row(i * 7, 10.0 + i % 9, symbol="AB"[i % 2]) for i in range(300)]
    df = frame(rows, DDL)
    bars = resample.bars(df, "15 minutes").collect()
    assert sum(b.volume for b in bars) == 600.0
    assert sum(b.rows_in_bar for b in bars) == 300
    assert max(b.high for b in bars) == max(r[3] for r in rows)
    assert min(b.low for b in bars) == min(r[4] for r in rows)


def test_ticks_break_ties(frame):
    ddl = "symbol string, open_ts timestamp_ntz, price double, id int"
    rows = [("A", minute(0), 3.0, 2), ("A", minute(0), 1.0, 1), ("A", minute(0), 2.0, 3)]
    bar = resample.bars(resample.ticks(frame(rows, ddl), "price"), "1 day", tiebreak=["id"]).first()
    assert (bar.open, bar.high, bar.low, bar.close) == (1.0, 3.0, 1.0, 2.0)
