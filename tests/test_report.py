import random
from datetime import datetime

import numpy as np
import pytest
from helpers import rows_of

from candlemill.operators import report


def test_histogram_closes_the_last_bin(frame):
    values = [0.0, 0.5, 1.0, 2.0, 3.0, 6.0, 6.0, 6.0, None, float("nan")]
    got = report.histogram(frame([(v,) for v in values], "x double"), "x", 60).collect()
    want, edges = np.histogram([v for v in values[:8]], bins=60)
    assert [r.rows for r in sorted(got, key=lambda r: r.bin)] == list(want)
    assert got[0].lower == edges[0] and max(r.upper for r in got) == pytest.approx(edges[-1])


def test_histogram_of_a_constant_and_of_nothing(frame):
    one = report.histogram(frame([(5.0,)] * 3, "x double"), "x", 4).collect()
    assert [r.rows for r in sorted(one, key=lambda r: r.bin)] == [0, 0, 3, 0]
    none = report.histogram(frame([(None,)], "x double"), "x", 4)
    assert none.columns == ["bin", "lower", "upper", "rows"] and none.collect() == []


def test_box(frame):
    rng = random.Random(2)
    rows = [(g, rng.gauss(0, 1) ** 3) for g in ("a", "b", "other") for _ in range(300)]
    rows += [("a", None)]
    df = frame(rows, "g string, x double")
    got = report.box_stats(df, "x", "g", ["b", "a", "none"]).collect()
    assert [r.g for r in got] == ["b", "a", "none"]
    for r in got[:2]:
        x = np.array([v for g, v in rows if g == r.g and v is not None])
        q1, q2, q3 = np.percentile(x, [25, 50, 75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, q2, q3))
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
        assert r.outliers == 300 - len(inside) and r.rows == 300
    assert tuple(got[2])[2:] == (None,) * 7


MONTH_DDL = "period string, mean_close double, volatility double"


def test_top_lists(frame):
    rows = [(f"2024-{i:02d}", float(i), None if i == 3 else float(-i)) for i in range(1, 13)]
    rows.append(("2023-12", None, 0.5))
    monthly = frame(rows, MONTH_DDL)
    high = [r.period for r in report.top_highest(monthly).collect()]
    assert high[:2] == ["2023-12", "2024-12"] and len(high) == 10
    assert [r.period for r in report.top_stable(monthly, n=2).collect()] == ["2024-12", "2024-11"]
    assert [r.period for r in report.top_noisy(monthly, n=1).collect()] == ["2023-12"]


def test_optional_columns(frame):
    df = frame([(datetime(2024, 5, 3), 2.0)], "open_ts timestamp_ntz, close double")
    row = report.monthly_close(df, []).first()
    assert (row.period, row.rows, row.volatility) == ("2024-05", 1, None)
    empty = report.regime_table(df)
    assert "market_regime" in empty.columns and empty.collect() == []


def test_rows_per_file(frame):
    df = frame([("a",), ("a",), ("b",)], "source_file string")
    assert rows_of(report.rows_per_file(df), "source_file", "rows") == [
        ("a", 2), ("b", 1), (None, 3)]


def test_projection_skips_absent_columns(frame):
    assert report.project(frame([(1, 2)], "a int, b int"), ["b", "c"]).columns == ["b"]
