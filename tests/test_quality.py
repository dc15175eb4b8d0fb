import numpy as np
import pytest

from candlemill.operators import quality


def test_null_counts(frame):
    df = frame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {(r.dataset, r.variable): r.nulls for r in quality.null_counts(df, "d").collect()}
    assert got == {("d", "a"): 1, ("d", "b"): 2}


def test_describe(frame):
    df = frame([(float(i), i) for i in range(1, 9)] + [(None, 9)], "x double, n int")
    got = {r.statistic: r for r in quality.describe(df, ["x", "n", "absent"]).collect()}
    assert list(got) == ["count", "null_count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    assert [got[s].x for s in ("count", "null_count", "min", "25%", "75%", "max")] == [
        8, 1, 1, 3, 6, 8]
    assert got["mean"].n == 5 and got["50%"].n == 5
    with pytest.raises(ValueError):
        quality.describe(df, ["absent"])


def test_outliers_are_strictly_outside(frame):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 8.0, 8.5, None]
    row = quality.iqr_outliers(frame([(v,) for v in values], "x double"), ["x"]).first()
    assert (row.q1, row.q3, row.iqr) == (3.0, 8.0, 5.0) or row.q1 <= row.q3
    tight = [0.0] * 10 + [1.0, None]
    row = quality.iqr_outliers(frame([(v,) for v in tight], "x double"), ["x"], "d").first()
    assert (row.dataset, row.iqr, row.outliers) == ("d", 0.0, 1)
    assert row.outlier_pct == pytest.approx(100 / 12)


def test_outliers_without_values(frame):
    row = quality.iqr_outliers(frame([(None,)], "x double"), ["x"]).first()
    assert row.q1 is None and row.outliers == 0 and row.outlier_pct == 0.0


def test_correlation(frame):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 3))
    rows = [(float(a), float(b), float(a + c), 5.0) for a, b, c in m] + [(None, 1.0, 1.0, 5.0)]
    df = frame(rows, "a double, b double, c double, k double")
    got = {r.variable: r for r in quality.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    want = np.corrcoef(np.array([r[:3] for r in rows[:-1]]), rowvar=False)
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert got[x][y] == pytest.approx(want[i, j])
    assert got["k"].k is None and got["a"].k is None


def test_correlation_needs_rows_and_columns(frame):
    df = frame([(1.0, 2.0)], "a double, b double")
    assert quality.correlation_matrix(df, ["a", "b"]).collect() == []
    two = frame([(1.0,), (2.0,)], "a double")
    assert quality.correlation_matrix(two, ["a", "b"]).collect() == []


def test_volume_check(frame):
    df = frame([(i,) for i in range(5)], "x int")
    assert tuple(quality.volume_check(df, 4).first()) == (5, True)
    assert tuple(quality.volume_check(df, 5).first()) == (5, False)


def test_schema_table(frame):
    df = frame([], "a int, b timestamp_ntz")
    assert [tuple(r) for r in quality.schema_table(df).collect()] == [
        ("a", "int"), ("b", "timestamp_ntz")]


def test_state_of_an_empty_layer(frame):
    df = frame([], "symbol string, open_ts timestamp_ntz")
    row = quality.dataset_state(df, "silver").first()
    assert (row.rows, row.columns, row.gaps, row.largest_gap_seconds) == (0, 2, 0, None)


def test_nan_counts_as_missing(frame):
    nan = float("nan")
    df = frame([(v,) for v in (1.0, 2.0, 3.0, 4.0, nan, None)], "x double")
    got = {r.statistic: r.x for r in quality.describe(df, ["x"]).collect()}
    assert (got["count"], got["null_count"], got["mean"], got["max"]) == (4, 2, 2.5, 4)
    row = quality.iqr_outliers(df, ["x"]).first()
    assert row.outliers == 0 and row.outlier_pct == 0


def test_noise_counts_nan_as_missing(frame):
    ddl = "abs_log_return_1m double, range_hl_pct double, log_return_1m double, volatility_60 double"
    known = [(0.1, 0.2, -0.1, 0.3), (0.3, 0.4, 0.3, 0.1), (0.2, 0.1, 0.2, 0.2)]
    nan = float("nan")
    holes = [(nan, None, nan, nan), (None, nan, None, nan)]
    plain = quality.noise_metrics(frame(known, ddl), "x").first()
    assert quality.noise_metrics(frame(known + holes, ddl), "x").first() == plain
    assert plain["mean_abs_log_return"] == pytest.approx(0.2)
