import random
from datetime import datetime

import pytest
from helpers import CANDLE_DDL, candle, minute, rows_of
from pyspark.sql import functions as F

from candlemill.functions.candle import epoch_to_ts
from candlemill.operators import clean
from candlemill.schema import missing_columns, require_columns

KEYS, TIEBREAK = ["symbol"], ["source_file", "close"]


def test_mixed_epochs(frame):
    values = [1546300800000, 1735689600000000, 99999999999999, 100000000000000, None]
    df = frame([(v,) for v in values], "t bigint").select(epoch_to_ts(F.col("t")).alias("ts"))
    assert df.schema["ts"].dataType.typeName() == "timestamp_ntz"
    assert [r.ts for r in df.collect()] == [
        datetime(2019, 1, 1),
        datetime(2025, 1, 1),
        datetime(5138, 11, 16, 9, 46, 39, 999000),
        datetime(1973, 3, 3, 9, 46, 40),
        None,
    ]


def test_lenient_typing(frame):
    df = frame([("x", "12.5", " 7 "), ("NaN", "5", ""), (None, None, "x")],
               "open string, number_of_trades string, volume string")
    assert rows_of(clean.typed(df), "open", "number_of_trades", "volume") == rows_of(
        frame([(None, None, 7.0), (None, 5, None), (None, None, None)],
              "open double, number_of_trades bigint, volume double"),
        "open", "number_of_trades", "volume",
    )


def test_timestamps_are_left_alone_or_required(frame):
    ready = frame([(minute(0), 5)], "open_ts timestamp_ntz, open_time bigint")
    assert clean.with_timestamps(ready).first().open_ts == minute(0)
    with pytest.raises(ValueError, match="open_ts"):
        clean.with_timestamps(frame([(1,)], "x int"), "bronze")


def test_first_copy_decides_before_validity(frame):
    rows = [
        candle(0, file="a.csv", high=1.0),
        candle(0, file="b.csv"),
        candle(1, file="b.csv"),
    ]
    silver = clean.silver(frame(rows, CANDLE_DDL), KEYS, TIEBREAK)
    assert rows_of(silver, "open_ts") == [(minute(1),)]


def test_price_rules(frame):
    rows = [
        candle(0, open=5.0, high=5.0, low=5.0, close=5.0),
        candle(1, volume=0.0),
        candle(2, volume=-1.0),
        candle(3, low=10.5),
        candle(4, high=None),
    ]
    kept = clean.valid_rows(clean.with_timestamps(frame(rows, CANDLE_DDL)))
    assert rows_of(kept, "open_ts") == [(minute(0),), (minute(1),)]


def test_audit_counts_each_step(frame):
    rows = [
        candle(0), candle(0, file="z.csv"), candle(1, close=None), candle(2, high=0.0),
        candle(4), candle(5, volume=None), candle(0, symbol="B"),
    ]
    audit = clean.cleaning_audit(frame(rows, CANDLE_DDL), KEYS, TIEBREAK)
    got = {r.symbol: r for r in audit.collect()}
    a = got["A"]
    assert (a.rows_in, a.dropped_null, a.dropped_duplicate, a.dropped_invalid) == (6, 2, 1, 1)
    assert (a.rows_out, a.min_ts, a.max_ts) == (2, minute(0), minute(4))
    assert (a.gaps, a.largest_gap_seconds) == (1, 240)
    b = got["B"]
    assert (b.rows_out, b.gaps, b.largest_gap_seconds) == (1, 0, None)


def test_audit_matches_staged_steps(frame):
    rows = [
        candle(i % 37, price=10.0 + i % 5, file=f"{i % 3}.csv",
               high=None if i % 11 == 0 else 12.0 + i % 4)
        for i in range(200)
    ]
    df = frame(rows, CANDLE_DDL)
    stamped = clean.with_timestamps(df)
    present = clean.not_null_rows(stamped)
    first = clean.keep_first(present, KEYS, TIEBREAK)
    audit = clean.cleaning_audit(df, KEYS, TIEBREAK).first()
    assert audit.rows_in == 200
    assert audit.dropped_null == 200 - present.count()
    assert audit.dropped_duplicate == present.count() - first.count()
    assert audit.rows_out == clean.valid_rows(first).count()


@pytest.mark.parametrize(
    "minutes, gaps, largest, duplicates",
    [([0, 1, 1, 4], 2, 180, 1), ([0, 1, 2], 0, None, 0), ([5], 0, None, 0), ([3, 3], 1, 0, 1),
     ([0, 30_000, 30_001], 1, 1_800_000, 0)],
)
def test_gaps(frame, minutes, gaps, largest, duplicates):
    df = frame([("A", minute(m)) for m in minutes], "symbol string, open_ts timestamp_ntz")
    audit = clean.series_audit(df, KEYS).first()
    assert (audit.rows, audit.gaps, audit.largest_gap_seconds, audit.duplicates) == (
        len(minutes), gaps, largest, duplicates)


def test_gaps_of_nothing(frame):
    df = frame([], "symbol string, open_ts timestamp_ntz")
    assert clean.series_audit(df, KEYS).collect() == []


def test_gaps_across_many_chunks_match_brute_force(frame):
    minutes = sorted({(i * i * 7) % 60_000 for i in range(400)})
    df = frame([("A", minute(m)) for m in minutes], "symbol string, open_ts timestamp_ntz")
    deltas = [b - a for a, b in zip(minutes, minutes[1:])]
    audit = clean.series_audit(df, KEYS).first()
    assert audit.gaps == sum(d != 1 for d in deltas)
    assert audit.largest_gap_seconds == 60 * max(deltas)


@pytest.mark.parametrize("cell_parts", [3, 50, 65_536])
def test_gaps_of_series_off_the_grid_match_brute_force(spark, monkeypatch, cell_parts):
    monkeypatch.setattr(clean, "CELL_PARTS", cell_parts)
    rng = random.Random(cell_parts)
    at = [rng.randint(-(10**9), 10**9) for _ in range(300)] + [0, 0, 60_000_000, 60_000_000, 7]
    at += [i * 1_000 for i in range(300)]
    rows = [("A", x) for x in at] + [("B", 5), ("A", None), (None, 1), (None, 60_000_001)]
    df = spark.createDataFrame(rows, "symbol string, us long").select(
        "symbol", F.timestamp_micros("us").cast("timestamp_ntz").alias("open_ts")
    )
    got = {r.symbol: r for r in clean.series_audit(df, KEYS).collect()}
    deltas = [b - a for a, b in zip(sorted(at), sorted(at)[1:])]
    assert got["A"].gaps == sum(d != 60_000_000 for d in deltas)
    assert got["A"].largest_gap_seconds == max(d for d in deltas if d != 60_000_000) // 1_000_000
    assert got["A"].rows == len(at) + 1 and got["A"].duplicates == len(at) - len(set(at))
    assert (got["B"].gaps, got["B"].largest_gap_seconds, got[None].gaps) == (0, None, 0)


def test_crowded_chunks_are_split(spark):
    n = 200_000
    df = spark.range(n).select(
        F.lit("A").alias("symbol"),
        F.timestamp_micros(F.col("id") * 1_000).cast("timestamp_ntz").alias("open_ts"),
    )
    audit = clean.series_audit(df, KEYS)
    (row,) = audit.collect()
    assert (row.rows, row.gaps, row.largest_gap_seconds) == (n, n - 1, 0)
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 3


def test_required_columns(frame):
    df = frame([(1,)], "open int")
    assert missing_columns(df, ["open", "close"]) == ["close"]
    with pytest.raises(ValueError, match="close"):
        require_columns(df, ["open", "close"], "gold")


def test_audit_of_stored_first_rows_equals_the_audit(frame):
    from helpers import candle

    rows = [candle(i, symbol=s) for s in ("A", None) for i in (*range(40), *range(45, 90), 5, 5, 60)]
    rows += [candle(i, symbol="B", close=None) for i in range(5)]  # nothing left
    rows += [candle(i, symbol="C", high=1.0) for i in range(3)]  # nothing valid
    rows += [candle(7, symbol="A", volume=-1.0, file="0"), candle(200, symbol="A", volume=-1.0)]
    df = frame(rows, CANDLE_DDL)
    first = clean.first_rows(df, KEYS, TIEBREAK)
    got = clean.audit_of_first(df, first, KEYS)
    wanted = clean.cleaning_audit(df, KEYS, TIEBREAK)
    assert got.columns == wanted.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
