"""Stateful stream operators against their batch twins."""

import random
from datetime import timedelta

import pyarrow as pa
import pytest
from helpers import START, rows_of
from pyspark.sql import functions as F

from candlemill.operators import clean, features, resample
from candlemill.streaming import features as S
from candlemill.streaming.bars import stream_bars
from candlemill.streaming.clean import stream_keep_first, stream_silver
from candlemill.streaming.features import (
    BAR_STEPS,
    MINUTE_STEPS,
    Step,
    lookback,
    stream_bar_features,
    stream_minute_features,
)

DDL = (
    "symbol string, open_ts timestamp_ntz, source_file string, event_id long, "
    "open double, high double, low double, close double, volume double"
)


def candle(i, rng, symbol="A", event=0, seconds=60):
    price = rng.choice([None, 0.0]) if rng.random() < 0.03 else round(rng.uniform(5, 15), 3)
    return (symbol, START + timedelta(seconds=seconds * i), f"f{rng.randrange(3)}", event,
            10.0, 20.0, 1.0, price, float(rng.randrange(100)))


def finished(df, folder, name="out"):
    """What a stream writes until its source is exhausted; later calls go on from there."""
    query = (
        df.writeStream.format("parquet")
        .option("path", str(folder / name))
        .option("checkpointLocation", str(folder / f"{name}-state"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(180)
    assert query.exception() is None
    return query


def source(spark, folder, ddl=DDL):
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))


def land(spark, folder, rows, ddl=DDL):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def batches(rng, n=600, late=20):
    """Candles of three series in arrival order: copies, reordered rows, some too late."""
    rows = []
    for i in range(n):
        symbol = rng.choice(["hot", "hot", "b", None])
        for copy in range(rng.choice([1, 1, 1, 2, 3])):
            rows.append((i + rng.uniform(0, late / 2), candle(i, rng, symbol, i * 10 + copy)))
    return [r for _, r in sorted(rows, key=lambda r: r[0])]


def test_first_copies_whatever_order_they_come_in(spark, tmp_path):
    rng = random.Random(1)
    rows = batches(rng)
    cut = [rows[i : i + 200] for i in range(0, len(rows), 200)]
    too_late = candle(0, rng, "hot", -1)
    cut[-1].append(too_late)  # first in tiebreak order, but its minute is long closed
    cut[-1].append(("hot", None, "f0", 1, 1.0, 1.0, 1.0, 1.0, 1.0))
    for part in cut:
        land(spark, tmp_path, part)
    kept = stream_keep_first(source(spark, tmp_path), ["symbol"], ["source_file", "event_id"], "20 minutes")
    query = finished(kept, tmp_path)
    got = spark.read.parquet(str(tmp_path / "out"))
    given = spark.createDataFrame([r for part in cut for r in part if r != too_late], DDL)
    last = max(r[1] for r in rows) - timedelta(minutes=20)
    wanted = clean.keep_first(given, ["symbol"], ["source_file", "event_id"]).where(F.col("open_ts") <= last)
    wanted = wanted.withColumn("open_ts", F.col("open_ts").cast("timestamp"))
    assert rows_of(got, *got.columns) == rows_of(wanted, *got.columns)
    # Only the minutes inside the watermark's delay are still held.
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(states) > 3 * 20 > states[-1] / 3
    assert states[-1] <= 3 * 21 < len(rows) / 5


def test_clean_candles_and_bars_of_a_stream(spark, tmp_path):
    from workload import tables as T

    folder = "/root/testdata/sf0.001"
    raw = T.klines(spark, folder)
    raw.repartitionByRange(3, "event_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    rows = stream_silver(stream, T.KEYS, T.TIEBREAK)
    finished(rows, tmp_path, "silver")
    got = spark.read.parquet(str(tmp_path / "silver"))
    batch = T.silver(spark, folder).withColumn("open_ts", F.col("open_ts").cast("timestamp"))
    # The watermark follows the raw rows with known values, valid or not.
    present = clean.not_null_rows(T.stamped(spark, folder))
    last = present.agg(F.max(F.col("open_ts").cast("timestamp")) - F.expr("INTERVAL 10 MINUTES")).first()[0]
    columns = ["symbol", "event_id", "open_ts", "close", "volume"]
    wanted = rows_of(batch.where(F.col("open_ts") <= F.lit(last)), *columns)
    assert len(wanted) > 500 and rows_of(got, *columns) == wanted
    finished(stream_bars(rows), tmp_path, "bars")
    bars = spark.read.parquet(str(tmp_path / "bars"))
    whole = resample.bars(T.silver(spark, folder))
    columns = ["symbol", "open_ts", "open", "close", "rows_in_bar"]
    assert set(rows_of(bars, *columns)) <= set(rows_of(whole, *columns))
    assert whole.count() - bars.count() <= 5


def same(got, wanted, columns):
    assert len(got) == len(wanted)
    for a, b in zip(got, wanted):
        for c, x, y in zip(columns, a, b):
            assert x == pytest.approx(y, rel=1e-9, abs=1e-12) if isinstance(y, float) else x == y, (c, a, b)


def test_minute_features_and_a_restart(spark, tmp_path):
    rng = random.Random(2)
    rows = [r for r in batches(rng, 500) if r[0] is not None]
    half = len(rows) // 2
    tiebreak = ["source_file", "event_id"]

    def run():
        stream = source(spark, tmp_path)
        return finished(stream_minute_features(stream, ["symbol"], tiebreak, "20 minutes"), tmp_path)

    for part in (rows[:100], rows[100:half]):
        land(spark, tmp_path, part)
    run()
    first = spark.read.parquet(str(tmp_path / "out")).count()
    for part in (rows[half : half + 70], rows[half + 70 :]):
        land(spark, tmp_path, part)
    run()  # goes on from its checkpoint
    columns = ["symbol", "open_ts", "event_id", "close", "volume", *[s.name for s in MINUTE_STEPS],
               "range_hl_pct", "body_pct"]
    got = spark.read.parquet(str(tmp_path / "out"))
    last = max(r[1] for r in rows) - timedelta(minutes=20)
    batch = features.minute_features(spark.createDataFrame(rows, DDL), ["symbol"], tiebreak)
    wanted = batch.where(F.col("open_ts") <= last).withColumn("open_ts", F.col("open_ts").cast("timestamp"))
    assert 0 < first < got.count()
    order = ["symbol", "open_ts", "source_file", "event_id"]
    same(got.orderBy(*order).select(*columns).collect(), wanted.orderBy(*order).select(*columns).collect(), columns)
    assert got.where("volatility_60 IS NOT NULL").count() > 50


def test_bar_features(spark, tmp_path):
    rng = random.Random(3)
    rows = [candle(i, rng, symbol, i, 3600) for i in range(400) for symbol in ("A", "B") if rng.random() < 0.9]
    for i in range(0, len(rows), 250):
        land(spark, tmp_path, rows[i : i + 250])
    finished(stream_bar_features(source(spark, tmp_path)), tmp_path)
    got = spark.read.parquet(str(tmp_path / "out"))
    columns = ["symbol", "open_ts", *[s.name for s in BAR_STEPS], "range_hl", "body_oc"]
    batch = features.bar_features(spark.createDataFrame(rows, DDL))
    last = max(r[1] for r in rows)
    wanted = batch.where(F.col("open_ts") <= last).withColumn("open_ts", F.col("open_ts").cast("timestamp"))
    order = ["symbol", "open_ts"]
    same(got.orderBy(*order).select(*columns).collect(), wanted.orderBy(*order).select(*columns).collect(), columns)


def test_lookback_adds_up():
    assert lookback(BAR_STEPS) == 167 and lookback(MINUTE_STEPS) == 60
    assert lookback([Step("a", "absolute", "x")]) == 0 and lookback([]) == 0


def test_a_first_batch_of_many_rows_is_merged_in_blocks(spark, tmp_path, monkeypatch):
    for name, rows in (("BLOCK_ROWS", 16), ("RUN_ROWS", 60), ("RUNS_OF_A_SIZE", 3), ("_ROWS_AT_ONCE", 50)):
        monkeypatch.setattr(S, name, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 25)
    rng = random.Random(4)
    ddl = DDL + ", `_odd name` long"
    rows = [(*r, i) for i, r in enumerate(batches(rng, 700))]
    rng.shuffle(rows)  # nothing is late in the first batch
    try:
        land(spark, tmp_path, rows, ddl)
        stream = stream_minute_features(source(spark, tmp_path, ddl), ["symbol"], ["event_id"], "20 minutes")
        finished(stream, tmp_path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = spark.read.parquet(str(tmp_path / "out"))
    columns = ["symbol", "open_ts", "event_id", "close", "_odd name", *[s.name for s in MINUTE_STEPS]]
    batch = features.minute_features(spark.createDataFrame(rows, ddl), ["symbol"], ["event_id"])
    last = max(r[1] for r in rows) - timedelta(minutes=20)
    wanted = batch.where(F.col("open_ts") <= last).withColumn("open_ts", F.col("open_ts").cast("timestamp"))
    order = ["symbol", "open_ts", "event_id"]
    got, wanted = ([[*r] for r in df.orderBy(*order).select(*[f"`{c}`" for c in columns]).collect()]
                   for df in (got, wanted))
    same(got, wanted, columns)
    assert len(got) > 1000 and None in {r[0] for r in got}


def test_waiting_rows_are_never_held_together(monkeypatch):
    for name, rows in (("BLOCK_ROWS", 64), ("RUN_ROWS", 500), ("RUNS_OF_A_SIZE", 4)):
        monkeypatch.setattr(S, name, rows)
    sizes, plain = [], S._sorted
    monkeypatch.setattr(S, "_sorted", lambda rows, order: (sizes.append(len(rows)), plain(rows, order))[1])

    class Blocks(dict):
        updateValue, removeKey = dict.__setitem__, dict.__delitem__
        getValue = dict.__getitem__

    for n in (8_000, 32_000):
        times = [*range(n)]
        random.Random(n).shuffle(times)
        blocks = Blocks()
        waiting = S._Waiting(blocks, {"next": 0, "runs": [], "timer": None}, ["t", "k"])
        for a in range(0, n, S.RUN_ROWS):
            part = times[a : a + S.RUN_ROWS]
            waiting.add(pa.table({"t": pa.array([t // 3 for t in part], pa.timestamp("us")), "k": part}))
        found = [k for table in waiting.closed(n // 6) for k in table["k"].to_pylist()]
        assert found == [k for k in range(n) if k // 3 <= n // 6]
        assert waiting.first() == n // 6 + 1
        found += [k for table in waiting.closed(n) for k in table["k"].to_pylist()]
        assert found == [*range(n)] and not blocks and waiting.first() is None
    # Four times the rows, one more size of runs.
    assert max(sizes) <= 3 * 4 * 2 * 64


def test_a_timer_that_comes_with_the_watermark(spark, tmp_path):
    rng = random.Random(5)
    watermarks = [19 * 60_000 + 59_999, 20 * 60_000 + 1, 60 * 60_000]
    land(spark, tmp_path, [candle(0, rng, "A", 1), candle(0, rng, "A", 2)])
    for ms in watermarks:
        land(spark, tmp_path, [candle(ms, rng, "B", ms, 0.001)])
    stream = stream_minute_features(source(spark, tmp_path), ["symbol"], ["event_id"], "20 minutes")
    finished(stream, tmp_path)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got, "symbol", "event_id") == [("A", 1), ("A", 2), *[("B", ms) for ms in watermarks[:2]]]
