"""Whole stages end to end, and the shape of physical plans."""

import os
import re
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import CANDLE_DDL, candle, epoch_ms
from pyspark.sql import functions as F

from candlemill import schema
from candlemill.operators import clean, features, resample
from candlemill.plans import analysis, copy_layer, layers

DATA = "/root/testdata/sf0.001"


def csv_line(ts, price, micro):
    t = epoch_ms(ts)
    times = (t * 1000, t * 1000 + 59_999_999) if micro else (t, t + 59_999)
    return f"{times[0]},{price},{price + 2},{price - 2},{price + 1},3,{times[1]},30,4,1,10,0"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Nine days of two symbols through all layers."""
    root = tmp_path_factory.mktemp("run")
    (root / "csv").mkdir()
    start = datetime(2024, 12, 28)
    for symbol in ("ABC", "XYZ"):
        parts = {}
        for i in range(9 * 1_440):
            ts = start + timedelta(minutes=i)
            if symbol == "XYZ" and i == 700:
                continue
            name = f"{symbol}-1m-{ts:%Y-%m}.csv"
            parts.setdefault(name, []).append(csv_line(ts, 100 + i % 50, ts.year == 2025))
        for name, lines in parts.items():
            (root / "csv" / name).write_text("\n".join(lines + lines[:3]))
    paths = {n: str(root / n) for n in ("csv", "bronze", "silver", "gold", "model", "quarters")}
    audits = {
        "bronze": layers.build_bronze(spark, paths["csv"], paths["bronze"]),
        "silver": layers.build_silver(spark, paths["bronze"], paths["silver"]),
        "gold": layers.build_gold(spark, paths["silver"], paths["gold"]),
        "model": layers.build_model_input(spark, paths["gold"], paths["model"]),
    }
    audits["quarters"], audits["dropped"] = layers.build_quarters(
        spark, paths["model"], paths["quarters"])
    return spark, paths, audits


def test_bronze(run):
    spark, paths, audits = run
    rows = {r.source_file: r.rows for r in audits["bronze"].collect()}
    assert rows[None] == 2 * 9 * 1_440 - 1 + 12 and len(rows) == 5
    assert spark.read.parquet(paths["bronze"]).columns == [
        "symbol", *schema.RAW_COLUMNS, *schema.LINEAGE_COLUMNS]
    assert not layers.bronze_volume(spark, paths["bronze"]).first().large_enough


def test_silver(run):
    _, _, audits = run
    got = {r.symbol: r for r in audits["silver"].collect()}
    assert (got["ABC"].dropped_duplicate, got["ABC"].gaps) == (6, 0)
    assert (got["XYZ"].rows_out, got["XYZ"].gaps, got["XYZ"].largest_gap_seconds) == (
        9 * 1_440 - 1, 1, 120)


def test_gold(run):
    spark, paths, audits = run
    audit = audits["gold"].first()
    assert (audit.bars_total, audit.bars_incomplete, audit.rows_out) == (432, 1, 431)
    assert audit.rows_post_covid == 431
    assert len(spark.read.parquet(paths["gold"]).columns) == 26


def test_model_and_quarters(run):
    spark, paths, audits = run
    model = spark.read.parquet(paths["model"])
    assert model.columns == ["symbol", *schema.MODEL_COLUMNS]
    assert {r.year_quarter for r in audits["model"].collect()} == {"2024-Q4", "2025-Q1"}
    kept = {r.year_quarter: r for r in audits["quarters"].collect()}
    assert audits["dropped"] == 2 * 167
    assert sum(r.rows for r in kept.values()) == 431 - 2 * 167
    assert kept["2025-Q1"].path.endswith("quarters/year_quarter=2025-Q1")


def test_analysis(run, tmp_path):
    spark, paths, _ = run
    read = spark.read.parquet
    results = analysis.result_tables(read(paths["silver"]), read(paths["gold"]))
    assert results["dataset_state"].count() == 2
    assert results["correlation"].count() == 9
    assert results["box_close"].count() == 3
    noise = analysis.noise_tables(read(paths["bronze"]), read(paths["silver"]))
    assert noise["metrics"].count() == 2 and noise["outliers"].count() == 8
    assert noise["describe_silver_1m"].count() == 9
    analysis.write_tables(
        {k: results[k] for k in ("regimes", "top_highest")}, str(tmp_path / "tables"))
    assert spark.read.option("header", True).csv(str(tmp_path / "tables/regimes")).count() == 1


def test_copy_command(run, tmp_path):
    _, paths, _ = run
    counts = copy_layer.main(["--source-path", paths["gold"], "--target-path", str(tmp_path / "c")])
    assert counts == {"rows_written": 431, "rows_read": 431}


def test_copy_command_starts_anywhere(tmp_path):
    script = Path(copy_layer.__file__).resolve()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script), "--help"], cwd=tmp_path, env=env, capture_output=True)
    assert done.returncode == 0 and b"--source-path" in done.stdout


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def candles(frame):
    return clean.with_timestamps(frame([candle(i) for i in range(300)], CANDLE_DDL))


def test_windows_never_meet_in_one_partition(candles):
    plans = [
        plan_of(features.minute_features(candles, ["symbol"], ["source_file"])),
        plan_of(features.bar_features(resample.bars(candles))),
        plan_of(clean.cleaning_audit(candles, ["symbol"], ["source_file"])),
    ]
    for plan in plans:
        assert "Window" in plan and "SinglePartition" not in plan
    # Feature windows are cut into chunks besides the series key.
    for plan in plans[:2]:
        assert re.search(r"hashpartitioning\(_chunk#\d+L, symbol", plan)


def test_copies_are_cut_before_the_shuffle(candles):
    plan = plan_of(clean.keep_first(candles, ["symbol"], ["source_file"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_bars_combine_before_the_shuffle(candles):
    plan = plan_of(resample.bars(candles))
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def test_scan_reads_only_what_is_used(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    ticks = events.select("event_type", "ts", "value", "props").filter(F.col("value") > 3)
    named = ticks.withColumnsRenamed({"event_type": "symbol", "ts": "open_ts"})
    bars = resample.bars(resample.ticks(named, "value"))
    plan = plan_of(bars.select("symbol", "open_ts", "close"))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>", plan)
    assert "GreaterThan(value,3.0)" in plan


def test_null_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").withColumnsRenamed(
        {"o_orderkey": "open_time", "o_custkey": "close_time", "o_totalprice": "close"})
    for c in ("open", "high", "low"):
        orders = orders.withColumn(c, F.col("close"))
    plan = plan_of(clean.bronze_rows(orders.select(*schema.BRONZE_ESSENTIAL)))
    pushed = plan[plan.index("PushedFilters"):]
    assert "IsNotNull(o_totalprice)" in pushed and "IsNotNull(o_custkey)" in pushed


def test_bars_with_ties_use_a_hash_aggregate(spark):
    from workload.tables import order_days

    plan = plan_of(order_days(spark, DATA))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_layers_read_their_stored_step(run):
    _, _, audits = run
    # Audits start from stored tables: no candle is chosen or parsed again.
    for name, dear in (("silver", "row_number"), ("gold", "partial_min_by")):
        assert dear not in plan_of(audits[name])
