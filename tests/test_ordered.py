import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlemill.functions.candle import rolling
from candlemill.operators import ordered


@pytest.fixture(scope="module")
def series(spark):
    """Three series, one of them with most of the rows, and one NULL key."""
    rng = random.Random(7)
    rows = []
    for i in range(3_000):
        key = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        value = None if rng.random() < 0.05 else rng.gauss(0, 1)
        rows.append((key, rng.randrange(500), i, value))
    return spark.createDataFrame(rows, "k string, t int, id int, x double").cache()


def test_row_index_equals_row_number(series):
    got = ordered.with_row_index(series, ["k"], ["t", "id"])
    w = Window.partitionBy("k").orderBy("t", "id")
    wrong = got.withColumn("rn", F.row_number().over(w) - 1).filter("rn <> row_index")
    assert got.count() == 3_000
    assert wrong.count() == 0


def test_row_index_of_one_series(series):
    got = ordered.with_row_index(series, [], ["t", "id"], "i")
    rows = got.orderBy("t", "id").select("i").collect()
    assert [r.i for r in rows] == list(range(3_000))


def test_lanes_split_a_hot_series(series):
    lanes = ordered.sort_into_lanes(series.repartition(4), ["k"], ["t", "id"])
    assert lanes.n_rows == 3_000
    ids = [r[0] for r in lanes.rows.select("_position").collect()]
    assert sorted(ids) == list(range(3_000))


@pytest.mark.parametrize("k, chunk", [(2, 1), (24, 23), (24, 100), (60, 200), (200, 200)])
def test_chunked_windows_equal_whole_windows(series, k, chunk):
    def build(rows, w):
        return rows.withColumns(
            {
                "mean": rolling(F.avg, F.col("x"), w, k),
                "std": rolling(F.stddev_samp, F.col("x"), w, k, 2),
                "before": F.lag("x").over(w),
            }
        )

    got = ordered.over_rows(series, ["k"], ["t", "id"], k - 1, build, chunk_rows=chunk)
    want = build(series, Window.partitionBy("k").orderBy("t", "id"))
    columns = ["id", "mean", "std", "before"]
    a = {r.id: r for r in got.select(columns).collect()}
    b = {r.id: r for r in want.select(columns).collect()}
    assert len(a) == 3_000 and a.keys() == b.keys()
    for key, row in b.items():
        for got_value, value in zip(a[key], row):
            same = value if value is None else pytest.approx(value, rel=1e-12, abs=1e-12)
            assert got_value == same


def test_chunks_must_cover_the_lookback(series):
    with pytest.raises(ValueError):
        ordered.over_rows(series, ["k"], ["t", "id"], 10, lambda r, w: r, chunk_rows=5)


def test_default_chunks_are_bounded():
    assert ordered._chunk_rows(100, 8, 23) == 8_192
    assert ordered._chunk_rows(10**13, 1_000, 23) == 65_536
    assert ordered._chunk_rows(10, 1, 100_000) == 400_000


def test_every_nth_keeps_the_first(series):
    got = ordered.every_nth(series, ["k"], ["t", "id"], 50)
    sizes = {r.k: r["count"] for r in series.groupBy("k").count().collect()}
    taken = {r.k: r["count"] for r in got.groupBy("k").count().collect()}
    assert taken == {k: int(np.ceil(n / 50)) for k, n in sizes.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int, x double")
    assert ordered.with_row_index(df, ["k"], ["t"]).collect() == []
    out = ordered.over_rows(df, ["k"], ["t"], 1, lambda r, w: r.withColumn("p", F.lag("x").over(w)))
    assert out.columns == ["k", "t", "x", "p"] and out.collect() == []


def test_identical_rows_spread_over_lanes(spark):
    same = spark.range(200_000, numPartitions=8).selectExpr("'k' AS k", "1 AS t", "2.0 AS x")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lanes = ordered.sort_into_lanes(same, ["k"], ["t"])
        sizes = [r["count"] for r in lanes.rows.groupBy("_lane").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == lanes.n_rows == 200_000
    assert len(sizes) == 4 and max(sizes) < 100_000


def test_ties_are_taken_by_content_whatever_the_layout(spark):
    rows = spark.range(500).selectExpr("'k' AS k", "id % 5 AS t", "id % 50 AS x")

    def before(df):
        got = ordered.over_rows(
            df, ["k"], ["t"], 1, lambda r, w: r.withColumn("p", F.lag("x").over(w)))
        return sorted(tuple(r) for r in got.fillna(-1).collect())

    assert before(rows.repartition(7, "x")) == before(rows.coalesce(1))
