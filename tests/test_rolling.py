import math
import random

import pytest
from pyspark.sql import functions as F

from candlemill.operators.ordered import CHUNK, POSITION, over_rows
from candlemill.operators.rolling import Rolling, add_rolling


def brute(values, rows, enough, kind):
    out = []
    for i in range(len(values)):
        known = [x for x in values[max(0, i - rows + 1) : i + 1] if x is not None]
        mean = math.fsum(known) / len(known) if known else None
        if len(known) < enough or not known or (kind == "std" and len(known) < 2):
            out.append(None)
        elif kind == "mean":
            out.append(mean)
        else:
            out.append(math.sqrt(math.fsum((x - mean) ** 2 for x in known) / (len(known) - 1)))
    return out


def series(n, seed):
    rng = random.Random(seed)
    return [rng.choice([None, 1e9]) if rng.random() < 0.05 else rng.gauss(100, 1) for _ in range(n)]


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 50, 400])
@pytest.mark.parametrize("enough", [None, 2])
def test_blocks_equal_brute_force(frame, rows, enough):
    data = {"a": series(300, rows), "b": series(5, 9), None: series(rows + 1, 3)}
    table, start = [], 1_000_003
    for key, values in data.items():  # positions start anywhere
        table += [(key, start + i, x, 2 * i) for i, x in enumerate(values)]
        start += len(values)
    specs = [Rolling(f"{k}_{c}", k, c, rows, enough) for c in ("x", "y") for k in ("mean", "std")]
    df = frame(table, "key string, at long, x double, y int")
    out = add_rolling(df, ["key"], "at", specs, blocks_from=0).orderBy("at").collect()
    for key, values in data.items():
        got = [r for r in out if r["key"] == key]
        for c, given in (("x", values), ("y", [2.0 * i for i in range(len(values))])):
            for kind in ("mean", "std"):
                wanted = brute(given, rows, rows if enough is None else enough, kind)
                found = [r[f"{kind}_{c}"] for r in got]
                assert [x is None for x in found] == [x is None for x in wanted]
                known = [(x, y) for x, y in zip(found, wanted) if y is not None]
                assert [x for x, _ in known] == pytest.approx([y for _, y in known], rel=1e-9, abs=1e-6)


def test_blocks_in_chunks_equal_sliding_frames(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 3).alias("key"), "id", (F.sin("id") * 10 + F.col("id") % 7).alias("x")
    )
    rows = rows.withColumn("x", F.when(F.col("id") % 11 > 0, F.col("x")))

    def build(blocks_from):
        specs = [Rolling("m", "mean", "x", 168, 2), Rolling("s", "std", "x", 30, 20), Rolling("t", "std", "x", 168, 150)]
        return lambda df, w: add_rolling(df, [CHUNK, "key"], POSITION, specs, blocks_from)

    got, wanted = (
        over_rows(rows, ["key"], ["id"], 167, build(n), 700, unique=True).orderBy("id").toPandas()
        for n in (0, 1_000)
    )
    assert list(got.columns) == ["key", "id", "x", "m", "s", "t"]
    for c in ("m", "s", "t"):
        assert got[c].isna().equals(wanted[c].isna()) and got[c].notna().sum() > 100
        assert got[c].to_numpy() == pytest.approx(wanted[c].to_numpy(), rel=1e-9, nan_ok=True)


def test_blocks_have_no_sliding_frame(frame):
    df = frame([("a", 1, 1.0)], "key string, at long, x double")
    out = add_rolling(df, ["key"], "at", [Rolling("m", "std", "x", 500)])
    plan = out._jdf.queryExecution().toString()
    assert "specifiedwindowframe(RowFrame, -499, currentrow$())" not in plan
    slid = add_rolling(df, ["key"], "at", [Rolling("m", "std", "x", 12)])
    assert "specifiedwindowframe(RowFrame, -11, currentrow$())" in slid._jdf.queryExecution().toString()
