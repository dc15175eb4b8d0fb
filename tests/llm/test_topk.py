import math
import random

import pytest
from pyspark.sql import functions as F

from candlemill.llm import topk as T

DDL = "vec_id long, vector array<long>, rank string"


def brute(rows, k, every):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v:
            usable[i] = min(usable.get(i, v), v)
    out = {}
    for q, a in usable.items():
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {q: best for q, best in out.items() if best}


def found(spark, rows, k, every, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], DDL)
    got = {}
    for r in T.top_k(df, F.col("vec_id") % every == 0, k=k, **options).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_equals_brute_force_with_ties_and_copies(spark, lists, monkeypatch):
    monkeypatch.setattr(T, "CELL_ROWS", 40)
    rng = random.Random(lists)
    rows = [(i, [rng.randint(-3, 3) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [1, 1, 1, 1, 1, 1]) for i in range(60)]  # a third are copies
    rows += [(300, [0] * 6), (301, None), (302, [1, None, 1, 1, 1, 1]), (None, [9] * 6)]
    rows += [(303, [1, 2]), (304, []), (305, [5] * 6), (305, [4] * 6), (306, [2**40] + [0] * 5)]
    rng.shuffle(rows)
    assert found(spark, rows, 7, 5, lists=lists) == brute(rows, 7, 5)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1, 2]), (1, [3, 4]), (2, [-1, 0])]
    assert found(spark, rows, 20, 2) == {0: [(1, 11), (2, -1)], 2: [(0, -1), (1, -3)]}
    assert found(spark, rows[:1], 20, 1) == {}
    assert found(spark, [], 20, 1) == {}


def test_whole_components(spark):
    given = [[0.5, -0.01], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0], None, []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v array<float>")
    got = {r["i"]: r["w"] for r in df.select("i", T.whole_components("v").alias("w")).collect()}
    assert got == {0: [32, math.floor(64 * -0.01)], 1: None, 2: None, 3: None, 4: None, 5: []}
