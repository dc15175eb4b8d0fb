import math
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlemill.operators import order_stats
from candlemill.operators.order_stats import quantile_scalars, quantiles, rank_weights

PROBS = [(p, rule) for p in (0.0, 0.25, 0.5, 0.75, 0.99, 0.999, 1.0)
         for rule in ("nearest", "linear")]


def brute(values, prob, rule):
    ordered = sorted(values)
    return sum(ordered[rank] * w for rank, w in rank_weights(len(ordered), prob, rule))


def test_rules_on_eight_values(frame):
    df = frame([(float(i),) for i in range(1, 9)], "x double")
    got = quantile_scalars(df, ["x"], [(0.25, "nearest"), (0.25, "linear"), (0.5, "linear")])
    assert got == {("x", 0.25, "nearest"): 3.0, ("x", 0.25, "linear"): 2.75,
                   ("x", 0.5, "linear"): 4.5}


@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=50), st.floats(0, 1))
def test_linear_rule_is_the_usual_one(values, prob):
    assert brute(values, prob, "linear") == pytest.approx(
        np.percentile(values, prob * 100), rel=1e-9, abs=1e-6)


def test_unknown_rule():
    with pytest.raises(ValueError):
        rank_weights(5, 0.5, "closest")


def columns_of(n, seed):
    """Smooth, tied, skewed and constant columns with gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((
            rng.gauss(0, 1),
            7.0 if rng.random() < 0.4 else float(rng.randrange(20)),
            rng.choice([None, float("nan"), rng.expovariate(1e-6), -1e-9]),
            3.5,
        ))
    return rows


@pytest.mark.parametrize("steps", [order_stats.DIGIT_STEPS, 40, 2])
def test_search_equals_brute_force(frame, steps):
    rows = columns_of(3_000, 11)
    df = frame(rows, "smooth double, tied double, skewed double, constant double")
    got = quantile_scalars(df, df.columns, PROBS, steps)
    for i, c in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        for p, rule in PROBS:
            assert got[c, p, rule] == pytest.approx(brute(values, p, rule), rel=1e-12), (c, p, rule)


EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, 1.0, 1.0000000000000002,
            0.9999999999999999, 2.0, -1.0, 1.7976931348623157e308, -1.7976931348623157e308,
            math.inf, -math.inf, 4.0, 3.9999999999999996, 1e17, 1e17 + 16]


def test_extreme_values_are_exact(frame):
    df = frame([(x,) for x in EXTREMES], "x double")
    n = len(EXTREMES) - 1
    probs = [(i / n, "nearest") for i in range(n + 1)]
    for steps in (2, order_stats.DIGIT_STEPS):
        got = quantile_scalars(df, ["x"], probs, steps)
        assert [got["x", p, "nearest"] for p, _ in probs] == sorted(EXTREMES)


def test_digits_never_fall(frame):
    rng = random.Random(8)
    values = EXTREMES + [math.ldexp(rng.uniform(1, 2), rng.randrange(-1074, 1023)) for _ in range(500)]
    values += [math.nextafter(2.0**k, s) for k in range(-1000, 1000, 37) for s in (0, math.inf)]
    df = frame([(x,) for x in sorted(values)], "x double")
    digits = [r[0] for r in df.orderBy("x").select(order_stats.first_digit(F.col("x"))).collect()]
    assert digits == sorted(digits) and max(map(abs, digits)) <= 1 << 15


def test_few_passes(frame, monkeypatch):
    rows = [(math.exp(i / 1e5), 100 + i / 1e6) for i in range(50_000)]
    df = frame(rows, "wide double, narrow double")
    passes = []
    narrow = order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    got = quantile_scalars(df, df.columns, [(0.25, "nearest"), (0.5, "nearest")])
    assert got["narrow", 0.25, "nearest"] == rows[12_500][1]
    assert len(passes) <= 2


def test_plan_has_hash_aggregates_only(frame):
    df = frame([("a", 1.0)], "g string, x double")
    counts = order_stats._counted(df, "g", order_stats.first_digit(F.col("x")).alias("digit"))
    plan = counts._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "percentile" not in plan


def test_no_values(frame):
    df = frame([(None,), (float("nan"),)], "x double")
    assert quantile_scalars(df, ["x"], [(0.5, "linear")]) == {("x", 0.5, "linear"): None}


@pytest.mark.parametrize("steps", [order_stats.DIGIT_STEPS, 3])
def test_groups_equal_brute_force(frame, steps):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), float(rng.randrange(40)),
             rng.gauss(0, 1)) for _ in range(2_000)]
    df = frame(rows, "g string, tied double, smooth double")
    out = quantiles(df, ["tied", "smooth"], PROBS, ["g"], steps).collect()
    assert len(out) == 3 * 2 * len(PROBS)
    for r in out:
        column = 1 if r.variable == "tied" else 2
        values = [row[column] for row in rows if row[0] == r.g]
        assert r.n == len(values)
        assert r.value == pytest.approx(brute(values, r.prob, r.rule), rel=1e-12)
