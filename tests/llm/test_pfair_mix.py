import random
from fractions import Fraction

import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

from candlemill.llm import pfair_mix as P


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [97, 2, 1], [7, 7, 7, 1, 30]])
def test_schedule_keeps_deadlines_and_targets(weights):
    slots = P.schedule(weights)
    period = sum(weights)
    assert len(slots) == period
    had = [0] * len(weights)
    for slot, (source, block, release, deadline) in enumerate(slots):
        assert block == had[source] and release <= slot < deadline
        had[source] += 1
        for w, n in zip(weights, had):
            assert abs(n - Fraction(w * (slot + 1), period)) < 1
    assert had == weights


def test_mix_places_every_row(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_ROWS", 20)
    rng = random.Random(4)
    texts = ["x" * rng.randint(0, 300) for _ in range(200)] + odd_texts()
    df = documents(spark, texts)
    mixed = P.mix(df, F.length("text"), block_size=500)
    rows = mixed.collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    assert mixed.columns == [*df.columns, "weight", "start", "block", "release", "deadline", "slot"]
    by_source = {}
    for r in rows:
        assert r["block"] == r["start"] // 500 and r["release"] <= r["slot"] < r["deadline"]
        by_source.setdefault(r["source"], []).append(r)
    assert set(by_source) == {None, "s0", "s1", "s2"}
    for own in by_source.values():
        own.sort(key=lambda r: r["start"])
        at = 0
        starts = [r["start"] for r in own]
        for start in sorted(set(starts)):
            assert start == at
            at += sum(len(r["text"] or "") for r in own if r["start"] == start)
    # No two sources share a slot.
    owner = {}
    for r in rows:
        assert owner.setdefault(r["slot"], r["source"]) == r["source"]


def test_given_weights_decide_the_shares(spark):
    rows = [(i, "a" if i % 2 else "b", 10) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot long")
    df = df.withColumns({n: F.lit(0) for n in ("tag", "size", "offset", "c0", "key")})
    mixed = P.mix(df, F.col("slot"), weights={"a": 3, "b": 1}, block_size=10)
    assert mixed.columns[-1] == "_slot"
    first = mixed.orderBy("_slot").limit(100).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in first} == {"a": 75, "b": 25}


def test_repeated_and_null_keys_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a", 3), (1, "a", 3), (1, "a", 3)], "doc_id long, source string, n long")
    assert sorted(r["start"] for r in P.mix(df, F.col("n")).collect()) == [0, 3, 6]
    assert P.mix(df.limit(0), F.col("n")).count() == 0


def plain_schedule(weights):
    """Earliest deadline first, slot by slot over all sources."""
    whole, done, slots = sum(weights), [0] * len(weights), []
    for slot in range(whole):
        ready = [
            (-(-(done[i] + 1) * whole // w), i)
            for i, w in enumerate(weights)
            if done[i] < w and done[i] * whole // w <= slot
        ]
        deadline, i = min(ready)
        slots.append((i, done[i], done[i] * whole // weights[i], deadline))
        done[i] += 1
    return slots


@pytest.mark.parametrize("run_slots", [2, 65_536])
def test_runs_of_light_sources_equal_plain_schedules(monkeypatch, run_slots):
    monkeypatch.setattr(P, "RUN_SLOTS", run_slots)
    rng = random.Random(run_slots)
    for _ in range(200):
        weights = [rng.choice([1, 1, 1, 2, 3, rng.randint(1, 40)]) for _ in range(rng.randint(1, 25))]
        assert P.schedule(weights) == plain_schedule(weights)


def test_very_many_sources(spark):
    n = 50_000
    rows = spark.range(n + 30_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < n, F.concat(F.lit("host"), "id")).otherwise("large").alias("source"),
        F.lit(10).alias("n"),
    )
    mixed = P.mix(rows, F.col("n"), block_size=10)
    slots = [r["slot"] for r in mixed.select("slot").collect()]
    assert len(set(slots)) == len(slots) == n + 30_000
    large = {r["weight"] for r in mixed.where("source = 'large'").select("weight").distinct().collect()}
    assert large == {1 + int(1000 * 300_000**0.5 / (300_000**0.5 + n * 10**0.5))}
    assert mixed.where("slot < release OR slot >= deadline").isEmpty()


def test_given_weights_may_not_be_too_fine(spark):
    df = documents(spark, ["a"] * 9)
    with pytest.raises(ValueError):
        P.mix(df, F.length("text"), weights={"s0": P.MAX_TURNS + 1})
