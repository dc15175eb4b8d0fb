"""Exact quantiles at any size.

Rules: ``nearest`` takes the value at rank ``floor((n - 1) * p + 0.5)``;
``linear`` interpolates between the two ranks around ``(n - 1) * p`` (the
median at 0.5). Nulls and NaN are left out.

A wanted rank is narrowed digit by digit. A digit is a number that never falls
as the value grows, so counting values by digit in one hash aggregate tells in
which digit a rank lies, for all columns, ranks and groups at once. The first
digit is the sign and an eighth of an octave; each further one cuts what the
rank's values still span, from the least to the greatest found, into equal
steps. A digit whose least and greatest value agree is the answer, so many rows
that share a value end the search. An eighth of an octave has 2^49 doubles and
a digit 2^14 steps: four further digits at most, mostly two. No values are
sorted, and only counts move.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.operators.ordered import join_null_safe
from candlemill.session import small_table, stage

Prob = tuple[float, str]

# Steps of a digit after the first one.
DIGIT_STEPS = 1 << 14
# The first digit: steps per octave, and what makes it positive.
_PER_OCTAVE = 8
_OFFSET = 1 << 14


def rank_weights(n: int, prob: float, rule: str) -> list[tuple[int, float]]:
    """Ranks (from 0) and weights that make up a quantile of ``n`` values."""
    place = (n - 1) * prob
    if rule == "nearest":
        return [(math.floor(place + 0.5), 1.0)]
    if rule != "linear":
        raise ValueError(f"unknown quantile rule: {rule}")
    low = math.floor(place)
    part = place - low
    return [(low, 1.0 - part)] + ([(low + 1, part)] if part > 0 else [])


def first_digit(x: Column) -> Column:
    """Sign and eighth of an octave of a double: between -2^15 and 2^15."""
    size = F.abs(x)
    scaled = F.floor(F.log2(size) * _PER_OCTAVE) + _OFFSET
    digit = F.when(size == float("inf"), F.lit(2 * _OFFSET)).when(size > 0, scaled).otherwise(0)
    return F.when(x < 0, -digit).otherwise(digit).cast("int")


def next_digit(x: Column, low: Column, high: Column, steps: int) -> Column:
    """Step of ``x`` between ``low`` and ``high``, which differ but little after the first digit."""
    return F.floor((x - low) / (high - low) * steps).cast("int")


def _counted(rows: DataFrame, *by: Column | str) -> DataFrame:
    """How many values each digit has, the least and the greatest."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("size"), F.min("x").alias("low"), F.max("x").alias("high")
    )


@dataclass
class _Search:
    """Where the value of one rank of one column still may be: ``rank`` counts from ``low``."""

    column: str
    rank: int
    low: float = -math.inf
    high: float = math.inf

    @property
    def found(self) -> bool:
        return self.low == self.high


def _long(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by``, variable and x: one row per known value of each column."""
    long = rows.unpivot([F.col(b) for b in by], list(columns), "variable", "x")
    return long.where(F.col("x").isNotNull() & ~F.isnan("x"))


def _first_counts(known: DataFrame) -> dict[str, list[tuple[int, int, float, float]]]:
    """Counts by first digit, in order, of each column: at most 2^15 of them have values."""
    out: dict[str, list] = {}
    for row in _counted(known, "variable", first_digit(F.col("x")).alias("digit")).collect():
        found = out.setdefault(row["variable"], [])
        found.append((row["digit"], row["size"], row["low"], row["high"]))
    return {c: sorted(counts) for c, counts in out.items()}


def _narrow(known: DataFrame, searches: Sequence[_Search], steps: int) -> None:
    """One more digit of each search; those that look at the same values share the count."""
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault((s.column, s.low, s.high), []).append(s)
    names, lows, highs = zip(*groups)
    # One row per span that still is open: a few per column.
    spans = small_table(
        known.sparkSession,
        span=(pa.int32(), range(len(groups))),
        name=(pa.string(), names),
        _low=(pa.float64(), lows),
        _high=(pa.float64(), highs),
    )
    inside = F.col("x").between(F.col("_low"), F.col("_high"))
    held = known.join(F.broadcast(spans), (F.col("variable") == F.col("name")) & inside)
    digit = next_digit(F.col("x"), F.col("_low"), F.col("_high"), steps).alias("digit")
    counts = _counted(held, "span", digit)
    # A window over the digits of a span: bounded by the steps.
    upto = F.sum("size").over(Window.partitionBy("span").orderBy("digit"))
    before = F.col("upto") - F.col("size")
    members = list(groups.values())
    ranks = F.array(*[F.array(*[F.lit(s.rank) for s in g]) for g in members])[F.col("span")]
    hit = F.exists(ranks, lambda r: (r >= before) & (r < F.col("upto")))
    found = counts.withColumn("upto", upto).where(hit).collect()
    moved = [
        (s, row)
        for row in found
        for s in members[row["span"]]
        if row["upto"] - row["size"] <= s.rank < row["upto"]
    ]
    for s, row in moved:
        s.rank -= row["upto"] - row["size"]
        s.low, s.high = row["low"], row["high"]


def quantile_scalars(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[Prob],
    steps: int = DIGIT_STEPS,
) -> dict[tuple[str, float, str], float | None]:
    """Whole-table quantiles by (column, probability, rule); None without values.

    Reads the table once for the first digit and once for each further one, so
    expensive input should be staged. The driver gets the counts of the first
    digit, at most 2^15 a column, and one row per wanted rank after that.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)])
    known = _long(rows, [], rows.columns)
    counts = _first_counts(known)
    total = {c: sum(size for _, size, _, _ in counts.get(c, ())) for c in columns}
    plan: dict[tuple[str, float, str], list[tuple[int, float]]] = {
        (c, p, rule): rank_weights(total[c], p, rule) if total[c] else []
        for c in columns
        for p, rule in probs
    }
    searches: dict[tuple[str, int], _Search] = {}
    for (c, _, _), parts in plan.items():
        for wanted, _ in parts:
            rank = wanted
            for _, size, low, high in counts[c]:
                if rank < size:
                    searches[c, wanted] = _Search(c, rank, low, high)
                    break
                rank -= size
    while open_ := [s for s in searches.values() if not s.found]:
        _narrow(known, open_, steps)
    return {
        (c, p, rule): sum(searches[c, rank].low * w for rank, w in parts) if parts else None
        for (c, p, rule), parts in plan.items()
    }


def _wanted_ranks(probs: Sequence[Prob]) -> Column:
    """Array of (prob, rule, rank, weight), given the count in column ``n``."""
    entries = []
    for prob, rule in probs:
        place = (F.col("n") - 1) * F.lit(float(prob))
        low = F.floor(place)
        part = place - low
        if rule == "nearest":
            parts = [(F.floor(place + 0.5), F.lit(1.0))]
        elif rule == "linear":
            parts = [(low, 1.0 - part), (low + 1, part)]
        else:
            raise ValueError(f"unknown quantile rule: {rule}")
        for rank, weight in parts:
            entries.append(
                F.struct(
                    F.lit(float(prob)).alias("prob"),
                    F.lit(rule).alias("rule"),
                    rank.cast("long").alias("rank"),
                    weight.alias("weight"),
                )
            )
    return F.filter(F.array(*entries), lambda e: e["weight"] > 0)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[Prob],
    by: Sequence[str],
    steps: int = DIGIT_STEPS,
) -> DataFrame:
    """Quantiles per group: one row per (by, variable, prob, rule), with the count.

    For any number of groups of any size: each digit is one hash aggregate over
    all groups, and windows see the digits of a group, at most 2^15. Reads
    ``df`` once for each digit, so expensive input should be staged.
    """
    group = [*by, "variable"]
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    known = _long(wide, by, columns)
    wanted = ["prob", "rule", "weight", "rank"]
    whole = Window.partitionBy(*group)
    upto = F.sum("size").over(whole.orderBy("digit"))
    first = _counted(known, *group, first_digit(F.col("x")).alias("digit")).withColumns(
        {"n": F.sum("size").over(whole), "_before": upto - F.col("size")}
    )
    held = (F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("size"))
    place = (F.col("rank") - F.col("_before")).alias("rank")
    spans = first.select(*group, "n", "size", "low", "high", "_before", F.inline(_wanted_ranks(probs)))
    found = stage(spans.where(held).select(*group, "n", *wanted[:3], place, "low", "high"), "ranks")
    while not (open_ := found.where("low < high")).isEmpty():
        span = [*group, "_low", "_high"]
        # Named apart from the least and greatest value of the next digit.
        open_ = open_.withColumnsRenamed({"low": "_low", "high": "_high"})
        near = join_null_safe(known, open_.select(*span).distinct(), group).where(
            F.col("x").between(F.col("_low"), F.col("_high"))
        )
        digit = next_digit(F.col("x"), F.col("_low"), F.col("_high"), steps).alias("digit")
        in_span = Window.partitionBy(*span).orderBy("digit")
        counts = _counted(near, *span, digit).withColumn(
            "_before", F.sum("size").over(in_span) - F.col("size")
        )
        closer = join_null_safe(counts, open_, span).where(held)
        closer = closer.select(*group, "n", *wanted[:3], place, "low", "high")
        found = stage(found.where("low = high").unionByName(closer), "ranks")
    return found.groupBy(*group, "prob", "rule").agg(
        F.sum(F.col("low") * F.col("weight")).alias("value"), F.max("n").alias("n")
    )
