"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal size. With weight w out of W, block j
of a source is released at ``floor(j W / w)`` and due at ``ceil((j + 1) W / w)``;
each slot takes the released block that is due first. As the weights add up to
W, no deadline is missed, so at any slot each source is less than one block
away from its target. The schedule repeats every W slots, so one period places
the blocks of a source of any size.

Sources of weight 1, of which there may be very many, have one block a period,
due at its end. So they only fill, in order, the slots that the few others
leave: the driver makes runs of such slots from the others alone, and the
places of the sources in the runs are found by Spark.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm.common import unclashing
from candlemill.operators.ordered import with_row_index
from candlemill.session import small_table, stage

BLOCK_SIZE = 20_000
# What given weights above 1 may add up to; finer shares are an error.
MAX_TURNS = 1_000_000
# Slots of a run that one row stands for at most.
RUN_SLOTS = 65_536
# Shares of a source are rounded to this before each gets one part more.
RESOLUTION = 1_000
# Rows of one source that a task sorts together, about.
BUCKET_ROWS = 4_000


def period(
    heavy: Sequence[tuple[int, int]], n_sources: int
) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """One period of ``n_sources`` sources, of which ``heavy`` have weights above 1.

    ``heavy`` has the place of each among all sources, rising, and its weight.
    Returns the heavy blocks as (place, block, release, deadline, slot) and runs
    of the others as (first place, first slot, length), one block each. Earliest
    deadline first; ties go to the source that comes first. Work and results
    grow with the heavy weights, not with the number of sources.
    """
    n_light = n_sources - len(heavy)
    whole = sum(w for _, w in heavy) + n_light
    # So many light sources come before each heavy one.
    light_before = [place - i for i, (place, _) in enumerate(heavy)]

    def subtask(i: int, block: int) -> tuple[int, int, int, int]:
        w = heavy[i][1]
        return block * whole // w, -(-(block + 1) * whole // w), i, block

    waiting = [subtask(i, 0) for i in range(len(heavy))]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    blocks, runs = [], []
    slot = light = 0
    while slot < whole:
        while waiting and waiting[0][0] <= slot:
            release, deadline, i, block = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, i, block, release))
        length = n_light - light
        if ready:  # light blocks are due at the end, so only ties there go by place
            due_last = ready[0][0] == whole
            length = min(length, max(light_before[ready[0][1]] - light, 0) if due_last else 0)
        if length:
            # Up to the next place that is a heavy source, which the run skips.
            skipped = bisect_right(light_before, light)
            ends = [length, RUN_SLOTS]
            ends += [light_before[skipped] - light] if skipped < len(heavy) else []
            ends += [waiting[0][0] - slot] if waiting else []
            length = min(ends)
            runs.append((light + skipped, slot, length))
            light += length
            slot += length
            continue
        deadline, i, block, release = heapq.heappop(ready)
        blocks.append((heavy[i][0], block, release, deadline, slot))
        slot += 1
        if block + 1 < heavy[i][1]:
            heapq.heappush(waiting, subtask(i, block + 1))
    return blocks, runs


def schedule(weights: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """One period as (source, block of the period, release, deadline), by slot."""
    blocks, runs = period([(i, w) for i, w in enumerate(weights) if w > 1], len(weights))
    slots = {slot: rest for *rest, slot in blocks}
    for place, first, length in runs:
        slots |= {first + i: [place + i, 0, 0, sum(weights)] for i in range(length)}
    return [tuple(slots[slot]) for slot in sorted(slots)]


def tempered_weight(size: Column, whole: float, power: float = 0.5) -> Column:
    """A whole weight that goes with a power of a source's size; none is 0."""
    part = F.pow(F.greatest(size, F.lit(0)).cast("double"), F.lit(power))
    share = F.round(RESOLUTION * part / F.lit(whole or 1.0), 6)
    return (1 + F.floor(share)).cast("long")


def _tag(source: str) -> Column:
    """A source's name that is never null: nulls are a source of their own, first in order."""
    column = F.col(source).cast("string")
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column))


def mix(
    df: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights: Mapping[str | None, int] | None = None,
    block_size: int = BLOCK_SIZE,
) -> DataFrame:
    """All rows and columns of ``df`` with weight, start, block, release, deadline and slot.

    Inside a source, rows go by the MD5 of their key, then by key, then by
    size; ``start`` is the size of the rows before, and a row is in the block
    where it starts. Ordering the result by slot and start gives the mix. No
    row is dropped or repeated: when a source ends, its slots stay empty and
    the others go on in their proportions.

    ``weights`` are whole numbers by source (a source without one, or with 0,
    gets 1); without them they go with the square root of the source's size.
    There may be any number of sources; those of weights above 1 pass the
    driver, and such weights may add up to ``MAX_TURNS``, else it raises.
    Null sources are one source; null and negative sizes count as 0; rows with
    null keys come first. Rows that agree in key and size are interchangeable.
    New columns that ``df`` has already get underscores in front. Runs jobs and
    reads ``df`` more than once.
    """
    spark = df.sparkSession
    # Inside, columns of ``df`` go by their place, so that no name can clash.
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
    placed = df.select(
        *own,
        F.col(f"`{key}`").alias("key"),
        _tag(source).alias("tag"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")).alias("place"),
    )
    sources = stage(
        placed.groupBy("tag").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")),
        "sources",
    )
    if weights is None:
        whole = sources.agg(F.sum(F.sqrt(F.col("size").cast("double"))).alias("w")).first()["w"]
        weighed = sources.withColumn("weight", tempered_weight(F.col("size"), whole))
    else:
        given = [("0" if s is None else "1" + s, max(int(w), 1)) for s, w in weights.items()]
        table = small_table(
            spark,
            tag=(pa.string(), [t for t, _ in given]),
            weight=(pa.int64(), [w for _, w in given]),
        )
        weighed = sources.join(table, "tag", "left")
        weighed = weighed.withColumn("weight", F.coalesce("weight", F.lit(1)))
    weighed = stage(
        with_row_index(weighed.select("tag", "n", "weight"), [], ["tag"], "at", unique=True),
        "weighed",
    )
    sums = weighed.agg(
        F.count(F.lit(1)).alias("sources"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("weight") > 1, F.col("weight"))), F.lit(0)).alias("turns"),
    ).first()
    if sums["turns"] > MAX_TURNS:
        raise ValueError(f"weights above 1 add up to more than {MAX_TURNS}")
    # At most half as many rows as there are turns.
    heavy = [(r["at"], r["weight"]) for r in weighed.where("weight > 1").orderBy("at").collect()]
    blocks, runs = period(heavy, sums["sources"])
    length = sums["turns"] + sums["sources"] - len(heavy)
    of_heavy = small_table(
        spark,
        **{
            name: (pa.int64(), [b[i] for b in blocks])
            for i, name in enumerate(("at", "turn", "first_release", "first_deadline", "first_slot"))
        },
    )
    columns = {n: (pa.int64(), [r[i] for r in runs]) for i, n in enumerate(("at", "slot", "length"))}
    of_light = (
        small_table(spark, **columns)
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)))
        .select(
            (F.col("at") + F.col("i")).alias("at"),
            F.lit(0).cast("long").alias("turn"),
            F.lit(0).cast("long").alias("first_release"),
            F.lit(length).cast("long").alias("first_deadline"),
            (F.col("slot") + F.col("i")).alias("first_slot"),
        )
    )
    table = stage(
        of_heavy.union(of_light).join(weighed.select("at", "tag"), "at").drop("at"), "turns"
    )
    # A source is cut into stretches of the MD5 order, which are summed first,
    # so that no task needs more of a source than one stretch.
    n_stretches = max(1, -(-sums["rows"] // BUCKET_ROWS))
    head = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    dealt = placed.withColumn("stretch", F.floor(head * n_stretches / 2**32).cast("long"))
    before = Window.partitionBy("tag").orderBy("stretch")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        dealt.groupBy("tag", "stretch").agg(F.sum("size").alias("sum"))
        .withColumn("offset", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
        .join(weighed.select("tag", "weight"), "tag"),
        "offsets",
    )
    inside = Window.partitionBy("tag", "stretch").orderBy(
        "place", F.col("key").asc_nulls_first(), "size"
    )
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    started = (
        dealt.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["tag", "stretch"])
        .withColumn("start", F.col("offset") + F.col("inner"))
        .withColumn("block", F.expr(f"start div {int(block_size)}"))
    )
    joined = (
        started.withColumn("turn", F.col("block") % F.col("weight"))
        .withColumn("shift", F.expr(f"(block div weight) * {length}L"))
        .join(table, ["tag", "turn"])
    )
    new = {n: F.col(n) for n in ("weight", "start", "block")}
    new |= {n: F.col(f"first_{n}") + F.col("shift") for n in ("release", "deadline", "slot")}
    return joined.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)],
        *[column.alias(unclashing(df.columns, n)) for n, column in new.items()],
    )
