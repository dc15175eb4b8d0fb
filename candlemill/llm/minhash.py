"""Near-duplicate documents by one-permutation hashing.

A document is its set of word shingles. One hash function deals the shingles
into bins and keeps the least of each; an empty bin borrows from a bin that its
own random probes find first (optimal densification). Bands of bins are the
buckets in which similar documents meet.

Equal sets are one node from the start, so copies cost nothing further. In a
bucket only stars are compared. A centre is the member that shares most buckets
with others, which is what an original among its edited copies does. First each
document meets the best of its centres; links are confirmed on full sets. In
buckets whose members are then not all in one component, all centres are
compared. What is still apart there is settled exactly by rarest shingles: two
sets of the wanted likeness share one of their rarest few, and a bit map of each
set bounds what the two can have in common. So no candidate is given up, and no
bucket emits all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm.common import (
    map_lean,
    mix64,
    slices,
    span_hashes,
    text_buffer,
    word_hashes,
    word_spans,
)
from candlemill.llm.graph import components
from candlemill.session import stage

BANDS = 32
BAND_ROWS = 4
SHINGLE_WORDS = 5
PERCENT = 80
# 64-bit words of the bit map that bounds what two sets have in common.
MAP_WORDS = 16
# Sizes within this factor of each other are one band.
_BAND_FACTOR = 1.06


# ---------------------------------------------------------------- sets and sketches


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; A-Z count as a-z.

    A document of fewer words than ``width`` is one shingle, without words none.
    """
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    data = lower[data]
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    n = np.diff(first)
    counts = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    begin = at + np.arange(counts.sum())
    stop = begin + np.repeat(np.minimum(n, width), counts)
    hashes = span_hashes(words, begin, stop)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    return [np.unique(hashes[a:b]) for a, b in zip(cuts, cuts[1:])]


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Least hash per bin of each (non-empty) set; empty bins filled from others."""
    shift = np.uint64(64 - (bins - 1).bit_length())
    edges = np.arange(bins, dtype=np.uint64) << shift
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for row, values in enumerate(sets):
        at = np.searchsorted(values, edges)
        inside = at < len(values)
        found = values[np.where(inside, at, 0)]
        filled[row] = inside & (found >> shift == np.arange(bins, dtype=np.uint64))
        out[row] = found
    rows, cols = np.nonzero(~filled)
    probe = 0
    while len(rows):
        probe += 1
        salt = np.uint64(probe * 0x9E3779B1)
        donor = (mix64(cols.astype(np.uint64) * np.uint64(0x100000001) + salt) % np.uint64(bins))
        donor = donor.astype(np.int64)
        hit = filled[rows, donor]
        out[rows[hit], cols[hit]] = out[rows[hit], donor[hit]]
        rows, cols = rows[~hit], cols[~hit]
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One bucket key per band; the band's number is part of it."""
    rows = signature.reshape(len(signature), bands, -1)
    keys = mix64(np.arange(1, bands + 1, dtype=np.uint64))[None, :]
    for k in range(rows.shape[2]):
        keys = mix64(keys ^ rows[:, :, k]) + np.uint64(k)
    return keys


def _sketch_mapper(width: int, bands: int, rows: int):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(*text_buffer(part.column("text")), width)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((len(sets), bands), np.int64)
            if full:
                found = band_keys(signatures([sets[i] for i in full], bands * rows), bands)
                keys[full] = found.view(np.int64)
            sums = [
                np.array([mix64(s ^ np.uint64(seed)).sum() for s in sets], np.uint64).view(np.int64)
                for seed in (0x51ED27, 0xC2B2AE3D)
            ]
            flat = pa.array(keys.reshape(-1))
            ends = pa.array(np.arange(len(sets) + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                names=["id", "n", "h1", "h2", "bands"],
            )

    return mapper


def _set_mapper(width: int):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(*text_buffer(part.column("text")), width)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["id", "members"],
            )

    return mapper


def _member_mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per member of each set."""
    for part in slices(batches, "members"):
        values = [np.frombuffer(m.as_buffer(), np.int64) for m in part.column("members")]
        owner = np.repeat(np.arange(part.num_rows), [len(v) for v in values])
        yield pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(owner)), pa.array(np.concatenate(values))],
            names=["id", "shingle"],
        )


def _confirm_mapper(percent: int):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "left"):
            linked = []
            for x, y in zip(part.column("left"), part.column("right")):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(linked, pa.bool_())],
                names=["a", "b", "linked"],
            )

    return mapper


# ---------------------------------------------------------------- on Spark


def _fits(percent: int, a: str, b: str, common: Column | None = None) -> Column:
    """Whether sets of sizes ``a`` and ``b`` can be alike enough, given what they can share."""
    shared = F.least(a, b) if common is None else common
    return (100 + percent) * shared >= percent * (F.col(a) + F.col(b))


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("id", "c_id").alias("a"), F.greatest("id", "c_id").alias("b"))


def _with_centres(members: DataFrame, percent: int) -> DataFrame:
    """Members of buckets beside their bucket's centre, where the two can be alike."""
    centres = members.groupBy("key").agg(
        F.max(F.struct("degree", (-F.col("id")).alias("back"), "n", "component")).alias("c")
    )
    return (
        members.join(centres, "key")
        .select(
            "id", "n", "component", F.col("c.degree").alias("c_degree"),
            (-F.col("c.back")).alias("c_id"), F.col("c.n").alias("c_n"),
            F.col("c.component").alias("c_component"),
        )
        .where((F.col("component") != F.col("c_component")) & _fits(percent, "n", "c_n"))
    )


def _still_apart(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    apart = (
        members.groupBy("key")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x <> y")
        .select("key")
    )
    return members.join(apart, "key", "left_semi")


def _band(size: Column) -> Column:
    return F.floor(F.ln(size) / F.lit(math.log(_BAND_FACTOR))).cast("int")


def _rare_pairs(apart: DataFrame, sets: DataFrame, percent: int, kind: str) -> DataFrame:
    """All pairs of different components that can be alike, by their rarest shingles.

    Sets of size n with likeness t share a member among the ``n - ceil(t n) + 1``
    rarest of each, in any one order; members that only one set has are in no
    intersection. Of the sets that hold a shingle, those outside the largest
    component meet the others, so equal components meet nowhere.

    Two sets need to meet only at the first shingle they share. All before it
    is not shared, which bounds the size that the other set may have, so a set
    goes only to bands of fitting sizes: pages of one template whose own parts
    are too long meet at none of its shingles.
    """
    nodes = stage(apart.select("id", "n", "component").distinct(), "apart")
    rows = stage(
        map_lean(
            sets.join(nodes.select("id"), "id", "left_semi"),
            _member_mapper,
            f"id {kind}, shingle long",
        ),
        "shingles",
    )
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = rows.join(shared, "shingle").withColumn(
        "rank", F.row_number().over(Window.partitionBy("id").orderBy("df", "shingle"))
    ).withColumn("in_common", F.count(F.lit(1)).over(Window.partitionBy("id")))
    # Of members that other sets have too, one bit each at its hash: a bit that
    # the other set lacks is a member that it lacks.
    word = F.pmod(F.col("shingle"), F.lit(MAP_WORDS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(shingle div {MAP_WORDS}, 64) as int))")
    maps = [f"m{i}" for i in range(MAP_WORDS)]
    bits = rows.join(shared, "shingle").groupBy("id").agg(
        *[F.bit_or(F.when(word == i, bit).otherwise(F.lit(0))).alias(m) for i, m in enumerate(maps)]
    )
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    known = stage(nodes.join(sizes, "component").join(bits, "id"), "known")
    # Members of one set alone are the rarest, so they take the first ranks.
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # What is left of a set from a shingle on; at the first shared one, no more is shared.
    left = F.col("in_common") - F.col("rank") + 1
    rare = stage(
        ranked.join(known, "id")
        .where(F.col("rank") + F.col("n") - F.col("in_common") <= prefix)
        .select(
            "shingle", "id", "n", "in_common", "component", "weight", *maps,
            _band(F.col("n")).alias("band"),
            F.ceil(F.col("n") * percent / 100).cast("long").alias("least"),
            (F.floor(left * (100 + percent) / percent) - F.col("n")).cast("long").alias("most"),
        ),
        "rare",
    )
    largest = rare.groupBy("shingle").agg(
        F.max(F.struct("weight", "component")).alias("top"),
        F.min("component").alias("x"),
        F.max("component").alias("y"),
    ).where("x <> y").select("shingle", F.col("top.component").alias("main"))
    bands = F.sequence(_band(F.col("least")), _band(F.col("most")))
    few = rare.join(largest, "shingle").where("component <> main AND most >= least").select(
        "shingle", F.explode(bands).alias("band"), F.col("id").alias("c_id"),
        F.col("n").alias("c_n"), F.col("most").alias("c_most"),
        F.col("in_common").alias("c_common"), F.col("component").alias("c_component"),
        *[F.col(m).alias(f"c_{m}") for m in maps],
    )

    def lacking(a: str, b: str) -> Column:
        return F.expr(" + ".join(f"bit_count({a}{m} & ~{b}{m})" for m in maps))

    common = F.least(
        F.col("in_common") - lacking("", "c_"), F.col("c_common") - lacking("c_", "")
    )
    sizes_fit = (F.col("c_n") <= F.col("most")) & (F.col("n") <= F.col("c_most"))
    met = rare.join(few, ["shingle", "band"]).where(
        (F.col("component") != F.col("c_component"))
        & sizes_fit
        & _fits(percent, "n", "c_n", common)
    )
    return _pairs(met).distinct()


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per row of ``df``: key, n_shingles, component_id, kept.

    Documents are linked when ``100 * common >= percent * union`` of their
    shingle sets; ``component_id`` is the smallest key reachable over links and
    ``kept`` whether it is the row's own. Null, empty and blank texts have no
    shingles and are linked with nothing. A row with a null key has a null
    component and is kept; rows that share a key are kept or not by their own
    texts. An empty table gives an empty result. ``bands * rows`` must be a
    power of two. Runs jobs; intermediate tables go to the shared folder.
    """
    kind = df.schema[key].dataType.simpleString()
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sketch = stage(
        map_lean(
            docs,
            _sketch_mapper(width, bands, rows),
            f"id {kind}, n long, h1 long, h2 long, bands array<long>",
        ),
        "sketch",
    )
    named = sketch.where("n > 0 AND id IS NOT NULL")
    # Equal sets are one node, named by the smallest key.
    nodes = stage(
        named.groupBy("h1", "h2", "n").agg(F.min("id").alias("id"), F.first("bands").alias("bands")),
        "nodes",
    )
    dealt = nodes.select("id", "n", F.explode("bands").alias("key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stage(dealt.join(shared, "key"), "met")
    degree = met.groupBy("id").agg(F.sum("size").alias("degree"))
    members = stage(met.drop("size").join(degree, "id"), "members")

    # Full sets of the documents that met another, once for all rounds.
    sets = stage(
        map_lean(
            docs.join(degree.select("id"), "id", "left_semi"),
            _set_mapper(width),
            f"id {kind}, members binary",
        ).dropDuplicates(["id"]),
        "sets",
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("id").alias("a"), F.col("members").alias("left"))
        right = sets.select(F.col("id").alias("b"), F.col("members").alias("right"))
        return stage(
            map_lean(
                pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"),
                _confirm_mapper(percent),
                f"a {kind}, b {kind}, linked boolean",
            ),
            "compared",
        )

    def with_components(links: DataFrame) -> DataFrame:
        found = components(links).withColumnRenamed("node", "id")
        own = members.join(found, "id", "left")
        return own.withColumn("component", F.coalesce("component", "id"))

    # Every document with the best of its centres.
    alone = members.withColumn("component", F.col("id"))
    best = F.max(F.struct("c_degree", "c_id")).alias("best")
    first = _with_centres(alone, percent).groupBy("id").agg(best)
    compared = confirmed(_pairs(first.select("id", "best.c_id")).distinct())
    links = compared.where("linked").select("a", "b")
    # All centres of the buckets that are not settled.
    apart = _still_apart(with_components(links))
    second = _pairs(_with_centres(apart, percent)).distinct()
    compared = compared.union(confirmed(second.join(compared, ["a", "b"], "left_anti")))
    links = stage(compared.where("linked").select("a", "b"), "links")
    # The rest, by rarest shingles.
    apart = _still_apart(with_components(links))
    third = _rare_pairs(apart, sets, percent, kind)
    last = confirmed(third.join(compared, ["a", "b"], "left_anti"))
    links = links.union(last.where("linked").select("a", "b"))

    owner = named.join(nodes.select("h1", "h2", "n", F.col("id").alias("node")), ["h1", "h2", "n"])
    owner = owner.select("id", "n", "node").join(components(links), "node", "left")
    rest = sketch.where("n = 0 OR id IS NULL").select(
        "id", "n", F.lit(None).cast(kind).alias("node"), F.col("id").alias("component")
    )
    return (
        owner.select("id", "n", "node", "component")
        .union(rest)
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "node").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )
