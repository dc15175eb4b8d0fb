"""Removal of long word passages that stand in an earlier document.

A passage of ``window`` words counts as repeated if a document with a smaller
key has it too. Hashing every window of every document would move far too
much, so short windows are hashed at cover positions alone: positions that lie
in a difference cover modulo a period. Whatever way two documents are shifted
against each other, an equal passage of ``window`` words has a cover position
that is one in both, so both have the same anchor there. Only passages around
anchors that two documents share are then extended to full windows and decided
by their hashes of 96 bits.

A key that very many documents share is found in a sample beforehand, combined
inside the tasks and looked up in a table of bounded size, all others take one
shuffle; which way a key goes never changes the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm.common import (
    map_lean,
    slices,
    span_hashes,
    text_buffer,
    word_hashes,
    word_spans,
)
from candlemill.session import small_table, stage

WINDOW = 50
PERIOD = 31

# One document in SAMPLE_EVERY is looked at for hot keys; a key is hot if at
# least one in HOT_SHARE of those, and HOT_LEAST of them, have it. The most
# frequent HOT_KEYS are handled as hot, all others by the shuffle.
SAMPLE_EVERY = 32
HOT_SHARE = 500
HOT_LEAST = 8
HOT_KEYS = 100_000


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set whose pairwise differences give every residue of ``period``."""

    def search(chosen: list[int], covered: frozenset, size: int):
        if len(covered) == period:
            return tuple(chosen)
        left = size - len(chosen)
        # Every further element adds two differences with each one before it.
        if period - len(covered) > sum(2 * (len(chosen) + i) for i in range(left)):
            return None
        for e in range(chosen[-1] + 1, period):
            new = {(e - c) % period for c in chosen} | {(c - e) % period for c in chosen}
            found = search([*chosen, e], covered | new, size)
            if found:
                return found
        return None

    return next(found for size in count(1) if (found := search([0], frozenset([0]), size)))


def anchor_starts(n_words: int, window: int, period: int, cover: tuple[int, ...]) -> np.ndarray:
    """Cover positions at which an anchor of ``window - period + 1`` words fits, if windows do."""
    if n_words < window:
        return np.empty(0, np.int64)
    last = n_words - (window - period + 1)
    grid = np.arange(0, last + 1, period)[:, None] + np.array(cover)
    return grid[grid <= last]


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    starts, ends, first = word_spans(data, offsets)
    return word_hashes(data, starts, ends), first


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _anchor_mapper(window: int, period: int, cover: tuple[int, ...], by: list[str]):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes, first = _words(part.column("text"))
            counts = np.diff(first)
            at = [a + anchor_starts(n, window, period, cover) for a, n in zip(first, counts)]
            begin = np.concatenate(at).astype(np.int64)
            anchors = span_hashes(hashes, begin, begin + (window - period + 1)).view(np.int64)
            ends = np.cumsum([0, *map(len, at)])
            whole = [
                span_hashes(hashes, first[:-1], first[1:], seed).view(np.int64) for seed in (1, 2)
            ]
            texts = part.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in by],
                    pa.array(counts, pa.int64()),
                    pa.array(whole[0]),
                    pa.array(whole[1]),
                    pa.array([_sha((t or b"").split()) for t in texts], pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(anchors)),
                ],
                names=[*by, "n_words", "h1", "h2", "sha", "anchors"],
            )

    return mapper


def _covered(ranges: pa.Scalar, n: int, more: int = 0) -> np.ndarray:
    """Which of ``n`` places lie in ranges, each ``more`` places longer than stated."""
    pairs = ranges.values
    first, last = (pairs.field(f).to_numpy() for f in ("first", "last"))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(first, n), 1)
    np.add.at(edge, np.minimum(last + more + 1, n), -1)
    return np.cumsum(edge)[:n] > 0


def _window_mapper(window: int, period: int, cover: tuple[int, ...], by: list[str]):
    """Full windows around the shared anchors of each document."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes, first = _words(part.column("text"))
            begin, sizes = [], []
            for a, n, hits in zip(first, np.diff(first), part.column("hits")):
                wanted = np.zeros(max(n - window + 1, 0) + 1, np.int64)
                starts = anchor_starts(n, window, period, cover)
                # A window holds the anchors that start in its first `period` words.
                q = starts[_covered(hits, len(starts))]
                low = np.clip(q - period + 1, 0, len(wanted) - 1)
                high = np.clip(q + 1, 0, len(wanted) - 1)
                np.add.at(wanted, low, 1)
                np.add.at(wanted, high, -1)
                found = np.flatnonzero(np.cumsum(wanted)[:-1] > 0)
                begin.append(a + found)
                sizes.append(len(found))
            begin = np.concatenate(begin).astype(np.int64)
            owner = np.repeat(np.arange(part.num_rows), sizes)
            full = span_hashes(hashes, begin, begin + window, 3).view(np.int64)
            check = span_hashes(hashes, begin, begin + window, 4).astype(np.uint32)
            for a in range(0, len(begin), 1 << 16):
                cut = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(pa.array(owner[cut])) for c in by],
                        pa.array((begin - first[owner])[cut], pa.int32()),
                        pa.array(full[cut]),
                        pa.array(check[cut].view(np.int32)),
                    ],
                    names=[*by, "at", "full", "check"],
                )

    return mapper


def _cut_mapper(window: int, by: list[str]):
    """What is left of texts without the words that windows cover, given by ranges of starts."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            kept_texts, removed = [], []
            texts = part.column("text").cast(pa.binary())
            for text, starts in zip(texts, part.column("starts")):
                words = text.as_py().split()
                keep = ~_covered(starts, len(words), window - 1)
                kept_texts.append(b" ".join([w for w, k in zip(words, keep.tolist()) if k]))
                removed.append(int((~keep).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in by],
                    pa.array(removed, pa.int64()),
                    pa.array(kept_texts, pa.binary()).cast(pa.string()),
                ],
                names=[*by, "n_removed", "kept"],
            )

    return mapper


def _find_hot(batch: pa.RecordBatch, keys: list[str], hot: list[np.ndarray]) -> tuple:
    """Rows of the batch whose key is hot, and the place of the key in the hot table."""
    columns = [batch.column(k).to_numpy() for k in keys]
    at = np.minimum(np.searchsorted(hot[0], columns[0]), len(hot[0]) - 1)
    same = np.logical_and.reduce([h[at] == c for h, c in zip(hot, columns)])
    rows = np.flatnonzero(same)
    return rows, at[rows]


def _hot_extremes(keys: list[str], id_: str, hot: list[np.ndarray]):
    """Smallest and largest id per hot key of each batch."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows, at = _find_hot(part, keys, hot)
            order = np.argsort(at, kind="stable")
            place, first = np.unique(at[order], return_index=True)
            ids = part.column(id_).to_numpy()[rows][order]
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place, pa.int64()),
                        pa.array(np.minimum.reduceat(ids, first)),
                        pa.array(np.maximum.reduceat(ids, first)),
                    ],
                    names=["place", "least", "most"],
                )

    return mapper


def _hot_ranges(
    keys: list[str], by: list[str], earlier: bool, hot: list[np.ndarray], least, most
):
    """Ranges of neighbouring rows whose hot keys are shared."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows, place = _find_hot(part, keys, hot)
            *who, at = (part.column(c).to_numpy()[rows] for c in (*by, "at"))
            shared = least[place] < (who[0] if earlier else most[place])
            *who, at = (x[shared] for x in (*who, at))
            if len(at):
                opens = np.ones(len(at), bool)
                opens[1:] = at[1:] != at[:-1] + 1
                for x in who:
                    opens[1:] |= x[1:] != x[:-1]
                head = np.flatnonzero(opens)
                tail = np.append(head[1:], len(at)) - 1
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[head]) for x in who], pa.array(at[head]), pa.array(at[tail])],
                    names=[*by, "first", "last"],
                )

    return mapper


def shared_ranges(rows: DataFrame, keys: list[str], by: list[str], earlier: bool) -> DataFrame:
    """Ranges ``first`` to ``last`` of ``at`` whose keys another id has, per row of ``by``.

    ``by`` names the id and what else tells rows apart.

    With ``earlier`` only those that a smaller id has. One shuffle for keys of
    few documents. Hot keys (see above), at most HOT_KEYS, are combined inside
    the tasks and looked up in a broadcast table, so that their rows stay where
    they are. Keys and ids are longs or ints.
    """
    spark = rows.sparkSession
    sampled = rows.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(SAMPLE_EVERY)) == 0)
    n_documents = sampled.agg(F.approx_count_distinct("id")).first()[0]
    enough = max(HOT_LEAST, n_documents // HOT_SHARE)
    found = (
        sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough)
        .orderBy(F.desc("n"), *keys).limit(HOT_KEYS)
        .dropDuplicates(keys[:1]).orderBy(keys[0])
        .toArrow()
    )
    hot = [found[k].to_numpy() for k in keys]
    cold = rows
    if found.num_rows:
        table = small_table(spark, **{k: (found[k].type, h) for k, h in zip(keys, hot)})
        cold = rows.join(F.broadcast(table), keys, "left_anti")
    group = Window.partitionBy(*keys)
    ranges = (
        cold.withColumns({"least": F.min("id").over(group), "most": F.max("id").over(group)})
        .where(F.col("least") < F.col("id" if earlier else "most"))
        .select(*by, F.col("at").alias("first"), F.col("at").alias("last"))
    )
    if not found.num_rows:
        return ranges
    kind = rows.schema["id"].dataType.simpleString()
    ends = (
        map_lean(
            rows.select(*keys, "id"),
            _hot_extremes(keys, "id", hot),
            f"place long, least {kind}, most {kind}",
        )
        .groupBy("place")
        .agg(F.min("least").alias("least"), F.max("most").alias("most"))
        .orderBy("place")
        .toArrow()
    )
    least, most = ends["least"].to_numpy(), ends["most"].to_numpy()
    return ranges.union(
        map_lean(
            rows.select(*by, "at", *keys),
            _hot_ranges(keys, by, earlier, hot, least, most),
            f"{_typed(rows, by)}, first int, last int",
        )
    )


def _typed(df: DataFrame, by: list[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)


def _ranges(name: str) -> Column:
    return F.collect_list(F.struct("first", "last")).alias(name)


def remove_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    period: int = PERIOD,
) -> DataFrame:
    """One row per row of ``df``: key, n_words, n_removed, kept_sha256, kept.

    A word goes if a window over it also starts in a row of a smaller key;
    windows are judged on the input. ``kept`` is what is left, its words joined
    by single spaces, and null where nothing was removed or the whole text was;
    ``kept_sha256`` is the hash of what is left in every case. Null, empty and
    short texts lose nothing, nor do rows with a null key (keys are whole numbers),
    which do not count as earlier documents either. Rows that share a key do not
    repeat each other; each loses what its own text repeats of smaller keys. An
    empty table gives an empty result.
    """
    cover = difference_cover(period)
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    by = ["id"]
    repeated = docs.where("id IS NOT NULL").groupBy("id").count().where("count > 1")
    if not repeated.isEmpty():
        # A hash of the text tells rows of one key apart; equal rows fare equally.
        by = ["id", "row"]
        docs = docs.withColumn("row", F.xxhash64("text"))
    who = _typed(docs, by)
    sketch = stage(
        map_lean(
            docs,
            _anchor_mapper(window, period, cover, by),
            f"{who}, n_words long, h1 long, h2 long, sha string, anchors array<long>",
        ),
        "anchors",
    )
    # Whole copies of an earlier text need no windows.
    narrow = sketch.select(*by, "n_words", "h1", "h2").where(
        F.col("id").isNotNull() & (F.col("n_words") >= window)
    )
    same = ["h1", "h2", "n_words"]
    owners = narrow.groupBy(*same).agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    copies = stage(
        narrow.join(owners.where("owner < last").drop("last"), same)
        .where("id > owner")
        .select(*by)
        .distinct(),
        "copies",
    )
    anchors = sketch.where(F.col("id").isNotNull()).select(
        *by, F.posexplode("anchors").alias("at", "anchor")
    )
    hits = (
        shared_ranges(anchors, ["anchor"], by, earlier=False)
        .groupBy(*by)
        .agg(_ranges("hits"))
        .join(copies, by, "left_anti")
    )
    near = stage(docs.join(hits, by), "near")
    windows = stage(
        map_lean(
            near,
            _window_mapper(window, period, cover, by),
            f"{who}, at int, full long, check int",
        ),
        "windows",
    )
    repeated = (
        shared_ranges(windows, ["full", "check"], by, earlier=True)
        .groupBy(*by)
        .agg(_ranges("starts"))
    )
    cut = map_lean(
        near.select(*by, "text").join(repeated, by),
        _cut_mapper(window, by),
        f"{who}, n_removed long, kept string",
    )
    gone = copies.select(
        *by, F.lit(True).alias("copy"), F.lit(None).cast("long").alias("n_removed"),
        F.lit(None).cast("string").alias("kept"),
    )
    changed = cut.select(*by, F.lit(False).alias("copy"), "n_removed", "kept").union(gone)
    joined = sketch.select(*by, "n_words", "sha").join(changed.dropDuplicates(by), by, "left")
    left = (
        F.when(F.col("copy"), F.sha2(F.lit("").cast("binary"), 256))
        .when(F.col("kept").isNotNull(), F.sha2(F.col("kept").cast("binary"), 256))
        .otherwise(F.col("sha"))
    )
    return joined.select(
        F.col("id").alias(key),
        "n_words",
        F.when(F.col("copy"), F.col("n_words"))
        .otherwise(F.coalesce("n_removed", F.lit(0)))
        .alias("n_removed"),
        left.alias("kept_sha256"),
        "kept",
    )
