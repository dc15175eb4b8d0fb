"""Phrases whose words stand together more often than by chance.

Only the longest windows are counted: at each word the next few words of its
piece, side by side as lead columns, padded with nulls where the piece ends.
A phrase that stands somewhere is a prefix of exactly one of these windows, so
ROLLUP over the columns sums windows to counts of all shorter phrases; phrases
of each length are never listed on their own.

Before that, words are counted. A phrase is no more frequent than any word in
it, so a word that is too rare ends a window as the end of a piece does. Which
words may stay is told by a bit map of a fixed size: a word whose bit is unset
is too rare for certain, others are decided by counting. Words travel as 63-bit
hashes of language and word, the most frequent ones as small numbers, which
compress; at the end the vocabulary spells them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm.common import mix64, slices, text_buffer, word_hashes, word_spans
from candlemill.session import small_table, stage

# What ends a piece, [.,;:!?\x0A-\x0D], and what else parts words.
PIECE_BREAKS = (*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)
WORD_BREAKS = (0x20, 0x09)
# Language of texts that have none.
UNKNOWN = "und"

# Bits of the map of words that may be frequent, and the most words with a
# small number: both fix the size of what is broadcast, not the result.
MAP_BITS = 1 << 24
SHORT_CODES = 1 << 16
# Bits in one row of Spark's bitmap aggregate.
_CHUNK_BITS = 32_768
_PIECE_BYTES = 512 << 10
# Windows a task combines before it hands them on.
_COMBINED = 1 << 19
_BATCH_ROWS = 1 << 16
# Hashes have this bit, small numbers do not.
_HASH_BIT = np.uint64(1 << 62)


# ---------------------------------------------------------------- words of texts


def _in_set(members: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Lower-case bytes, row offsets and languages; a long text in parts between pieces."""
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    ends_piece = _in_set(PIECE_BREAKS)
    for part in slices(batches, "text", _PIECE_BYTES):
        data, offsets = text_buffer(part.column("text"))
        data, langs = lower[data], part.column("lang")
        if len(data) <= _PIECE_BYTES:
            yield data, offsets, langs
            continue
        stops = np.flatnonzero(ends_piece[data])  # a long text comes alone
        cuts = [0]
        while len(data) - cuts[-1] > _PIECE_BYTES:
            at = np.searchsorted(stops, cuts[-1] + _PIECE_BYTES)
            if at == len(stops):
                break
            cuts.append(int(stops[at]) + 1)
        for a, b in zip(cuts, [*cuts[1:], len(data)]):
            yield data[a:b], np.array([0, b - a]), langs


def _keyed_words(data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
    """Start, end, row, piece and key of each word; the key covers the language."""
    starts, ends, first = word_spans(data, offsets, PIECE_BREAKS + WORD_BREAKS)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pieces = np.cumsum(_in_set(PIECE_BREAKS)[data])
    piece = pieces[starts] + row  # neither ever falls, so neighbours tell by the sum
    names, edges = text_buffer(langs)
    own = word_hashes(names, edges[:-1], edges[1:], seed=1)
    keys = mix64(word_hashes(data, starts, ends) ^ own[row])
    return starts, ends, row, piece, (keys >> np.uint64(2)) | _HASH_BIT


def _word_mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, word, key and count of the distinct words of some texts."""
    for data, offsets, langs in _parts(batches):
        starts, ends, row, _, keys = _keyed_words(data, offsets, langs)
        found, at, n = np.unique(keys, return_index=True, return_counts=True)
        starts, sizes = starts[at], (ends - starts)[at]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        letters = data[np.repeat(starts - edges[:-1], sizes) + np.arange(edges[-1])]
        words = pa.StringArray.from_buffers(
            len(found), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(letters)
        )
        yield pa.RecordBatch.from_arrays(
            [langs.take(pa.array(row[at])), words, pa.array(found.view(np.int64)), pa.array(n)],
            names=["lang", "word", "key", "n"],
        )


def _combined(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows (columns of keys, 0 for none) in order, and how often each is there."""
    rows = np.concatenate(windows, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    return rows[:, at], np.diff(np.append(at, rows.shape[1]))


def lead_windows(keys: np.ndarray, piece: np.ndarray, frequent: np.ndarray, width: int) -> np.ndarray:
    """For each frequent word the keys of it and the words after it, one row per lead.

    0 stands from the first word on that is rare or in another piece.
    """
    n = len(keys)
    out = np.zeros((width, n), np.uint64)
    going = frequent.copy()
    for lead in range(min(width, n)):
        if lead:
            going[n - lead :] = False
            going[: n - lead] &= frequent[lead:] & (piece[lead:] == piece[: n - lead])
        out[lead, : n - lead] = np.where(going[: n - lead], keys[lead:], 0)
    return out[:, frequent]


def _window_mapper(width: int, bits, codes):
    """Distinct windows of some texts with their counts, in columns w0, w1, ... and n."""

    def batches_of(windows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows, n = _combined(windows)
        for a in range(0, rows.shape[1], _BATCH_ROWS):
            some = rows[:, a : a + _BATCH_ROWS].view(np.int64)
            columns = [pa.array(c, mask=c == 0) for c in some]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n[a : a + _BATCH_ROWS])],
                names=[*(f"w{i}" for i in range(width)), "n"],
            )

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, heads = bits.value, codes.value
        held, size = [], 0
        for data, offsets, langs in _parts(batches):
            _, _, _, piece, keys = _keyed_words(data, offsets, langs)
            slot = keys % np.uint64(MAP_BITS)
            frequent = (marks[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
            if len(heads):
                code = np.searchsorted(heads, keys)
                known = heads[np.minimum(code, len(heads) - 1)] == keys
                keys = np.where(known, code.astype(np.uint64) + np.uint64(1), keys)
            held.append(lead_windows(keys, piece, frequent, width))
            size += held[-1].shape[1]
            if size >= _COMBINED:
                yield from batches_of(held)
                held, size = [], 0
        if size:
            yield from batches_of(held)

    return mapper


# ---------------------------------------------------------------- on Spark


def vocabulary(docs: DataFrame) -> DataFrame:
    """lang, word, key and n: how often each word stands in texts of a language."""
    words = docs.mapInArrow(_word_mapper, "lang string, word string, key long, n long")
    return words.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _frequent_bits(words: DataFrame, least: int) -> np.ndarray:
    """A bit for each slot that a word with at least ``least`` occurrences falls into."""
    # Spark numbers bitmap chunks and places from 1.
    slot = F.pmod(F.col("key"), F.lit(MAP_BITS)) + 1
    rows = (
        words.where(F.col("n") >= least)
        .groupBy(F.bitmap_bucket_number(slot).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .collect()  # MAP_BITS bits at most
    )
    size = _CHUNK_BITS // 8
    out = np.zeros((MAP_BITS // _CHUNK_BITS, size), np.uint8)
    for chunk, bits in rows:
        out[chunk - 1] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def _head_keys(words: DataFrame, least: int) -> np.ndarray:
    """Sorted keys of the most frequent words: all from a power of two on that few enough reach."""
    level = F.floor(F.log2("n")).cast("int")
    rows = words.where(F.col("n") >= least).groupBy(level.alias("level")).count().collect()
    total, lowest = 0, 62
    for row in sorted(rows, reverse=True):
        if total + row["count"] > SHORT_CODES:
            break
        total, lowest = total + row["count"], row["level"]
    head = words.where(F.col("n") >= max(least, 1 << lowest)).select("key")
    return np.sort(head.toArrow().column("key").to_numpy().astype(np.int64)).view(np.uint64)


def frequent_phrases(windows: DataFrame, width: int, least: int) -> DataFrame:
    """words (array of keys) and a of all phrases up to ``width`` words, found ``least`` times.

    ``windows`` has columns w0, w1, ..., n. The longest phrases are counted
    windows; ROLLUP over the columns before the last sums all shorter ones.
    """
    columns = [f"w{i}" for i in range(width)]
    counted = windows.groupBy(*columns).agg(F.sum("n").alias("a"))
    # A condition on counts stays above the aggregate, so both uses share one shuffle.
    whole = F.when(F.col(columns[-1]).isNotNull(), F.col("a"))
    found = counted.where(whole >= least).select(F.array(*columns).alias("words"), "a")
    if width == 1:
        return found
    # The first column is never summed away, as its total would be of no phrase.
    # Padding is null as well as what a sum leaves out; the level tells them apart.
    groups = ", ".join([columns[0], *([f"ROLLUP({', '.join(columns[1:-1])})"] if width > 2 else [])])
    left_out = "bit_count(grouping_id())" if width > 2 else "0"
    sums = counted.sparkSession.sql(
        f"SELECT {', '.join(columns[:-1])}, {left_out} AS left_out, sum(a) AS a "
        f"FROM {{counted}} GROUP BY {groups} HAVING sum(a) >= {int(least)}",
        counted=counted,
    )
    size = sum(F.col(c).isNotNull().cast("int") for c in columns[:-1])
    words = F.filter(F.array(*columns[:-1]), lambda w: w.isNotNull())
    shorter = sums.where(size + F.col("left_out") == width - 1).select(words.alias("words"), "a")
    return found.union(shorter)


def _scored(phrases: DataFrame, shortest: int) -> DataFrame:
    """Candidates with the cut that scores lowest: words, a, l, r, score.

    Counts up to 10**15 are exact: squares times a million stay below 10**38.
    """
    candidates = phrases.where(F.size("words") >= shortest)
    n = F.size("words")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), n - 1)))
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn(
        "tail", F.slice("words", F.col("k") + 1, n - F.col("k"))
    )
    heads = phrases.select(F.col("words").alias("head"), F.col("a").alias("l"))
    tails = phrases.select(F.col("words").alias("tail"), F.col("a").alias("r"))

    def big(name: str) -> str:
        return f"cast({name} as decimal(16,0))"

    score = f"cast(1000000 as decimal(7,0)) * ({big('a')} * {big('a')}) div ({big('l')} * {big('r')})"
    return (
        cuts.join(heads, "head")
        .join(tails, "tail")
        .withColumn("score", F.expr(score))
        .groupBy("words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("words", "a", "cut.l", "cut.r", "cut.score")
    )


def _inside_longer(phrases: DataFrame, shortest: int, longest: int) -> DataFrame:
    """words and longer: the highest count of a candidate that holds the words inside it."""

    def inner(words: Column) -> Column:
        parts = [
            F.when(F.size(words) >= start + size - 1, F.slice(words, start, size))
            for size in range(shortest, longest)
            for start in range(1, longest - size + 2)
        ]
        return F.filter(F.array(*parts), lambda p: p.isNotNull() & (F.size(p) < F.size(words)))

    pairs = phrases.where(F.size("words") > shortest).select(
        F.explode(inner(F.col("words"))).alias("words"), "a"
    )
    return pairs.groupBy("words").agg(F.max("a").alias("longer"))


def _first_of_each(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language; parts of it are cut down before it meets in one task."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    some = Window.partitionBy("lang", part).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    return (
        rows.withColumn("rank", F.row_number().over(some))
        .where(F.col("rank") <= first)
        .withColumn("rank", F.row_number().over(whole).cast("long"))
        .where(F.col("rank") <= first)
    )


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    shortest: int = 2,
    longest: int = 3,
    least: int = 10,
    inside_percent: int = 50,
    first: int = 2000,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language.

    A-Z count as a-z; pieces end at punctuation and line ends, words at blanks
    and tabs. ``a`` is how often the phrase stands within pieces of its
    language, ``l`` and ``r`` the same for the two parts of its lowest-scoring
    cut, ``n`` the language's words, and score ``floor(10**6 a a / (l r))``.
    Phrases of ``shortest`` to ``longest`` words found ``least`` times are
    candidates; one inside a longer candidate that has at least
    ``inside_percent`` of its count goes. Ties go to the higher ``a``, then to
    the phrase that is smaller in bytes.

    Null and empty texts have no words; a null language is ``und``. Repeated
    rows count as often as they are there. An empty table gives an empty
    result. Other columns play no part. Runs jobs.
    """
    if not 1 < shortest <= longest:
        raise ValueError("phrases have two words at least")
    docs = df.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(f"`{text}`").alias("text"),
    )
    context = df.sparkSession.sparkContext
    words = stage(vocabulary(docs), "words")
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    heads = _head_keys(words, least)
    bits, codes = context.broadcast(_frequent_bits(words, least)), context.broadcast(heads)
    names = ", ".join(f"w{i} long" for i in range(longest))
    windows = docs.mapInArrow(_window_mapper(longest, bits, codes), f"{names}, n long")
    phrases = stage(frequent_phrases(windows, longest, least), "phrases")

    inside = _inside_longer(phrases, shortest, longest)
    kept = _scored(phrases, shortest).join(inside, "words", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    table = small_table(
        df.sparkSession,
        key=(pa.int64(), heads.view(np.int64)),
        code=(pa.int64(), range(1, len(heads) + 1)),
    )
    spelling = words.where(F.col("n") >= least).join(F.broadcast(table), "key", "left").select(
        "lang", "word", F.coalesce("code", "key").alias("w")
    )
    numbers = ["words", "a", "l", "r", "score"]
    spelled = (
        kept.select(*numbers, F.posexplode("words").alias("at", "w"))
        .join(spelling, "w")
        .groupBy(*numbers)
        .agg(
            F.min("lang").alias("lang"),
            F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"),
        )
        .select("lang", F.concat_ws(" ", "parts.word").alias("phrase"), *numbers[1:])
    )
    ranked = _first_of_each(spelled, first)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
