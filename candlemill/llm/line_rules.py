"""Quality rules for documents, with lines that many documents of a host share.

Inside a document: words, symbols, lines that repeat and words in windows that
repeat. Across documents: lines are normalised (A-Z as a-z, digits as 0, words
one blank apart) and hashed, and each host's distinct documents with a line are
counted. A line that is in more of them than a limit is no content of any one
document and goes; a document that loses most of its words is rejected.

Documents with equal texts count as one, as copies say nothing about a line.
Only hashes of lines are shuffled, and those above a limit are at most one for
every ``least_documents`` documents that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.llm.common import (
    keeping,
    kept_batch,
    mix64,
    slices,
    span_hashes,
    text_buffer,
    unclashing,
    word_hashes,
    word_spans,
)
from candlemill.session import stage

# Characters that count as symbols, [#*$%&|<>].
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 8
# Base rules: documents with fewer words, or more of them in repeated windows.
LEAST_WORDS = 20
REPEATED_PERCENT = 30
# A line goes that is in more than this share of a host's documents, if it is
# in this many at least.
LINE_PERCENT = 10
LEAST_DOCUMENTS = 10
# Documents that keep fewer of their words than this are depleted.
KEPT_PERCENT = 30

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_NEWLINE = 0x0A


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[offsets])


def _line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each line, and the row it is in."""
    breaks = np.flatnonzero(data == _NEWLINE)
    broken = np.searchsorted(offsets, breaks, "right") - 1  # the row of each line break
    rows = np.arange(len(offsets) - 1)
    # Rows decide first, as empty ones share their place with a neighbour.
    starts, ends = np.append(offsets[:-1], breaks + 1), np.append(breaks, offsets[1:])
    opened, closed = np.append(rows, broken), np.append(broken, rows)
    return (
        starts[np.lexsort((starts, opened))],
        ends[np.lexsort((ends, closed))],
        np.sort(opened),
    )


def _normalised(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    table[0x31:0x3A] = 0x30
    return table[data]


def _in_rows(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that are equal only inside a row."""
    return mix64(hashes ^ mix64(rows.astype(np.uint64) + np.uint64(1)))


class Measured:
    """Base counts of each row and its lines of words, as arrays over a few texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n_rows = len(offsets) - 1
        starts, ends, first = word_spans(data, offsets)
        n_words = np.diff(first)
        row = np.repeat(np.arange(n_rows), n_words)
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        symbols = np.zeros(256, bool)
        symbols[list(SYMBOLS)] = True

        # Lines that hold a word, and their words.
        line_start, line_end, line_row = _line_spans(data, offsets)
        word_from, word_to = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
        used = word_to > word_from
        line_start, line_end, line_row = line_start[used], line_end[used], line_row[used]
        word_from, word_to = word_from[used], word_to[used]
        raw = np.unique(_in_rows(word_hashes(data, line_start, line_end), line_row), return_index=True)[1]
        lines = np.bincount(line_row, minlength=n_rows)
        distinct = np.bincount(line_row[raw], minlength=n_rows)

        # Words inside windows that the row has twice or more.
        words = word_hashes(data, starts, ends)
        at = np.flatnonzero(row[WINDOW_WORDS - 1 :] == row[: max(0, len(row) - WINDOW_WORDS + 1)])
        keys = _in_rows(span_hashes(words, at, at + WINDOW_WORDS), row[at])
        _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
        again = at[count[which] > 1]
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, again, 1)
        np.add.at(step, again + WINDOW_WORDS, -1)
        covered = np.cumsum(step)[:-1] > 0

        self.counts = {
            "n_words": n_words,
            "word_chars": np.bincount(row, letters[ends] - letters[starts], n_rows).astype(np.int64),
            "n_symbols": _sums(symbols[data], offsets),
            "n_dup_lines": lines - distinct,
            "n_repeat_words": np.bincount(row, covered, n_rows).astype(np.int64),
        }
        normal = word_hashes(_normalised(data), starts, ends, seed=2)
        self.line_row, self.line_words = line_row, word_to - word_from
        self.line_keys = span_hashes(normal, word_from, word_to, seed=2).view(np.int64)
        self.line_spans = line_start, line_end
        self.text_keys = [
            word_hashes(data, offsets[:-1], offsets[1:], seed=s).view(np.int64) for s in (3, 4)
        ]


def _measure_mapper(names: list[str]):
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            found = Measured(*text_buffer(part.column("_text")))
            n = part.num_rows
            # Distinct lines of each row with the words of all their copies.
            order = np.lexsort((found.line_keys, found.line_row))
            rows, keys = found.line_row[order], found.line_keys[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
            at = np.flatnonzero(new)
            words = np.add.reduceat(found.line_words[order], at) if len(at) else at
            ends = np.searchsorted(rows[at], np.arange(n + 1))
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    *[pa.array(found.counts[c], pa.int64()) for c in _COUNTS],
                    *[pa.array(k) for k in found.text_keys],
                    pa.ListArray.from_arrays(ends, pa.array(keys[at])),
                    pa.ListArray.from_arrays(ends, pa.array(words, pa.int64())),
                ],
                names=names,
            )

    return mapper


def measure(df: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """Base counts, hashes and distinct normalised lines of each row of ``df``, numbered.

    Stored, so that the numbers stay as they are.
    """
    source = df.select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{host}`").alias("_host"), F.col(f"`{text}`").alias("_text")
    )
    schema = source.drop("_text").schema
    for name in (*_COUNTS, "_h1", "_h2"):
        schema = schema.add(name, T.LongType())
    for name in ("_lines", "_line_words"):
        schema = schema.add(name, T.ArrayType(T.LongType()))
    found = source.mapInArrow(_measure_mapper(schema.fieldNames()), schema)
    return stage(found.withColumn("_row", F.monotonically_increasing_id()), "measured")


def common_lines(
    measured: DataFrame, percent: int = LINE_PERCENT, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """_host and line (hash) of the lines that are in too many distinct documents of the host."""
    distinct = measured.select("_host", "_h1", "_h2", "_lines").distinct()
    hosts = distinct.groupBy("_host").agg(F.count(F.lit(1)).alias("documents"))
    hosts = stage(hosts.withColumnRenamed("_host", "host"), "hosts")
    counts = (
        distinct.select("_host", F.explode("_lines").alias("line"))
        .groupBy("_host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_documents)
    )
    above = counts.join(hosts, F.col("_host").eqNullSafe(F.col("host"))).where(
        100 * F.col("n") > percent * F.col("documents")
    )
    return stage(above.select("host", "line"), "common-lines")


def judge(
    df: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    line_percent: int = LINE_PERCENT,
    least_documents: int = LEAST_DOCUMENTS,
    kept_percent: int = KEPT_PERCENT,
) -> DataFrame:
    """One row per row of ``df``: the key, base counts, base_failed, lost lines and words, kept.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word that equal an earlier one) and
    ``n_repeat_words`` (words in windows of eight that the text has twice or
    more) come from the text alone, as does ``base_failed``: fewer than 20
    words, or more than 30 % of them in repeated windows. ``n_common_lines``
    and ``n_common_words`` are the distinct lines above the host's limit and
    the words in all their copies; a document is ``kept`` unless it failed or
    what is left has fewer than 20 words or ``kept_percent`` of them.

    Null and empty texts have no words and fail; a null host is a host. Rows
    that share a key are judged by their own texts, equal texts count once. An
    empty table gives an empty result. Columns of ``df`` other than the named
    ones play no part. Runs jobs.
    """
    measured = measure(df, key, host, text)
    common = common_lines(measured, line_percent, least_documents)
    lines = measured.select(
        "_row", "_host", F.explode(F.arrays_zip("_lines", "_line_words")).alias("l")
    ).select("_row", "_host", F.col("l._lines").alias("_line"), F.col("l._line_words").alias("words"))
    lost = (
        lines.join(
            common, F.col("_host").eqNullSafe(F.col("host")) & (F.col("_line") == F.col("line"))
        )
        .groupBy("_row")
        .agg(F.count(F.lit(1)).alias("n_common_lines"), F.sum("words").alias("n_common_words"))
    )
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * n)
    left = n - F.col("n_common_words")
    depleted = (left < LEAST_WORDS) | (100 * left < kept_percent * n)
    zero = F.lit(0).cast("long")
    return (
        measured.join(lost, "_row", "left")
        .withColumns(
            {c: F.coalesce(c, zero) for c in ("n_common_lines", "n_common_words")}
        )
        .select(
            F.col("_key").alias(key),
            *_COUNTS,
            failed.alias("base_failed"),
            "n_common_lines",
            "n_common_words",
            (~failed & ~depleted).alias("kept"),
        )
    )


def without_common_lines(
    df: DataFrame, common: DataFrame, keep: list[str], host: str = "source", text: str = "text"
) -> DataFrame:
    """``keep`` columns and ``clean``: the text without its host's common lines.

    ``common`` is what ``common_lines`` gives. The lines left are joined by
    line breaks as they stand; a null text stays null. A host's lines travel to
    its documents as one list, whose size the share in ``common_lines`` bounds:
    at most 100 / percent times the lines of a document.
    """
    lists = common.groupBy("host").agg(F.collect_set("line").alias("gone"))
    gone = unclashing(df.columns, "_gone")
    lists = stage(lists.toDF("_of", gone), "host-lines")
    named = df.join(lists, F.col(f"`{host}`").eqNullSafe(F.col("_of")), "left")
    kept = keeping(named, [*keep, gone], text, [("clean", "string")])
    names, read = kept.names, kept.value

    def cleaned(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
        """The text without some lines and the breaks that end them."""
        stay = np.ones(len(body) + 1, bool)
        for start, end in zip(starts, ends):
            stay[start : end + 1] = False
        left = body[stay[:-1]].tobytes()
        return (left[:-1] if not stay[-1] and left.endswith(b"\n") else left).decode()

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, read):
            column = part.column(read)
            data, offsets = text_buffer(column)
            found = Measured(data, offsets)
            edges = np.searchsorted(found.line_row, np.arange(part.num_rows + 1))
            out = []
            for row, (a, b) in enumerate(zip(edges, edges[1:])):
                listed = part.column(len(keep))[row].as_py() or []
                hit = np.flatnonzero(np.isin(found.line_keys[a:b], listed)) + a
                first, last = offsets[row], offsets[row + 1]
                spans = [x[hit] - first for x in found.line_spans]
                out.append(cleaned(data[first:last], *spans) if column[row].is_valid else None)
            yield kept_batch(part, names, pa.array(out, pa.string()))

    return kept.source.mapInArrow(mapper, kept.schema).drop(gone)
