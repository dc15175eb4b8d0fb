"""Language identification of mixed-language text.

Scripts narrow down which languages a word can be in. A word's score for each
of these is its log-likelihood under character trigrams of the language. Over
the words of a text, Viterbi finds the best sequence of languages when each
switch costs a fixed penalty; equal neighbours are spans, and the language
with most of the text is its language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm.common import kept_batch, keeping, mix64, slices, text_buffer, word_spans

# Training documents per language at most, chosen by a hash of the key.
TRAIN_DOCUMENTS = 500
# Log-likelihood that a switch of language costs.
SWITCH_PENALTY = 14.0
UNKNOWN = "und"
_BITS = 18
_SMOOTHING = 0.5

# First code points of the ranges that are one script, by the
# Unicode blocks; a range lasts until the next one begins.
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"),
    (0x0780, "Thaana"), (0x07C0, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1D00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x2DE0, "Cyrillic"), (0x2E00, "Other"), (0x2E80, "Han"), (0x3040, "Kana"),
    (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Han"),
    (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"),
    (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7FC, "Other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB50, "Arabic"), (0xFE20, "Other"), (0xFE70, "Arabic"),
    (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"),
    (0x20000, "Han"), (0x32000, "Other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))


@dataclass(frozen=True)
class Words:
    """Words with a letter: trigram slots, script, length, and first word of each row."""

    slots: np.ndarray
    slot_ends: np.ndarray
    scripts: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte where each begins."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    a, b, c, d = (padded[lead + i] for i in range(4))
    points = np.where(a < 0x80, a, ((a & 0x1F) << 6) | (b & 0x3F))
    three = ((a & 0x0F) << 12) | ((b & 0x3F) << 6) | (c & 0x3F)
    four = ((a & 0x07) << 18) | ((b & 0x3F) << 12) | ((c & 0x3F) << 6) | (d & 0x3F)
    points = np.where(a >= 0xE0, three, points)
    return np.where(a >= 0xF0, four, points), lead


def lower_letters(points: np.ndarray) -> np.ndarray:
    """For each code point: its lower-case letter, or 0 if it is no letter."""
    distinct, back = np.unique(points, return_inverse=True)
    lower = np.zeros(len(distinct), np.uint32)
    for i, point in enumerate(distinct.tolist()):
        char = chr(point)
        if unicodedata.category(char)[0] == "L":
            lower[i] = ord(char.lower()[0])
    return lower[back.reshape(-1)]


def script_numbers(points: np.ndarray, letters: np.ndarray) -> np.ndarray | None:
    """Number of the script of each code point; None if all letters are Latin by their range."""
    if not len(points) or points[letters > 0].max(initial=0) < SCRIPT_RANGES[1][0]:
        return None
    edges = np.array([r for r, _ in SCRIPT_RANGES])
    numbers = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])
    return numbers[np.searchsorted(edges, points, "right") - 1]


def _script_changes(
    scripts: np.ndarray, letters: np.ndarray, first: np.ndarray, past: np.ndarray
) -> np.ndarray:
    """Letters whose script differs from that of the letter before them in the word."""
    lettered = np.flatnonzero(letters > 0)
    word = np.searchsorted(first, lettered, "right") - 1
    inside = (word >= 0) & (lettered < past[np.maximum(word, 0)]) if len(first) else lettered < 0
    lettered, word = lettered[inside], word[inside]
    same_word = word[1:] == word[:-1]
    return lettered[1:][same_word & (scripts[lettered[1:]] != scripts[lettered[:-1]])]


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of rows given as UTF-8 bytes; characters that are no letters separate trigrams.

    A word ends where the script of its letters changes, as some scripts have
    no space between words, or next to other scripts.
    """
    points, lead = _code_points(data)
    letters = lower_letters(points)
    starts, ends, _ = word_spans(data, offsets)
    first = np.searchsorted(lead, starts)
    past = np.searchsorted(lead, ends)
    script_of = script_numbers(points, letters)
    if script_of is not None:
        cuts = _script_changes(script_of, letters, first, past)
        first, past = np.sort(np.append(first, cuts)), np.sort(np.append(past, cuts))
        lead_ends = np.append(lead, len(data))
        starts, ends = lead_ends[first], lead_ends[past]
    has = np.concatenate([[0], np.cumsum(letters > 0)])
    n_letters = has[past] - has[first]
    first, past, starts, ends = (x[n_letters > 0] for x in (first, past, starts, ends))
    lengths = n_letters[n_letters > 0]
    # One trigram per character of a word, around it, with 0 beyond the word,
    # and one more at its end.
    sizes = past - first + 1
    slot_ends = np.cumsum(sizes)
    at = np.repeat(first - (slot_ends - sizes), sizes) + np.arange(sizes.sum())
    owner = np.repeat(np.arange(len(first)), sizes)
    wide = np.concatenate([letters, np.zeros(2, np.uint32)]).astype(np.uint64)

    def near(shift: int) -> np.ndarray:
        i = at + shift
        inside = (i >= first[owner]) & (i < past[owner])
        return np.where(inside, wide[np.where(inside, i, 0)], 0)

    code = (near(-2) << np.uint64(42)) | (near(-1) << np.uint64(21)) | near(0)
    slots = (mix64(code) >> np.uint64(64 - _BITS)).astype(np.int64)
    # All letters of a word have one script.
    scripts = np.full(len(first), SCRIPTS.index("Latin"))
    if script_of is not None and len(first):
        lettered = np.flatnonzero(letters > 0)
        scripts = script_of[lettered[np.searchsorted(lettered, first)]]
    return Words(slots, slot_ends, scripts, lengths, starts, ends,
                 np.searchsorted(starts, offsets))


# ---------------------------------------------------------------- model


@dataclass(frozen=True)
class Model:
    """Languages in alphabetical order, log-likelihoods by slot, and allowed scripts."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray
    penalty: float = SWITCH_PENALTY


def build_model(
    languages: Sequence[str], counts: np.ndarray, scripts: np.ndarray, penalty: float
) -> Model:
    """From trigram counts (language by slot) and word counts (language by script).

    A language is a candidate for a script if it has a hundredth of its words
    in it; scripts without candidates leave all languages open.
    """
    totals = counts.sum(1, keepdims=True)
    scores = np.log((counts + _SMOOTHING) / (totals + _SMOOTHING * counts.shape[1]))
    words = np.maximum(scripts.sum(1, keepdims=True), 1)
    allowed = scripts / words >= 0.01
    allowed[:, ~allowed.any(0)] = True
    return Model(tuple(languages), scores.T.astype(np.float32).copy(), allowed.T.copy(), penalty)


def word_scores(model: Model, words: Words) -> np.ndarray:
    """Log-likelihood of each word in each language, minus infinity where the script rules it out."""
    n, k = len(words.lengths), len(model.languages)
    if not n:
        return np.zeros((0, k))
    begin = np.concatenate([[0], words.slot_ends[:-1]])
    scores = np.add.reduceat(model.scores[words.slots], begin, axis=0).astype(np.float64)
    scores[~model.allowed[words.scripts]] = -1e6
    return scores


def best_languages(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi path of each row; all rows go one word at a time together."""
    n, k = scores.shape
    sizes = np.diff(offsets)
    path = np.zeros(n, np.int64)
    settled = _constant(scores, offsets, penalty)
    path[:] = np.repeat(settled, sizes)
    open_rows = np.flatnonzero((settled < 0) & (sizes > 0))
    order = open_rows[np.argsort(-sizes[open_rows], kind="stable")]
    if not len(order):
        return path
    starts, lengths = offsets[:-1][order], sizes[order]
    deepest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(deepest), "left")
    back = np.zeros((n, k), np.min_scalar_type(k))
    best = scores[starts].copy()
    for t in range(1, deepest):
        m = active[t]
        now = best[:m]
        top = now.argmax(1)
        jump = now[np.arange(m), top] - penalty
        stay = now >= jump[:, None]
        at = starts[:m] + t
        back[at] = np.where(stay, np.arange(k), top[:, None])
        best[:m] = np.where(stay, now, jump[:, None]) + scores[at]
    state = best.argmax(1)
    for t in range(deepest - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        path[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return path


def _constant(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The language of rows whose best path has no switch, -1 where that is not certain.

    If no run of words prefers another language to the row's best one by half
    the penalty, no switch can pay: a path of k spans has k - 1 switches and
    gains less than half a penalty in each of its spans.
    """
    k = scores.shape[1]
    sums = np.concatenate([np.zeros((1, k)), np.cumsum(scores, axis=0)])
    totals = sums[offsets[1:]] - sums[offsets[:-1]]
    best = totals.argmax(1)
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes > 0)
    settled = np.where(sizes > 0, best, -1)
    if not len(full):
        return settled
    own = np.repeat(best, sizes)
    gain = scores - scores[np.arange(len(scores)), own][:, None]
    # Best run that ends at each word, by the least prefix sum before it. Rows
    # are kept apart by steps larger than any sum.
    row = np.repeat(np.arange(len(sizes)), sizes)
    prefix = np.cumsum(gain, axis=0)
    start = offsets[:-1][full]
    base = np.zeros((len(sizes), k))
    base[full] = np.where(start[:, None] > 0, prefix[np.maximum(start - 1, 0)], 0.0)
    prefix -= base[row]
    step = 2 * (np.abs(prefix).max() + 1)
    before = np.zeros_like(prefix)
    before[1:] = prefix[:-1]
    before[start] = 0.0
    least = np.minimum.accumulate(before - step * row[:, None], axis=0) + step * row[:, None]
    worst = np.maximum.reduceat((prefix - least).max(1), start)
    settled[full] = np.where(worst < penalty / 2, best[full], -1)
    return settled


# ---------------------------------------------------------------- on Spark


def fit(
    df: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    limit: int = TRAIN_DOCUMENTS,
    penalty: float = SWITCH_PENALTY,
) -> Model:
    """Learn from at most ``limit`` rows of each language among those where ``learn`` holds.

    Rows with a null language, and those without letters, teach nothing. The
    choice is by hash of the key. Trigrams are counted by tasks; the driver
    gets sums per language and task.
    """
    usable = df.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    # Keys and languages alone; at most ``limit`` per language come out, and
    # Spark keeps no more than that per task before the shuffle.
    chosen = (
        usable.select(F.col(key).alias("key"), F.col(lang).alias("lang"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= limit)
        .select("key", "lang")
        .distinct()
    )
    rows = usable.select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).join(F.broadcast(chosen), ["key", "lang"])

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for part in slices(batches, "text"):
            words = read_words(*text_buffer(part.column("text")))
            names = part.column("lang").to_pylist()
            begin = np.concatenate([[0], words.slot_ends])
            for row, name in enumerate(names):
                a, b = words.offsets[row], words.offsets[row + 1]
                if name not in counts:
                    counts[name] = np.zeros(1 << _BITS, np.int64)
                    scripts[name] = np.zeros(len(SCRIPTS), np.int64)
                counts[name] += np.bincount(words.slots[begin[a] : begin[b]], minlength=1 << _BITS)
                scripts[name] += np.bincount(words.scripts[a:b], minlength=len(SCRIPTS))
        for name in counts:
            used = np.flatnonzero(counts[name])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(used) + len(SCRIPTS))),
                    pa.array(np.concatenate([used, -1 - np.arange(len(SCRIPTS))])),
                    pa.array(np.concatenate([counts[name][used], scripts[name]])),
                ],
                names=["lang", "slot", "n"],
            )

    found = (
        rows.select("lang", "text")
        .mapInArrow(mapper, "lang string, slot long, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), 1 << _BITS))
    scripts = np.zeros((len(languages), len(SCRIPTS)))
    where = found["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    slot, n = found["slot"].to_numpy(np.int64), found["n"].to_numpy(np.float64)
    is_slot = slot >= 0
    counts[where[is_slot], slot[is_slot]] = n[is_slot]
    scripts[where[~is_slot], -1 - slot[~is_slot]] = n[~is_slot]
    return build_model(languages, counts, scripts, penalty)


SPAN_TYPE = "array<struct<lang: string, start: int, end: int>>"


def identify(
    df: DataFrame, model: Model, keep: Sequence[str], text: str = "text", spans: bool = False
) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score``; with ``spans`` also the spans.

    ``lang_pred`` has most letters of the text, ties going to the first in the
    alphabet; it is ``und`` with score 0 for null, empty or letterless texts
    and for a model without languages. ``score`` is the share of letters in
    words of that language. Spans are UTF-8 byte ranges of words of one
    language, without white space at their ends. New columns that ``keep`` has
    already get underscores in front.
    """
    added = [("lang_pred", "string"), ("score", "double")]
    kept = keeping(df, keep, text, added + ([("spans", SPAN_TYPE)] if spans else []))
    names, read = kept.names, kept.value
    languages = [*model.languages, UNKNOWN]
    k = len(model.languages)

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, read, 1 << 19):
            data, offsets = text_buffer(part.column(read))
            words = read_words(data, offsets)
            sizes = np.diff(words.offsets)
            row = np.repeat(np.arange(part.num_rows), sizes)
            share = np.zeros((part.num_rows, k + 1))
            path = np.full(len(row), k)
            if k:
                scores = word_scores(model, words)
                path = best_languages(scores, words.offsets, model.penalty)
                np.add.at(share, (row, path), words.lengths)
            whole = share.sum(1)
            pred = np.where(whole > 0, share.argmax(1), k)
            score = share[np.arange(len(pred)), pred] / np.maximum(whole, 1)
            new = [pa.array([languages[p] for p in pred], pa.string()), pa.array(score)]
            if spans:
                new.append(_spans(words, path, row, offsets, languages))
            yield kept_batch(part, names, *new)

    return kept.source.mapInArrow(mapper, kept.schema)


def _spans(
    words: Words, path: np.ndarray, row: np.ndarray, offsets: np.ndarray, languages: Sequence[str]
) -> pa.Array:
    first = np.ones(len(path), bool)
    first[1:] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(first)
    tail = np.append(head[1:], len(path)) - 1 if len(head) else head
    base = offsets[row[head]]
    per_row = np.bincount(row[head], minlength=len(offsets) - 1)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()),
        pa.StructArray.from_arrays(
            [
                pa.array([languages[p] for p in path[head]], pa.string()),
                pa.array(words.starts[head] - base, pa.int32()),
                pa.array(words.ends[tail] - base, pa.int32()),
            ],
            names=["lang", "start", "end"],
        ),
    )
