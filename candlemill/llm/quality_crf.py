"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's state depends on its own features, on
those of the lines before and after it, and on the states next to it. Labels
exist for documents only, so in training each line has its document's label.
A document's quality is the average probability of its lines being good
(forward-backward marginals), weighted by line length and calibrated by a
logistic curve on the training documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import (
    kept_batch,
    keeping,
    map_lean,
    mix64,
    slices,
    span_hashes,
    text_buffer,
    word_hashes,
    word_spans,
)

# Labelled documents that training uses at most, chosen by a hash of the key.
TRAIN_DOCUMENTS = 4_000
_STEPS = 150
_PENALTY = 1e-3

BASE_FEATURES = (
    "letters", "capitals", "digits", "symbols", "shouts", "bars", "stops", "wide", "distinct",
    "new_words", "repeated", "length", "word_length", "long_words",
)


# ---------------------------------------------------------------- features


@dataclass(frozen=True)
class Lines:
    """Features of non-blank lines, their lengths in bytes, and where documents begin."""

    features: np.ndarray
    lengths: np.ndarray
    offsets: np.ndarray


def _first_seen(keys: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(keys), bool)
    seen[np.unique(keys, return_index=True)[1]] = True
    return seen


def line_features(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Features of the lines of documents given as bytes; lines without words are left out."""
    starts, ends, first_word = word_spans(data, offsets)
    n_docs = len(offsets) - 1
    width = 3 * len(BASE_FEATURES) + 1
    if not len(starts):
        return Lines(np.zeros((0, width), np.float32), np.zeros(0), np.zeros(n_docs + 1, np.int64))
    breaks = np.union1d(np.flatnonzero(data == 0x0A) + 1, offsets)
    line_of_word = np.searchsorted(breaks, starts, "right") - 1
    used, word_line = np.unique(line_of_word, return_inverse=True)
    begin, end = breaks[used], np.append(breaks, len(data))[used + 1]
    n_lines = len(used)
    first = np.searchsorted(word_line, np.arange(n_lines))
    past = np.append(first[1:], len(starts))
    n_words = (past - first).astype(np.float64)
    line_offsets = np.searchsorted(begin, offsets)
    line_doc = np.searchsorted(line_offsets, np.arange(n_lines), "right") - 1
    length = (end - begin).astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[end] - sums[begin]) / length

    def class_of(text: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(text)] = True
        return table[data]

    upper = (data >= 0x41) & (data <= 0x5A)
    lower = (data >= 0x61) & (data <= 0x7A)
    high = data >= 0x80
    up, low = share(upper), share(lower)
    hashes = word_hashes(data, starts, ends)
    per_line = mix64(hashes ^ mix64(word_line.astype(np.uint64)))
    per_doc = mix64(hashes ^ mix64(line_doc[word_line].astype(np.uint64) + np.uint64(1 << 40)))
    whole = span_hashes(hashes, first, past) ^ mix64(line_doc.astype(np.uint64))
    word_bytes = (ends - starts).astype(np.float64)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float64), first) / n_words

    base = np.column_stack(
        [
            up + low + share(high),
            up / np.maximum(up + low, 1e-9),
            share((data >= 0x30) & (data <= 0x39)),
            share(class_of(b"#$%&*@^~<>{}[]=+_\\/")),
            share(class_of(b"!?")),
            share(class_of(b"|")),
            share(class_of(b".,;:")),
            share(high),
            mean(_first_seen(per_line)),
            mean(_first_seen(per_doc)),
            ~_first_seen(whole),
            np.log1p(length) / 8,
            np.minimum(mean(word_bytes), 40) / 10,
            mean(word_bytes > 14),
        ]
    ).astype(np.float32)
    before, after = np.zeros_like(base), np.zeros_like(base)
    same = line_doc[1:] == line_doc[:-1]
    before[1:][same] = base[:-1][same]
    after[:-1][same] = base[1:][same]
    ones = np.ones((n_lines, 1), np.float32)
    return Lines(np.hstack([ones, base, before, after]), length, line_offsets)


# ---------------------------------------------------------------- the field


def forward_backward(
    unary: np.ndarray, switch: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each line, summed pair marginals, and the log partition sum.

    ``unary`` has a score per line and state, ``switch`` per pair of states.
    All documents go one line at a time together, the longest first.
    """
    n_docs, n = len(offsets) - 1, len(unary)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    alpha, beta = np.array(unary, np.float64), np.zeros((n, 2))
    deepest = int(lengths[0]) if n_docs else 0
    active = np.searchsorted(-lengths, -np.arange(deepest), "left")  # lengths > t

    def merged(scores: np.ndarray) -> np.ndarray:
        return np.logaddexp(scores[:, 0], scores[:, 1])

    for t in range(1, deepest):
        at = starts[: active[t]] + t
        for s in (0, 1):
            alpha[at, s] += merged(alpha[at - 1] + switch[:, s])
    for t in range(deepest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        ahead = unary[at + 1] + beta[at + 1]
        for s in (0, 1):
            beta[at, s] = merged(ahead + switch[s])
    has = lengths > 0
    total = np.zeros(n_docs)
    total[order[has]] = merged(alpha[starts[has] + lengths[has] - 1])
    per_line = np.repeat(total, np.diff(offsets))
    marginals = np.exp(alpha + beta - per_line[:, None])
    inner = np.ones(n, bool)
    inner[offsets[:-1][np.diff(offsets) > 0]] = False
    later = np.flatnonzero(inner)
    pairs = np.exp(
        alpha[later - 1][:, :, None]
        + switch
        + (unary[later] + beta[later])[:, None, :]
        - per_line[later][:, None, None]
    ).sum(0)
    return marginals, pairs, float(total.sum())


@dataclass(frozen=True)
class Model:
    """Feature scaling, state scores, switching scores, calibration, and the base rate."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    switch: np.ndarray
    slope: float
    shift: float
    base_rate: float


def _unary(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    good = x @ weights
    return np.column_stack([np.zeros(len(good)), good])


def _weighted(good: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, base: float):
    sums = np.concatenate([[0.0], np.cumsum(good * lengths)])
    weight = np.concatenate([[0.0], np.cumsum(lengths)])
    top, under = (s[offsets[1:]] - s[offsets[:-1]] for s in (sums, weight))
    return np.where(under > 0, top / np.maximum(under, 1e-9), base)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def train(lines: Lines, labels: np.ndarray) -> Model:
    """Fit on documents with labels 0 and 1; one missing class gives a constant model.

    Both classes weigh the same, so that the rarer one is not lost.
    """
    width = lines.features.shape[1]
    base = float(labels.mean()) if len(labels) else 0.5
    zero = Model(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)), 0.0,
                 float(_logit(np.array(base))), base)
    if not len(labels) or base in (0.0, 1.0) or not len(lines.features):
        return zero
    x = lines.features.astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    mean[0], scale[0] = 0.0, 1.0
    x = (x - mean) / scale
    sizes = np.diff(lines.offsets)
    y = np.repeat(labels, sizes).astype(np.int64)
    inner = np.ones(len(x), bool)
    inner[lines.offsets[:-1][sizes > 0]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner], y[inner]), 1)
    params = np.zeros(width + 4)
    step, square = np.zeros_like(params), np.zeros_like(params)
    for i in range(1, _STEPS + 1):
        weights, switch = params[:width], params[width:].reshape(2, 2)
        marginals, pairs, _ = forward_backward(_unary(x, weights), switch, lines.offsets)
        slope = np.concatenate([x.T @ (y - marginals[:, 1]), (seen - pairs).ravel()]) / len(x)
        slope -= _PENALTY * params
        step = 0.9 * step + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        params += 0.1 * (step / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    weights, switch = params[:width], params[width:].reshape(2, 2)
    marginals, _, _ = forward_backward(_unary(x, weights), switch, lines.offsets)
    raw = _logit(_weighted(marginals[:, 1], lines.lengths, lines.offsets, base))
    slope, shift = _calibrated(raw, labels)
    return Model(mean, scale, weights, switch, slope, shift, base)


def _calibrated(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton's method with a light pull towards slope 1."""
    theta = np.array([1.0, 0.0])
    design = np.column_stack([raw, np.ones(len(raw))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ theta))
        slope = design.T @ (labels - p) - (theta - [1.0, 0.0])
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        theta = theta + np.linalg.solve(curve, slope)
    return float(theta[0]), float(theta[1])


def score(model: Model, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Quality of each document and the probability that each line is good."""
    x = (lines.features - model.mean) / model.scale
    marginals, _, _ = forward_backward(_unary(x, model.weights), model.switch, lines.offsets)
    raw = _weighted(marginals[:, 1], lines.lengths, lines.offsets, model.base_rate)
    quality = 1 / (1 + np.exp(-(model.slope * _logit(raw) + model.shift)))
    # Sums depend a little on what else is in a batch; equal texts score alike.
    return np.round(quality, 10), marginals[:, 1]


# ---------------------------------------------------------------- on Spark


def fit(
    df: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    limit: int = TRAIN_DOCUMENTS,
) -> Model:
    """Train on at most ``limit`` labelled documents for which ``learn`` holds.

    The choice is by hash of the key, so it is the same on every run. Rows with
    a null key or a label other than 0 and 1 are not used; of repeated labels
    of a key the smallest counts. Features are made by tasks; the driver gets
    those of the chosen documents alone.
    """
    usable = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .where("label IN (0, 1) AND key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("label").alias("label"))
    )
    learnable = df.where(learn).select(F.col(key).alias("key"), F.col(text).alias("text"))
    # The choice joins keys alone; at most ``limit`` rows come out of it, so
    # they can be broadcast to the scan of the texts.
    chosen = (
        learnable.select("key")
        .join(usable, "key")
        .orderBy(F.xxhash64("key"), "key")
        .limit(limit)
    )
    rows = learnable.join(F.broadcast(chosen.distinct()), "key")

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lines = line_features(*text_buffer(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    part.column("label").cast(pa.int32()),
                    _binary_rows(lines.features.astype(np.float32), lines.offsets),
                    _binary_rows(lines.lengths.astype(np.float32)[:, None], lines.offsets),
                ],
                names=["key", "label", "features", "lengths"],
            )

    kind = df.schema[key].dataType.simpleString()
    columns = f"key {kind}, label int, features binary, lengths binary"
    found = (
        map_lean(rows.select("key", "label", "text"), mapper, columns)
        .toPandas()
        .sort_values("key", kind="stable")
    )
    width = 3 * len(BASE_FEATURES) + 1
    parts = [np.frombuffer(b, np.float32).reshape(-1, width) for b in found["features"]]
    sizes = [np.frombuffer(b, np.float32) for b in found["lengths"]]
    lines = Lines(
        np.concatenate(parts) if parts else np.zeros((0, width), np.float32),
        np.concatenate(sizes).astype(np.float64) if sizes else np.zeros(0),
        np.cumsum([0, *map(len, parts)]),
    )
    return train(lines, found["label"].to_numpy(np.float64))


def _binary_rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary())


def score_documents(
    df: DataFrame, model: Model, keep: Sequence[str], text: str = "text", lines: bool = False
) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1); with ``lines`` also ``good``, one value a line.

    Lines without words have no value. Null, empty and blank texts score like
    the average training document. New columns that ``keep`` has already get
    underscores in front.
    """
    added = [("score", "double")] + ([("good", "array<double>")] if lines else [])
    kept = keeping(df, keep, text, added)
    names, read = kept.names, kept.value

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, read):
            found = line_features(*text_buffer(part.column(read)))
            scores, good = score(model, found)
            new = [pa.array(scores)]
            if lines:
                ends = pa.array(found.offsets, pa.int32())
                new.append(pa.ListArray.from_arrays(ends, pa.array(good)))
            yield kept_batch(part, names, *new)

    return map_lean(kept.source, mapper, kept.schema)
