"""Vector compression to one code per part of a vector.

A vector is cut into consecutive parts, and each part position has a codebook
that a few rounds of assignment and averaging fit. Equal parts are assigned
once. The distinct parts of a position are a trie, dimension by dimension: a
node has one accumulated squared distance for each codebook entry, so parts
with a common beginning share that work. The trie is never built. Parts are
sorted, a subtree is a run of them, and runs are walked depth first; a run
that is short enough is finished level by level with one row of distances per
node. At the leaves the nearest entry is taken, and parts are summed by entry
with their weights.

A round adds up sums per entry inside tasks; the driver sees codebooks only,
whose size does not depend on the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import unclashing
from candlemill.llm.topk import whole_components
from candlemill.session import stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
FACTOR = 1024
# Leaves of a run that is finished level by level: what bounds the memory.
RUN_LEAVES = 2_048
# Components from which 64 bits may not hold a squared distance.
_EXACT_BELOW = 1 << 27


# ---------------------------------------------------------------- the trie


def _nodes(rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """First row of each distinct prefix of ``depth + 1`` values, and the prefix of each row."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, : depth + 1] != rows[:-1, : depth + 1]).any(axis=1)
    return np.flatnonzero(new), np.cumsum(new) - 1


def _finish(rows: np.ndarray, depth: int, shared: np.ndarray, entries: np.ndarray):
    """Nearest entry and distance of each row of a run that agrees in ``depth`` values."""
    distance = shared[None, :]
    parent = np.zeros(len(rows), np.int64)
    for d in range(depth, rows.shape[1]):
        first, own = _nodes(rows, d) if len(distance) < len(rows) else (slice(None), parent)
        step = rows[first, d][:, None] - entries[None, :, d]
        step *= step
        step += distance[parent[first]] if len(distance) < len(rows) else distance
        distance, parent = step, own
    if len(distance) < len(rows):  # equal rows
        distance = distance[parent]
    best = distance.argmin(axis=1)  # the lower index of equal ones
    return best, np.take_along_axis(distance, best[:, None], 1)[:, 0]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and squared distance of each row; rows are sorted.

    Subtrees of the trie that the rows make are walked depth first. ``entries``
    must not be empty.
    """
    best = np.zeros(len(rows), np.int64)
    far = np.zeros(len(rows), rows.dtype)
    stack = [(0, len(rows), 0, np.zeros(len(entries), rows.dtype))] if len(rows) else []
    while stack:
        start, stop, depth, shared = stack.pop()
        if stop - start <= RUN_LEAVES or depth == rows.shape[1]:
            for a in range(start, stop, RUN_LEAVES):
                b = min(a + RUN_LEAVES, stop)
                best[a:b], far[a:b] = _finish(rows[a:b], depth, shared, entries)
            continue
        values = rows[start:stop, depth]
        edges = [start, *(np.flatnonzero(values[1:] != values[:-1]) + start + 1), stop]
        below = []
        for a, b in zip(edges, edges[1:]):
            if b - a > RUN_LEAVES:  # a subtree of its own
                step = rows[a, depth] - entries[:, depth]
                below.append((a, b, depth + 1, shared + step * step))
            elif below and below[-1][2] == depth and b - below[-1][0] <= RUN_LEAVES:
                below[-1] = (below[-1][0], b, depth, shared)  # beside its smaller siblings
            else:
                below.append((a, b, depth, shared))
        stack += reversed(below)
    return best, far


def _sorted_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the one that each given row is."""
    if rows.shape[1] == 0 or not len(rows):
        return rows[:1], np.zeros(len(rows), np.int64)
    order = np.lexsort(rows.T[::-1])
    ranked = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    which = np.empty(len(rows), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], which


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    """A list column as a matrix; all lists have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), dtype)


# ---------------------------------------------------------------- in tasks


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 16 * RUN_LEAVES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


_SUMS = pa.list_(pa.decimal128(38, 0))


def _round_mapper(saved, dtype: type):
    """Number and sum of the parts nearest to each entry, over all parts a task sees."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = saved.value.astype(dtype)
        sums, n = np.zeros(books.shape, dtype), np.zeros(books.shape[:2], dtype)
        for part in _slices(batches):
            position = part.column("position").to_numpy()
            rows = _matrix(part.column("part"), dtype)
            weight = part.column("weight").to_numpy().astype(dtype)
            for p in np.unique(position):
                here = position == p  # rows come in order of position and part
                best, _ = nearest(rows[here], books[p])
                np.add.at(n[p], best, weight[here])
                np.add.at(sums[p], best, rows[here] * weight[here][:, None])
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()),
                pa.array(e, pa.int32()),
                pa.array([int(x) for x in n[p, e]], pa.int64()),
                pa.array([[int(x) for x in row] for row in sums[p, e]], _SUMS),
            ],
            names=["position", "entry", "n", "sums"],
        )

    return mapper


def _code_mapper(saved, dtype: type, names: Sequence[str]):
    """Code and error of each vector; equal parts of a batch are looked up once."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = saved.value.astype(dtype)
        for batch in _slices(batches):
            vectors = _matrix(batch.column(batch.num_columns - 1), dtype)
            codes = np.zeros((len(vectors), len(books)), np.uint8)
            errors = np.zeros(len(vectors), dtype)
            for p, (rows, book) in enumerate(zip(np.split(vectors, len(books), axis=1), books)):
                distinct, which = _sorted_rows(rows)
                best, far = nearest(distinct, book)
                codes[:, p] = best[which]
                errors += far[which]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array([int(e) for e in errors], pa.int64()),
                ],
                names=list(names),
            )

    return mapper


# ---------------------------------------------------------------- on Spark


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and place, as decimal integers joined by commas."""
    return ",".join(str(int(x)) for x in books.reshape(-1))


def _updated(books: np.ndarray, found: DataFrame) -> np.ndarray:
    """Each entry becomes the floored mean of its parts; entries without parts stay."""
    totals = (
        found.select("position", "entry", "n", F.posexplode("sums").alias("place", "value"))
        .groupBy("position", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum("value").cast("decimal(38,0)").alias("value"))
        .collect()  # one row per component of the codebooks at most
    )
    out = books.copy()
    for position, entry, place, n, value in totals:
        out[position, entry, place] = int(value) // n
    return out


def fit(
    vectors: DataFrame,
    key: str,
    vector: str,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """Codebooks (part, entry, place) of whole-number vectors, all of one length.

    They start as the parts of the vectors with the smallest keys (of equal
    keys the smaller vector first, null keys last) and take ``rounds`` rounds.
    Fewer vectors than ``entries`` make fewer entries, none make none.
    """
    id_, whole = F.col(f"`{key}`"), F.col(f"`{vector}`")
    first = vectors.select(id_.alias("id"), whole.alias("v")).orderBy(F.asc_nulls_last("id"), "v")
    start = [row["v"] for row in first.limit(entries).collect()]
    sizes = vectors.agg(
        F.min(F.size(whole)).alias("low"), F.max(F.size(whole)).alias("high"),
        F.max(F.array_max(F.transform(whole, lambda x: F.abs(x.cast("decimal(20,0)"))))).alias(
            "largest"
        ),
    ).first()
    if not start:
        return np.zeros((parts, 0, 0), np.int64)
    width, odd = divmod(sizes["low"], parts)
    if sizes["low"] != sizes["high"] or odd:
        raise ValueError(f"vectors must have one length that {parts} divides")
    dtype = np.int64 if (sizes["largest"] or 0) < _EXACT_BELOW and width <= 256 else object
    books = np.array(start, dtype).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    if width == 0:
        return books
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice(whole, p * width + 1, width)
    )
    distinct = (
        vectors.select(F.posexplode(cut).alias("position", "part"))
        .groupBy("position", "part")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    # Neighbours in order share the most; equal parts are one row by now.
    runs = stage(
        distinct.repartitionByRange("position", "part").sortWithinPartitions("position", "part"),
        "parts",
    )
    context = vectors.sparkSession.sparkContext
    for _ in range(rounds):
        saved = context.broadcast(books)
        mapper = _round_mapper(saved, dtype)
        found = runs.mapInArrow(
            mapper, "position int, entry int, n long, sums array<decimal(38,0)>"
        )
        books = _updated(books, found)
        saved.unpersist()
    return books


def encode(
    vectors: DataFrame, keep: Sequence[str], vector: str, books: np.ndarray
) -> DataFrame:
    """``keep`` columns, code (two hex digits per part) and error (squared distances, summed).

    New columns that ``keep`` has already get underscores in front.
    """
    names = [unclashing(keep, "code")]
    names.append(unclashing([*keep, names[0]], "error"))
    kept = vectors.select(*[F.col(f"`{c}`") for c in keep])
    value = unclashing([*keep, *names], "_value")
    ddl = kept.schema.add(names[0], "string").add(names[1], "long")
    saved = vectors.sparkSession.sparkContext.broadcast(books)
    source = vectors.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{vector}`").alias(value))
    return source.mapInArrow(_code_mapper(saved, books.dtype.type, ddl.fieldNames()), ddl)


def compress(
    df: DataFrame,
    key: str = "vec_id",
    vector: str | Column = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``key``, code, error, label_error and codebooks_sha256 of each usable vector.

    Components become ``floor(1024 x)``; vectors that are null or hold a null
    or a component that is not finite are left out. ``code`` has two hex digits
    per part, ``error`` the squared distances to the entries, ``label_error``
    its sum over rows of equal labels (nulls together). Repeated rows count as
    often as they are there; rows with a null key are coded as well. Arithmetic
    is exact: components too large for 64 bits are computed as Python integers,
    which is slow; an error beyond a long fails. Vectors of different lengths,
    or of one that ``parts`` does not divide, raise. An empty table gives an
    empty result. Other columns play no part. Runs jobs.
    """
    whole = df.select(
        F.col(f"`{key}`").alias(key), F.col(f"`{label}`").alias("_label"),
        whole_components(vector, FACTOR).alias("_vector"),
    ).where(F.col("_vector").isNotNull())
    whole = stage(whole, "whole")
    books = fit(whole, key, "_vector", parts, entries, rounds)
    coded = stage(encode(whole, [key, "_label"], "_vector", books), "coded")
    names = coded.columns
    error = F.col(f"`{names[3]}`")
    totals = stage(
        coded.groupBy("_label").agg(F.sum(error).alias("total")).withColumnRenamed("_label", "of"),
        "errors",
    )
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return coded.join(totals, F.col("_label").eqNullSafe(F.col("of"))).select(
        F.col(f"`{key}`"),
        F.col(f"`{names[2]}`").alias("code"),
        error.alias("error"),
        F.col("total").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
    )
