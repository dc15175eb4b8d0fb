"""Exact search of the k largest inner products, with a uniform threshold in three phases.

The components of all vectors are split into lists, each of which knows only
its part of every score.

1. Each list gives its k best partial scores per query. The k-th best full
   score of these few candidates is a cutoff that no result can be below.
2. A candidate whose parts are all below ``cutoff / lists`` is below the
   cutoff. So each list gives the entries at or above that, and no other
   candidate can be a result.
3. Scores of candidates that not every list has given are completed, and the
   best are ranked.

Queries and candidates meet in the cells of a grid, whose side grows with the
table so that cells keep their size. The lists of a cell are in one task, so
only cutoffs and few candidates per cell travel. Equal vectors are one
candidate and one query, so a vector with very many copies costs no more than
another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.session import stage

LISTS = 2
CELL_ROWS = 16_000
# Queries of a cell that are scored together.
QUERY_ROWS = 256


# ---------------------------------------------------------------- inside a cell


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, missing components at the end as 0."""
    rows = column.combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.chunk(0)
    out = np.zeros((len(rows), width), np.int64)
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; in floating point where that is exact."""
    most = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _width(*tables: pa.Table) -> int:
    sizes = [pc.max(pc.list_value_length(t["part"])).as_py() for t in tables if t.num_rows]
    return max([s for s in sizes if s is not None], default=0)


_ENTRY = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("score", pa.int64())])
ENTRY_DDL = "q long, c long, score long"


def _partial_scores(left: pa.Table, right: pa.Table, lists: int):
    """Blocks of queries: their rows and each list's partial scores of all candidates."""
    width = _width(left, right)
    queries, vectors = _matrix(left["part"], width), _matrix(right["part"], width)
    cuts = [width * i // lists for i in range(lists + 1)]
    for start in range(0, len(queries), QUERY_ROWS):
        rows = slice(start, start + QUERY_ROWS)
        yield rows, [_products(queries[rows, a:b], vectors[:, a:b]) for a, b in zip(cuts, cuts[1:])]


def _best(q: np.ndarray, c: np.ndarray, score: np.ndarray, k: int) -> pa.Table:
    """The k best distinct candidates of each query, ties to the smaller id."""
    order = np.lexsort((c, -score, q))
    q, c, score = q[order], c[order], score[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, score = q[fresh], c[fresh], score[fresh]
    first = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
    return pa.table([pa.array(x[first]) for x in (q, c, score)], schema=_ENTRY)


def _gather(k: int, lists: int):
    """Phase 1 in a cell: the k best of each list per query, with their full scores."""

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c = left["id"].to_numpy(), right["id"].to_numpy()
        n = min(k, len(c))
        out = [_ENTRY.empty_table()]
        for rows, parts in _partial_scores(left, right, lists) if n else ():
            whole = sum(parts)
            tops = [np.argpartition(-p, n - 1, axis=1)[:, :n] for p in parts]
            top = np.concatenate(tops, axis=1)
            asked = np.repeat(q[rows], top.shape[1])
            scores = np.take_along_axis(whole, top, 1).ravel()
            out.append(_best(asked, c[top].ravel(), scores, k))
        return pa.concat_tables(out)

    return cell


def _collect(k: int, lists: int):
    """Phases 2 and 3 in a cell: entries at the threshold of any list, completed and ranked."""

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c = left["id"].to_numpy(), right["id"].to_numpy()
        cutoff = pc.fill_null(left["cutoff"], -(1 << 62)).to_numpy()
        out = [_ENTRY.empty_table()]
        for rows, parts in _partial_scores(left, right, lists) if len(c) else ():
            given = np.zeros(parts[0].shape, bool)
            for part in parts:
                given |= part >= -(-cutoff[rows] // lists)[:, None]
            row, column = np.nonzero(given)
            scores = sum(part[row, column] for part in parts)
            enough = scores >= cutoff[rows][row]
            row, column = row[enough], column[enough]
            out.append(_best(q[rows][row], c[column], scores[enough], k))
        return pa.concat_tables(out)

    return cell


# ---------------------------------------------------------------- on Spark


def whole_components(vector: str | Column, factor: int = 64) -> Column:
    """``floor(factor * x)`` of each component as long, null unless all are finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(
        column,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(finite, F.transform(column, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _cell(name: str, id_: str, side: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(side)).cast("int").alias(name)


def _all_cells(name: str, side: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias(name)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "vector",
    lists: int = LISTS,
) -> DataFrame:
    """query_id, rank, ``key`` and score of each query's k highest scores among the other rows.

    ``vector`` is an array of whole numbers; scores are inner products. Ties go
    to the smaller key; queries with fewer other rows get all of them. Rows
    whose key is null or whose vector is null or holds nulls take no part.
    Components that a vector lacks at its end count as 0. Of rows that share a
    key, the smallest vector counts. An empty table gives an empty result. Runs
    jobs.
    """
    usable = df.select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("part"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(
        F.col("id").isNotNull() & F.col("part").isNotNull() & F.forall("part", lambda x: x.isNotNull())
    ).groupBy("id").agg(F.min("part").alias("part"), F.max("asks").alias("asks"))
    # Of equal vectors only the k + 1 smallest keys can be results.
    order = Window.partitionBy("part").orderBy("id")
    members = stage(
        usable.select("id", "part")
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1),
        "members",
    )
    vectors = stage(
        members.groupBy("part").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids")),
        "vectors",
    )
    asking = stage(
        usable.where("asks").select(F.col("id").alias("query_id"), "part")
        .join(vectors.select("part", "id"), "part"),
        "asking",
    )
    queries = asking.select("id", "part").distinct()
    n = vectors.count()
    side = max(1, -(-n // CELL_ROWS))
    candidates = vectors.select("id", "part")
    best = k + 1
    cells = ["gq", "gc"]
    dealt = candidates.select("id", "part", _cell("gc", "id", side), _all_cells("gq", side))

    def meet(asked: DataFrame, cell) -> DataFrame:
        left = asked.select("*", _cell("gq", "id", side)).select("*", _all_cells("gc", side))
        found = left.groupBy(*cells).cogroup(dealt.groupBy(*cells)).applyInArrow(cell, ENTRY_DDL)
        order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)

    gathered = meet(queries, _gather(best, lists)).where(F.col("rank") == best)
    cutoffs = stage(gathered.select(F.col("q").alias("id"), F.col("score").alias("cutoff")), "cutoffs")
    with_cutoffs = queries.join(cutoffs, "id", "left")
    found = stage(meet(with_cutoffs, _collect(best, lists)).select("q", "c", "score"), "found")

    results = (
        asking.select("query_id", F.col("id").alias("q"))
        .join(found, "q")
        .join(vectors.select(F.col("id").alias("c"), F.explode("ids").alias("vec")), "c")
        .where("vec <> query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec")
    return (
        results.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec").alias(key), "score")
    )
