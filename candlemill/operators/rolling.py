"""Rolling means and deviations whose cost does not depend on the number of rows.

Positions are cut into blocks of as many rows as the window has. The last rows
of a window are a prefix of its row's block, those before a suffix of the block
before; running counts, sums and squared deviations give both, and merging the
two gives the window. A sliding frame would visit every row of every window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlemill.functions.candle import rolling

# Rows from which blocks cost clearly less than a sliding frame: two more local
# sorts against a visit of each row. At 24 both cost the same (see the README).
BLOCKS_FROM = 48


@dataclass(frozen=True)
class Rolling:
    """``kind`` (mean or std) of the last ``rows`` values of ``column``.

    NULL until the window holds ``min_rows`` (default ``rows``) known values.
    """

    name: str
    kind: str
    column: str
    rows: int
    min_rows: int | None = None

    @property
    def enough(self) -> int:
        return self.rows if self.min_rows is None else self.min_rows


def _sliding(spec: Rolling, w: WindowSpec) -> Column:
    aggregate = F.avg if spec.kind == "mean" else F.stddev_samp
    return rolling(aggregate, F.col(spec.column), w, spec.rows, spec.min_rows)


def _moments(column: str, w: WindowSpec, squares: bool) -> list[Column]:
    x = F.col(column).cast("double")
    n = F.count(x).over(w)
    out = [n.alias("n"), F.coalesce(F.sum(x).over(w), F.lit(0.0)).alias("s")]
    if squares:
        out.append(F.coalesce(F.var_pop(x).over(w) * n, F.lit(0.0)).alias("q"))
    return out


def _merged(a: Column, b: Column, squares: bool) -> list[Column]:
    """Count, sum and squared deviations of two disjoint sets; ``b`` may be NULL."""
    n2 = F.coalesce(b["n"], F.lit(0).cast("long"))
    n, s = a["n"] + n2, a["s"] + F.coalesce(b["s"], F.lit(0.0))
    out = [n.alias("n"), s.alias("s")]
    if squares:
        apart = F.try_divide(a["s"], a["n"]) - F.try_divide(b["s"], n2)
        between = F.coalesce(apart * apart * F.try_divide(a["n"] * n2, n), F.lit(0.0))
        out.append((a["q"] + F.coalesce(b["q"], F.lit(0.0)) + between).alias("q"))
    return out


def _by_blocks(
    rows: DataFrame, partition: Sequence[str], position: str, size: int, specs: Sequence[Rolling]
) -> DataFrame:
    block = F.floor(F.col(position) / F.lit(size))
    in_block = Window.partitionBy(*partition, "_block")
    back, forth = in_block.orderBy(F.desc(position)), in_block.orderBy(position)
    whole = Window.partitionBy(*partition).orderBy("_block", position)
    squares = {s.column: any(t.kind == "std" for t in specs if t.column == s.column) for s in specs}
    suffix = F.struct(
        F.col("_block").alias("block"),
        *[F.struct(*_moments(c, back, q)).alias(f"m{i}") for i, (c, q) in enumerate(squares.items())],
    )
    # The window's first row, or the first one there is.
    first = F.coalesce(
        F.lag("_suffix", size - 1).over(whole),
        F.first("_suffix").over(whole.rowsBetween(Window.unboundedPreceding, 0)),
    )
    before = F.when(F.col("_first.block") < F.col("_block"), F.col("_first"))
    found = rows.withColumn("_block", block).withColumn("_suffix", suffix)
    found = found.withColumn("_first", first).withColumn("_before", before)
    columns = {}
    for i, (c, q) in enumerate(squares.items()):
        found = found.withColumn(f"_prefix{i}", F.struct(*_moments(c, forth, q)))
        merged = _merged(F.col(f"_prefix{i}"), F.col("_before")[f"m{i}"], q)
        found = found.withColumn(f"_window{i}", F.struct(*merged))
        n, s = F.col(f"_window{i}.n"), F.col(f"_window{i}.s")
        for spec in specs:
            if spec.column == c and spec.kind == "mean":
                columns[spec.name] = F.when(n >= max(1, spec.enough), F.try_divide(s, n))
            elif spec.column == c:
                spread = F.sqrt(F.try_divide(F.col(f"_window{i}.q"), n - 1))
                columns[spec.name] = F.when(n >= max(2, spec.enough), spread)
    used = [f"_{name}{i}" for name in ("prefix", "window") for i in range(len(squares))]
    return found.withColumns(columns).drop("_block", "_suffix", "_first", "_before", *used)


def add_rolling(
    rows: DataFrame,
    partition: Sequence[str],
    position: str,
    specs: Sequence[Rolling],
    blocks_from: int = BLOCKS_FROM,
) -> DataFrame:
    """``rows`` with the columns of ``specs``, over each partition in order of ``position``.

    Positions of a partition follow each other without holes. Windows of fewer
    than ``blocks_from`` rows slide; both ways give the same results.
    """
    w = Window.partitionBy(*partition).orderBy(position)
    slide = {s.name: _sliding(s, w) for s in specs if s.rows < blocks_from}
    out = rows.withColumns(slide) if slide else rows
    wide = sorted((s for s in specs if s.rows >= blocks_from), key=lambda s: s.rows)
    for size, group in groupby(wide, key=lambda s: s.rows):
        out = _by_blocks(out, partition, position, size, list(group))
    names = [s.name for s in specs]
    return out.select(*[c for c in out.columns if c not in names], *names)
