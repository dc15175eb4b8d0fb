"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A leaf is a sentence, or up to 32 code points of a long one; a paragraph ends
at a line end, a section at an empty line. A node's hash covers its children,
so equal roots mean equal texts and equal nodes need no look below them. The
fingerprint is text: the root, then short leaf hashes with leaf lengths, from
which the tree is built again to say how alike two texts are and where they
differ.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.llm.common import kept_batch, keeping, slices

# Every code point is in one leaf; no leaf has more than 153 code points.
_LEAF = re.compile(r"[^.!?\n]{1,32}[.!?]{0,60}[ \t]{0,60}\n?|[.!?]{1,60}[ \t]{0,60}\n?|\n")
# In a fingerprint a leaf takes 8 digits of hash and 2 of length.
_LEAF_DIGITS = 10


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str, memo: dict[str, bytes] | None = None) -> str:
    """Root and leaves as text: ``root:`` leaves, ``.`` after a paragraph, ``/`` after a section.

    ``memo`` keeps leaf hashes between texts that share leaves.
    """
    memo = {} if memo is None else memo
    sections, paragraphs, leaves, out = [], [], [], []

    def close_section() -> None:
        sections.append(_digest(b"".join(paragraphs)))
        paragraphs.clear()
        out.append("/")

    def close_paragraph() -> None:
        paragraphs.append(_digest(b"".join(leaves)))
        leaves.clear()
        out.append(".")

    for leaf in _LEAF.findall(text):
        found = memo.get(leaf)
        if found is None:
            found = memo[leaf] = _digest(leaf.encode("utf-8", "surrogatepass"))
        blank = leaf == "\n" and not leaves
        leaves.append(found)
        out.append(f"{found[:4].hex()}{len(leaf):02x}")
        if leaf[-1] == "\n":
            close_paragraph()
            if blank:
                close_section()
    if leaves:
        close_paragraph()
    if paragraphs:
        close_section()
    return _digest(b"".join(sections)).hex() + ":" + "".join(out)


@dataclass(frozen=True)
class Node:
    """A section, paragraph or leaf: what it holds, and its length in code points."""

    content: str
    length: int
    children: tuple[Node, ...]


def tree(print_: str) -> Node:
    """The tree that a fingerprint describes."""

    def leaf(text: str) -> Node:
        return Node(text, int(text[8:], 16), ())

    def parent(text: str, children: Iterator[Node]) -> Node:
        own = tuple(children)
        return Node(text, sum(c.length for c in own), own)

    def leaves(text: str) -> Iterator[Node]:
        return (leaf(text[i : i + _LEAF_DIGITS]) for i in range(0, len(text), _LEAF_DIGITS))

    def paragraphs(text: str) -> Iterator[Node]:
        return (parent(p, leaves(p)) for p in text.split(".")[:-1])

    body = print_.partition(":")[2]
    return parent(body, (parent(s, paragraphs(s)) for s in body.split("/")[:-1]))


def likeness(a: str, b: str) -> float:
    """Share of both texts that lies in equal branches, 0 to 1; two empty texts are equal.

    Equal sections count as a whole, then equal paragraphs of the others, then
    equal leaves, wherever they stand and as often as both texts have them.
    """
    if a == b:
        return 1.0
    left, right = [tree(a)], [tree(b)]
    total = left[0].length + right[0].length
    shared = 0
    while left and right:
        left = [c for n in left for c in n.children]
        right = [c for n in right for c in n.children]
        both = Counter(n.content for n in left) & Counter(n.content for n in right)
        left, common = _without(left, both)
        right, _ = _without(right, both)
        shared += common
    return 2 * shared / total if total else 1.0


def _without(nodes: list[Node], drop: Counter) -> tuple[list[Node], int]:
    rest, left, length = [], Counter(drop), 0
    for node in nodes:
        if left[node.content] > 0:
            left[node.content] -= 1
            length += node.length
        else:
            rest.append(node)
    return rest, length


def differences(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Stretches that differ, as start and end in the first text and in the second.

    Found by going down differing branches alone: equal children at both ends
    of a branch are passed over, and a single differing child is entered.
    """

    def compare(x: Node, y: Node, at_x: int, at_y: int) -> list[tuple[int, int, int, int]]:
        if x.content == y.content:
            return []
        p, q = list(x.children), list(y.children)
        while p and q and p[0].content == q[0].content:
            at_x, at_y = at_x + p.pop(0).length, at_y + q.pop(0).length
        while p and q and p[-1].content == q[-1].content:
            p.pop(), q.pop()
        if len(p) == len(q) and p and p[0].children and q[0].children:
            found = []
            for c, d in zip(p, q):
                found += compare(c, d, at_x, at_y)
                at_x, at_y = at_x + c.length, at_y + d.length
            return found
        end_x = at_x + sum(c.length for c in p)
        return [(at_x, end_x, at_y, at_y + sum(c.length for c in q))]

    return compare(tree(a), tree(b), 0, 0)


def fingerprints(df: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``fingerprint`` of each row; null texts count as empty.

    ``fingerprint`` gets underscores in front if ``keep`` has that name.
    """
    kept = keeping(df, keep, text, [("fingerprint", "string")])
    names, read = kept.names, kept.value

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, read):
            prints = [fingerprint(t or "") for t in part.column(read).to_pylist()]
            yield kept_batch(part, names, pa.array(prints, pa.string()))

    return kept.source.mapInArrow(mapper, kept.schema)


# ---------------------------------------------------------------- neighbours


def _range_number(key: str, bounds: Sequence) -> Column:
    """How many bounds lie below the key; nulls come first."""
    if not bounds:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(key))
    return F.coalesce(F.size(below), F.lit(0))


def in_neighbour_order(df: DataFrame, key: str) -> DataFrame:
    """Rows by falling ``key`` within ranges of it, each followed by the next range's first row.

    Adds ``range`` and ``copy`` (0: the row itself, 1: a copy that only serves
    as a neighbour). The lowest range is followed by the first row of all. One
    shuffle of the rows; the driver sees one key per range, and there are four
    times as many ranges as shuffle partitions. Ties go by all other columns.
    """
    spark = df.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = df.stat.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n)
    ranged = df.withColumn("range", _range_number(key, sorted({int(b) for b in found})))
    tops = sorted(
        (r["range"], r["top"])
        for r in ranged.groupBy("range").agg(F.max(key).alias("top")).collect()
    )
    # The first rows of a range also go to the range above it, those of the
    # highest to the lowest.
    rows = [(r, top, tops[(i + 1) % len(tops)][0]) for i, (r, top) in enumerate(tops)]
    kind = T.StructType(
        [
            T.StructField("range", T.IntegerType()),
            T.StructField("_top", df.schema[key].dataType),
            T.StructField("_to", T.IntegerType()),
        ]
    )
    places = F.when(
        F.col(key).eqNullSafe(F.col("_top")),
        F.array(
            F.struct(F.col("range"), F.lit(0).alias("copy")),
            F.struct(F.col("_to").alias("range"), F.lit(1).alias("copy")),
        ),
    ).otherwise(F.array(F.struct(F.col("range"), F.lit(0).alias("copy"))))
    placed = ranged.join(F.broadcast(spark.createDataFrame(rows, kind)), "range").select(
        *[F.col(f"`{c}`") for c in df.columns], F.explode(places).alias("_place")
    )
    others = [c for c in df.columns if c != key]
    return (
        placed.select(*df.columns, "_place.range", "_place.copy")
        .repartition("range")
        .sortWithinPartitions("range", "copy", F.desc_nulls_last(key), *others)
    )


def compare_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of an edited one, and how like they and the next are.

    The next text is that of the next smaller ``key`` (after the smallest: of
    the largest; ties go by text, null keys come last). The edited text swaps
    the last third of the code points, rounded down, for as many from the start
    of the next text, or all it has. Null texts count as empty. Returns key,
    n_chars, edited (the text), fingerprint, edited_fingerprint, near_edited,
    near_next; an empty table gives an empty result.
    """
    rows = in_neighbour_order(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key")
    kind = df.schema[key].dataType.simpleString()

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # key, text, fingerprint, memo of the row whose next one comes now
        where = None
        for part in slices(batches, "text"):
            out = []
            for place, copy, key_, body in zip(
                *(part.column(c).to_pylist() for c in ("range", "copy", "key", "text"))
            ):
                body = body or ""
                if place != where:
                    before, where = None, place
                if copy and before is None:
                    continue
                memo: dict[str, bytes] = {}
                print_ = fingerprint(body, memo)
                if before is not None:
                    out.append(_compared(*before, body, print_, memo))
                before = None if copy else (key_, body, print_, memo)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, t) for column, t in zip(zip(*out), types(part))],
                    names=[*names],
                )

    names = ["key", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited",
             "near_next"]

    def types(part: pa.RecordBatch) -> list[pa.DataType]:
        text_ = pa.string()
        return [part.schema.field("key").type, pa.int64(), text_, text_, text_, pa.float64(),
                pa.float64()]

    compared = rows.mapInArrow(
        mapper,
        f"key {kind}, n_chars long, edited string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
    return compared.withColumnRenamed("key", key)


def _compared(key, text, print_, memo, next_text, next_print, next_memo) -> tuple:
    swapped = len(text) // 3
    edited = text[: len(text) - swapped] + next_text[:swapped]
    edited_print = fingerprint(edited, {**next_memo, **memo})
    return (
        key, len(text), edited, print_, edited_print,
        likeness(print_, edited_print), likeness(print_, next_print),
    )
