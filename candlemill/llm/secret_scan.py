"""Secret scans with one combined deterministic automaton.

Every rule is a regular expression over bytes. All rules together become one
automaton by subset construction, minimised to few states and byte classes and
laid out as one transition row per state. It reads a text backwards, once for
all rules, and tells at which bytes a match of which rule starts. From the
leftmost start of a rule its own forward automaton finds the longest end, and
the search goes on after it: leftmost, longest, non-overlapping spans per rule.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import kept_batch, keeping, map_lean, slices

# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    ``pattern`` knows literals, ``\\xHH`` and ``\\c`` escapes, classes with
    ranges, groups, ``|``, ``?``, ``*``, ``+``, ``{n}`` and ``{n,}``.
    ``any_case`` lets letters of the pattern's literals match in either case.
    A match is dropped, though its text stays used up, unless ``confirm``
    matches it whole.
    """

    kind: str
    pattern: str
    any_case: bool = False
    confirm: str = ""


# The rules of the scan. Counted repeats state the least length;
# `assign` is checked for it afterwards, since a match that is too short still
# uses up its text.
_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]"""
RULES = (
    Rule("assign", _ASSIGN + "+", any_case=True, confirm=_ASSIGN + "{6,}"),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further kinds. Lengths are checked afterwards here too, as counts
# of several rules at once would multiply the automaton's states.
_KEY_NAME = r"[A-Z\x20]*PRIVATE\x20KEY\-\-\-\-\-"
MORE_RULES = (
    Rule(
        "private",
        r"\-\-\-\-\-BEGIN\x20" + _KEY_NAME
        + r"([A-Za-z0-9+/=\x09\x0A\x0D\x20]*\-\-\-\-\-END\x20" + _KEY_NAME + ")?",
    ),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", confirm=r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeoprs]\-[A-Za-z0-9\-]+", confirm=r"xox[abeoprs]\-[A-Za-z0-9\-]{10,}"),
    Rule(
        "jwt",
        r"eyJ[A-Za-z0-9_\-]+[.][A-Za-z0-9_\-]+[.][A-Za-z0-9_\-]+",
        confirm=r"eyJ[A-Za-z0-9_\-]{8,}[.][A-Za-z0-9_\-]{8,}[.][A-Za-z0-9_\-]{8,}",
    ),
    Rule(
        "bearer", r"bearer\x20+[A-Za-z0-9._~+/=\-]+", any_case=True,
        confirm=r"bearer\x20+[A-Za-z0-9._~+/=\-]{20,}",
    ),
)
ALL_RULES = RULES + MORE_RULES

# ---------------------------------------------------------------- regex to automaton

# Syntax trees: ("set", bytes) | ("cat", parts) | ("alt", parts) | ("star", part)
EMPTY = ("cat", ())


class _Reader:
    """Recursive reader of the small pattern language above."""

    def __init__(self, pattern: str, any_case: bool):
        self.text, self.at, self.any_case = pattern, 0, any_case

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", tuple(parts))

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("cat", tuple(parts))

    def repeated(self, part):
        if not self.peek() or self.peek() not in "?*+{":
            return part
        sign = self.take()
        if sign == "?":
            return ("alt", (part, EMPTY))
        if sign == "*":
            return ("star", part)
        if sign == "+":
            return ("cat", (part, ("star", part)))
        stop = self.text.index("}", self.at)
        least, comma, most = self.text[self.at : stop].partition(",")
        if most:
            raise ValueError("only {n} and {n,} are known")
        self.at = stop + 1
        return ("cat", (part,) * int(least) + ((("star", part),) if comma else ()))

    def byte(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def cased(self, values: set[int]):
        if self.any_case:
            values = values | {ord(f(chr(v))) for v in values for f in (str.upper, str.lower)}
        return ("set", frozenset(values))

    def atom(self):
        if self.peek() == "(":
            self.take()
            part = self.alternatives()
            if self.take() != ")":
                raise ValueError("unbalanced pattern")
            return part
        if self.peek() != "[":
            return self.cased({self.byte()})
        self.take()
        inverted = self.peek() == "^" and bool(self.take())
        values: set[int] = set()
        while self.peek() != "]":
            low = self.byte()
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.byte()
            values.update(range(low, high + 1))
        self.take()
        return ("set", frozenset(set(range(256)) - values if inverted else values))


def parse(pattern: str, any_case: bool = False):
    reader = _Reader(pattern, any_case)
    tree = reader.alternatives()
    if reader.at != len(pattern):
        raise ValueError(f"cannot read {pattern!r}")
    return tree


def reverse(tree):
    kind, body = tree
    if kind == "cat":
        return ("cat", tuple(reverse(p) for p in reversed(body)))
    if kind == "alt":
        return ("alt", tuple(reverse(p) for p in body))
    return tree if kind == "set" else ("star", reverse(body))


@dataclass(frozen=True)
class Automaton:
    """Transition arrays by state and byte class, and the rules that end in a state.

    State 0 is the start; ``accepts[s]`` has bit k set for rule k.
    """

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray

    def rows(self) -> list:
        """The start state as a list from byte to the next state's list.

        Entry 256 of a state is its rules, -1 if no further byte leads to any.
        """
        rows: list[list] = [[] for _ in self.table]
        for state, (row, nexts) in enumerate(zip(rows, self.table[:, self.classes].tolist())):
            row.extend(rows[t] for t in nexts)
            stuck = not self.accepts[state] and (self.table[state] == state).all()
            row.append(-1 if stuck else int(self.accepts[state]))
        return rows[0]

    def whole(self, data: bytes) -> bool:
        state = 0
        for byte in data:
            state = self.table[state, self.classes[byte]]
        return bool(self.accepts[state])


def compile_trees(trees: Sequence, search: bool) -> Automaton:
    """Minimal automaton of all trees; ``search`` lets a match begin at any byte."""
    epsilon: list[list[int]] = []
    moves: list[list[tuple[frozenset, int]]] = []

    def state() -> int:
        epsilon.append([])
        moves.append([])
        return len(epsilon) - 1

    def build(tree, start: int) -> int:
        kind, body = tree
        if kind == "set":
            end = state()
            moves[start].append((body, end))
            return end
        if kind == "cat":
            for part in body:
                start = build(part, start)
            return start
        end = state()
        if kind == "alt":
            for part in body:
                head = state()
                epsilon[start].append(head)
                epsilon[build(part, head)].append(end)
            return end
        epsilon[start].append(end)
        head = state()
        epsilon[end].append(head)
        epsilon[build(body, head)].append(end)
        return end

    root = state()
    ends = {}
    for k, tree in enumerate(trees):
        head = state()
        epsilon[root].append(head)
        ends[build(tree, head)] = k

    def closure(states: frozenset) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in epsilon[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    # Bytes that no set tells apart are one class.
    sets = sorted({tuple(sorted(s)) for m in moves for s, _ in m})
    signature = [tuple(b in s for s in map(frozenset, sets)) for b in range(256)]
    groups = {sig: i for i, sig in enumerate(dict.fromkeys(signature))}
    classes = np.array([groups[s] for s in signature], np.uint8)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(len(groups))]

    first = closure(frozenset([root]))
    numbers, queue, table = {first: 0}, deque([first]), []
    while queue:
        subset = queue.popleft()
        out = [(s, t) for q in subset for s, t in moves[q]]
        row = []
        for b in sample:
            target = closure(frozenset(t for s, t in out if b in s))
            target = target | first if search else target
            if target not in numbers:
                numbers[target] = len(numbers)
                queue.append(target)
            row.append(numbers[target])
        table.append(row)
    accepts = np.array([sum(1 << ends[q] for q in s if q in ends) for s in numbers], np.int64)
    return _minimised(classes, np.array(table, np.int64), accepts)


def _minimised(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Merge states that no further input tells apart (partition refinement)."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        key = np.column_stack([block, block[table]])
        finer = np.unique(key, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    order = np.unique(block, return_index=True)[1]
    rank = np.empty(len(order), np.int64)
    # The start keeps number 0.
    placed = sorted(range(len(order)), key=lambda b: (b != block[0], order[b]))
    rank[placed] = np.arange(len(order))
    chosen = order[placed]
    return Automaton(classes, rank[block[table[chosen]]], accepts[chosen])


@dataclass(frozen=True)
class Scanner:
    """What a task needs: the combined backward automaton and one forward one per rule."""

    rules: tuple[Rule, ...]
    starts: Automaton
    forward: tuple[Automaton, ...]
    confirm: tuple[Automaton | None, ...]


def compile_rules(rules: Sequence[Rule] = RULES) -> Scanner:
    trees = [parse(r.pattern, r.any_case) for r in rules]
    return Scanner(
        tuple(rules),
        compile_trees([reverse(t) for t in trees], search=True),
        tuple(compile_trees([t], search=False) for t in trees),
        tuple(
            compile_trees([parse(r.confirm, r.any_case)], search=False) if r.confirm else None
            for r in rules
        ),
    )


# ---------------------------------------------------------------- scan


def make_scan(scanner: Scanner):
    """Function from bytes to (rule number, start byte, end byte) by start, then rule."""
    root = scanner.starts.rows()
    forward = [f.rows() for f in scanner.forward]

    def longest_end(k: int, data: bytes, at: int) -> int:
        row, last = forward[k], -1
        for i in range(at, len(data)):
            row = row[data[i]]
            if row[256] > 0:
                last = i + 1
            elif row[256] < 0:
                break
        return last

    def scan(data: bytes) -> list[tuple[int, int, int]]:
        row, n = root, len(data)
        # Runs of neighbouring starts, each as [last, first], from the back.
        found: list[list[list[int]]] = [[] for _ in scanner.rules]
        for back, byte in enumerate(reversed(data), 1):
            row = row[byte]
            if row[256] > 0:
                at = n - back
                for k, runs in enumerate(found):
                    if row[256] >> k & 1:
                        if runs and runs[-1][1] == at + 1:
                            runs[-1][1] = at
                        else:
                            runs.append([at, at])
        spans = []
        for k, runs in enumerate(found):
            confirm = scanner.confirm[k]
            at = 0
            for last, first in reversed(runs):
                at = max(at, first)
                while at <= last:
                    end = longest_end(k, data, at)
                    if confirm is None or confirm.whole(data[at:end]):
                        spans.append((k, at, end))
                    at = max(end, at + 1)
        return sorted(spans, key=lambda s: (s[1], s[0]))

    return scan


SPAN_TYPE = "array<struct<kind: string, start: int, end: int>>"


def _arrow_spans(kinds: list, starts: list, ends: list, sizes: list) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *sizes]), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            names=["kind", "start", "end"],
        ),
    )


def find_secrets(
    df: DataFrame, keep: Sequence[str], text: str = "text", rules: Sequence[Rule] = ALL_RULES
) -> DataFrame:
    """``keep`` columns and ``spans``: kind, start and end (code points, end exclusive).

    Spans are ordered by start, then by the order of ``rules``. Null and empty
    texts have an empty list; rows are neither merged nor dropped, and columns
    not in ``keep`` do not matter. ``spans`` gets underscores in front if
    ``keep`` has that name.
    """
    scanner = compile_rules(rules)
    names = [r.kind for r in rules]
    kept = keeping(df, keep, text, [("spans", SPAN_TYPE)])
    columns, read = kept.names, kept.value

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make_scan(scanner)
        for part in slices(batches, read):
            kinds, starts, ends, sizes = [], [], [], []
            for value in part.column(read).cast(pa.binary()):
                data = value.as_py() or b""
                spans = scan(data)
                sizes.append(len(spans))
                if not spans:
                    continue
                # Code points begin at bytes other than 10xxxxxx.
                leads = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
                points = np.concatenate([[0], np.cumsum(leads)])
                for k, a, b in spans:
                    kinds.append(names[k])
                    starts.append(int(points[a]))
                    ends.append(int(points[b]))
            yield kept_batch(part, columns, _arrow_spans(kinds, starts, ends, sizes))

    return map_lean(kept.source, mapper, kept.schema)


def span_text(spans: str = "spans") -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(text: str, spans: str, mask: str = "[SECRET]") -> Column:
    """``text`` with each stretch that spans cover replaced by ``mask``.

    Overlapping spans become one mask; a null text stays null.
    """
    body = F.col(f"`{text}`")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(acc: Column, span: Column) -> Column:
        piece = F.when(
            span["start"] >= acc["at"],
            F.concat(acc["out"], body.substr(acc["at"] + 1, span["start"] - acc["at"]), F.lit(mask)),
        ).otherwise(acc["out"])
        return F.struct(piece.alias("out"), F.greatest(acc["at"], span["end"]).alias("at"))

    joined = F.aggregate(
        spans, start, add, lambda acc: F.concat(acc["out"], body.substr(acc["at"] + 1, F.length(body)))
    )
    return F.when(F.size(spans) == 0, body).otherwise(joined)

