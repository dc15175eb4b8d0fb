import hashlib
import math
import random

import numpy as np
import pytest

from candlemill.llm import vector_codes as V

DDL = "vec_id long, embedding array<double>, label int, code string, error string"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if usable(v)]
    if not kept:
        return [], None
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))
    books = [[list(cut[j][p]) for j in order[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [near(c[p], book)[1] for c in cut]
            for k in range(len(book)):
                mine = [c[p] for c, o in zip(cut, own) if o == k]
                if mine:
                    book[k] = [sum(x) // len(mine) for x in zip(*mine)]
    codes = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in c) for c in codes]
    text = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    totals = {}
    for (_, _, lab), e in zip(kept, errors):
        totals[lab] = totals.get(lab, 0) + e
    return sorted(
        (
            (i, "".join(f"{k:02x}" for _, k in c), e, totals[lab], digest)
            for (i, _, lab), c, e in zip(kept, codes, errors)
        ),
        key=repr,
    ), digest


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    return sorted((tuple(r) for r in V.compress(df, **options).collect()), key=repr)


def vectors(rng, n, width=8, spread=0.02):
    return [(i, [rng.gauss(0, spread) for _ in range(width)], rng.choice([0, 0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("entries", [3, 16])
def test_equals_brute_force(spark, entries, monkeypatch):
    monkeypatch.setattr(V, "RUN_LEAVES", 8)
    rng = random.Random(entries)
    rows = vectors(rng, 300, spread=0.004)  # few values, so ties and equal parts
    rows += [(1000 + i, rows[7][1], 1) for i in range(150)]  # a third are copies
    rows += [(5, rows[9][1], 2), (None, rows[11][1], None)]
    rows += [(2000, None, 1), (2001, [None] * 8, 1), (2002, [math.nan] + [0.0] * 7, 1)]
    rows += [(2003, [math.inf] + [0.0] * 7, 1)]
    rng.shuffle(rows)
    assert found(spark, rows, entries=entries) == brute(rows, entries=entries)[0]


def test_fewer_vectors_than_entries_and_empty_tables(spark):
    rows = vectors(random.Random(1), 5)
    assert found(spark, rows) == brute(rows)[0]
    assert found(spark, []) == [] and found(spark, [(1, None, 2)]) == []
    assert [r[:3] for r in found(spark, [(1, [], 2)])] == [(1, "00000000", 0)]


def test_large_components_are_exact(spark):
    rows = [(i, [1e5 * (i + 1), 1.5, -2e5 * i, 0.0], None) for i in range(6)]
    assert found(spark, rows, entries=2) == brute(rows, entries=2)[0]


def test_unequal_lengths_raise(spark):
    with pytest.raises(ValueError):
        found(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)])
    with pytest.raises(ValueError):
        found(spark, [(1, [1.0] * 6, 0)])


@pytest.mark.parametrize("dtype", [np.int64, object])
@pytest.mark.parametrize("leaves", [1, 3, 50, 5_000])
def test_trie_walk_equals_all_distances(dtype, leaves, monkeypatch):
    monkeypatch.setattr(V, "RUN_LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    rows = rng.integers(-3, 3, (400, 5))
    entries = rng.integers(-3, 3, (9, 5))
    rows, which = V._sorted_rows(rows)
    assert sorted(map(tuple, rows)) == list(map(tuple, rows)) and len(which) == 400
    best, far = V.nearest(rows.astype(dtype), entries.astype(dtype))
    wanted = ((rows[:, None, :] - entries[None]) ** 2).sum(2)
    assert best.tolist() == wanted.argmin(1).tolist()
    assert far.tolist() == wanted.min(1).tolist()
