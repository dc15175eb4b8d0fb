import random
import re

import numpy as np
import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

from candlemill.llm import minhash as M
from candlemill.llm.graph import components


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent=80):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {i: shingles(t, width) for i, t in rows}
    owner = {i: i for i in sets}

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                owner[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(spark, rows, width):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.near_duplicates(df, width=width).collect()
    assert len(got) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}


def test_equals_brute_force_on_hubs_chains_and_copies(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    texts = []

    def edited(base, n):
        base = list(base)
        for at in rng.sample(range(len(base)), n):
            base[at] = rng.choice(words)
        return base

    for size in (30, 60, 120):
        hub = [rng.choice(words) for _ in range(size)]
        texts += [hub] + [edited(hub, rng.randint(0, 3)) for _ in range(40)]
    chain = [rng.choice(words) for _ in range(80)]
    for _ in range(15):
        texts.append(chain)
        chain = chain[2:] + [rng.choice(words) for _ in range(2)]
    shared = [rng.choice(words) for _ in range(20)]
    texts += [shared + [rng.choice(words) for _ in range(rng.randint(2, 12))] for _ in range(60)]
    texts += [[rng.choice(words) for _ in range(rng.randint(0, 9))] for _ in range(60)]
    given = [" ".join(t) for t in texts]
    given += [given[0]] * 20 + [given[3].upper(), "One two three", "one TWO  three"] + odd_texts()
    ids = list(range(len(given)))
    rng.shuffle(ids)
    rows = list(zip(ids, given))
    for width in (4, 5):
        assert found(spark, rows, width) == brute(rows, width)


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    a, b = np.unique(base[:800]), np.unique(base[100:])
    same = (M.signatures([a], 128) == M.signatures([b], 128)).mean()
    assert 0.6 < same < 0.95  # 700 of 900
    small = M.signatures([a[:3], a[:3], a[:1]], 128)
    assert (small[0] == small[1]).all() and len(set(small[2])) == 1


def test_null_and_repeated_keys_and_empty_table(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(None, text), (7, text), (7, text), (3, text), (9, "z")], "doc_id long, text string")
    rows = [(r["doc_id"], r["component_id"], r["kept"]) for r in M.near_duplicates(df).collect()]
    assert sorted(rows, key=str) == [
        (3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True), (None, None, True),
    ]
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_only_unlike_documents(spark):
    rows = M.near_duplicates(documents(spark, ["a b c", "d e f", None])).collect()
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in rows)


@pytest.mark.parametrize("n", [0, 1, 60])
def test_components(spark, n):
    rng = random.Random(n)
    links = [(rng.randrange(50), rng.randrange(50)) for _ in range(n // 2)]
    links += [(100 + i, 101 + i) for i in range(n)] + ([(None, 3), (4, 4)] if n else [])
    owner = {}
    for a, b in links:
        if a is not None and a != b:
            group = owner.get(a, {a}) | owner.get(b, {b})
            for x in group:
                owner[x] = group
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {x: min(g) for x, g in owner.items()}


def templated(rng, n, shared, own):
    """Pages of one template, each with words of its own in one piece."""
    template = [f"t{i}" for i in range(shared)]
    pages = []
    for i in range(n):
        k = rng.choice(own)
        pages.append(" ".join([*template[: shared // 2], *(f"p{i}x{j}" for j in range(k)), *template[shared // 2 :]]))
    return pages


def test_templated_pages_do_not_meet_in_pairs(spark):
    rng = random.Random(4)
    pages = templated(rng, 300, 200, [70, 80, 90])  # too much of their own for any link
    docs = spark.createDataFrame(list(enumerate(pages)), "id long, text string")
    sets = docs.mapInArrow(M._set_mapper(5), "id long, members binary")
    apart = sets.select("id", (F.length("members") / 8).cast("long").alias("n"), F.col("id").alias("component"))
    assert M._rare_pairs(apart, sets, 80, "long").count() == 0


@pytest.mark.parametrize("width", [1, 4])
def test_templated_pages_of_all_sizes_equal_brute_force(spark, width):
    rng = random.Random(width)
    pages = templated(rng, 120, 60, [0, 3, 7, 8, 9, 14, 15, 16, 30]) + templated(rng, 30, 12, [1, 2, 3])
    rows = list(enumerate(pages))
    assert found(spark, rows, width) == brute(rows, width)


@pytest.mark.parametrize("percent", [80, 55])
def test_rarest_shingles_find_every_link(spark, percent):
    rng = random.Random(percent)
    pages = templated(rng, 80, 40, [0, 2, 5, 8, 12, 20])
    words = [f"w{i}" for i in range(30)]  # few words, so that most are in many sets
    pages += [" ".join(rng.sample(words, rng.randint(3, 28))) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(pages)), "id long, text string")
    sets = docs.mapInArrow(M._set_mapper(1), "id long, members binary")
    apart = sets.select("id", (F.length("members") / 8).cast("long").alias("n"), F.col("id").alias("component"))
    got = {(r["a"], r["b"]) for r in M._rare_pairs(apart, sets, percent, "long").collect()}
    members = [shingles(p, 1) for p in pages]
    wanted = {
        (a, b)
        for b in range(len(pages))
        for a in range(b)
        if 100 * len(members[a] & members[b]) >= percent * len(members[a] | members[b])
    }
    assert len(wanted) > 50 and wanted <= got and len(got) < 20 * len(wanted)
