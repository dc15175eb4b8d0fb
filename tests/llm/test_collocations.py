import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import odd_texts

from candlemill.llm import collocations as C

DDL = "text string, lang string, phrase string, w0 long"


def brute(rows, least=10, longest=3, percent=50, first=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    longer = defaultdict(int)
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inner = lang, p[i : i + size]
                longer[inner] = max(longer[inner], a)
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if 100 * longer[lang, p] >= percent * a:
            continue
        score, _, l, r = min(
            (1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        )
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -s)
        for lang, rows in out.items()
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:first], 1)
    }


def found(spark, rows, **options):
    df = spark.createDataFrame([(t, lang, "x", 1) for t, lang in rows], DDL)
    return {tuple(r) for r in C.collocations(df, **options).collect()}


def some_rows(seed):
    rng = random.Random(seed)
    words = [f"w{min(int(rng.expovariate(0.2)), 25)}" for _ in range(60)] + ["Hot", "hot", "ÄB", "x-y"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!?", "\x0b", "\x0c "]
    rows = []
    for i in range(250):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40)))
        if i % 3 == 0:  # a third of all rows hold the same line
            text += "\nvery common line of words here\n" + text[:20]
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(t, "en") for t in odd_texts()[:-1]] + rows[:20]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_brute_force(spark, longest, monkeypatch):
    monkeypatch.setattr(C, "SHORT_CODES", 12)
    monkeypatch.setattr(C, "_COMBINED", 500)
    rows = some_rows(longest)
    wanted = brute(rows, longest=longest)
    assert len(wanted) > 50
    assert found(spark, rows, longest=longest) == wanted


def test_ties_and_limit(spark):
    rows = [("b c. a b. é f. E f", "en")] * 10 + [("a b", None)] * 9
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, first=2) == brute(rows, first=2)


def test_a_full_bit_map_changes_nothing(spark, monkeypatch):
    rows = some_rows(9)
    wanted = brute(rows, least=4)
    monkeypatch.setattr(C, "_frequent_bits", lambda words, least: np.full(C.MAP_BITS // 8, 255, np.uint8))
    assert found(spark, rows, least=4) == wanted


def test_bits_are_those_of_frequent_words(spark):
    words = spark.createDataFrame([(0, 10), (5, 9), (40_000, 11), (C.MAP_BITS + 7, 10)], "key long, n long")
    bits = np.unpackbits(C._frequent_bits(words, 10), bitorder="little")
    assert np.flatnonzero(bits).tolist() == [0, 7, 40_000]


def test_long_text_is_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "_PIECE_BYTES", 64)
    rows = [(" ".join(["one two three, four"] * 400), "en"), ("one two " * 300, "en"), ("x" * 500, "en")]
    assert found(spark, rows) == brute(rows)


def test_empty_tables_and_texts(spark):
    assert found(spark, []) == set()
    assert found(spark, [(None, "en"), ("", None), (" .,\n", "en")]) == set()


def test_scores_of_large_counts_are_exact(spark):
    a, l, r = 999_999_999_999_937, 999_999_999_999_989, 999_999_999_999_947
    phrases = spark.createDataFrame([([1, 2], a), ([1], l), ([2], r)], "words array<long>, a long")
    (row,) = C._scored(phrases, 2).collect()
    assert row["score"] == 1_000_000 * a * a // (l * r) == math.floor(999_999)


def test_plan_counts_windows_once_and_rolls_up(spark):
    windows = spark.createDataFrame([(1, 2, 3, 4)], "w0 long, w1 long, w2 long, n long")
    plan = C.frequent_phrases(windows, 3, 1)._jdf.queryExecution().toString()
    assert "Rollup" in plan or "rollup" in plan or "Expand" in plan
