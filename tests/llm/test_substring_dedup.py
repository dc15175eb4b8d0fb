import hashlib
import random
import re

import pytest
from llm_data import odd_texts, prose

from candlemill.llm import substring_dedup as S

DDL = "doc_id long, text string, extra string"


def brute(rows, window):
    """doc_id -> (n_words, n_removed, hash of what is left)."""
    rows = sorted((i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows)
    first, out = {}, {}
    for i, words in rows:
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            key = tuple(words[a : a + window])
            if first.setdefault(key, i) < i:
                gone[a : a + window] = [True] * window
        left = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DDL)
    return {
        r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
        for r in S.remove_repeats(df, **options).collect()
    }


@pytest.mark.parametrize("period", [3, 7, 13, 21, 31])
def test_cover_gives_every_difference(period):
    cover = S.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    passage, common = prose(rng, 40, words), prose(rng, 25, words)
    texts = []
    for i in range(400):
        text = prose(rng, rng.randint(0, 60), words)
        if i % 3 == 0:
            at = rng.randint(0, 30)
            text += " " + " ".join(passage.split()[at : at + rng.randint(8, 30)]) + " " + prose(rng, 9, words)
        if i % 2 == 0:  # a hot passage
            text = common + "\n" + text
        texts.append(text)
    texts += [texts[5]] * 30 + [texts[7] + " end"] * 5 + odd_texts()
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    assert found(spark, rows, window=12, period=7) == brute(rows, 12)


def test_kept_text(spark):
    words = [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, "new " + " ".join(words[5:57]) + " tail"), (3, " ".join(words))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DDL)
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in S.remove_repeats(df).collect()}
    assert got == {1: (0, None), 2: (52, "new tail"), 3: (60, None)}


def test_null_keys_repeated_keys_and_empty_table(spark):
    text = " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(None, text, "x"), (4, text, "x"), (4, text, "x")], DDL)
    rows = [(r["doc_id"], r["n_removed"]) for r in S.remove_repeats(df).collect()]
    assert sorted(rows, key=str) == [(4, 0), (4, 0), (None, 0)]
    assert S.remove_repeats(df.limit(0)).count() == 0


def brute_rows(rows, window):
    first, out = {}, []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for a in range(len(words) - window + 1):
            key = tuple(words[a : a + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            if i is not None and first[tuple(words[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        left = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [1, 10**6])
def test_rows_that_share_a_key_are_judged_by_their_own_texts(spark, hot, monkeypatch):
    monkeypatch.setattr(S, "HOT_LEAST", hot)
    monkeypatch.setattr(S, "SAMPLE_EVERY", 1)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    common = prose(rng, 30, words)
    rows = []
    for i in range(200):
        text = prose(rng, rng.randint(0, 40), words) + " " + (common if i % 3 else "")
        rows.append((rng.choice([None, *range(40)]), text + " " + prose(rng, rng.randint(0, 20), words)))
    rows += rows[:20] + [(3, rows[50][1]), (60, rows[50][1] + " tail"), (60, common), (60, common)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DDL)
    got = [
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
        for r in S.remove_repeats(df, window=12, period=7).collect()
    ]
    assert sorted(got, key=repr) == brute_rows(rows, 12)
    assert all(removed <= n for _, n, removed, _ in got)


def test_tasks_get_small_batches_and_give_memory_back(spark, monkeypatch):
    from pyspark.sql import functions as F

    from candlemill.llm import common

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")  # other operators set it
    small, large = (spark.sparkContext.accumulator(0) for _ in range(2))
    released = spark.sparkContext.accumulator(0)
    plain_slices, plain_release = S.slices, common.release_memory

    def watched(batches, *given):
        def counted():
            for batch in batches:
                (small if batch.nbytes < 1.1 * common.BATCH_BYTES else large).add(1)
                yield batch

        return plain_slices(counted(), *given)

    def release():
        released.add(1)
        plain_release()

    monkeypatch.setattr(S, "slices", watched)
    monkeypatch.setattr(common, "release_memory", release)
    shared = " ".join(f"v{i}" for i in range(80))
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(400)), lambda w: F.concat(w, F.lit("of"), F.col("id"))))
    docs = spark.range(0, 3000, 1, 1).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", words, F.lit(shared), F.col("id").cast("string")).alias("text")
    )
    got = S.remove_repeats(docs).groupBy("n_words", "n_removed").count().collect()
    assert sorted(tuple(r) for r in got) == [(481, 0, 1), (481, 80, 2999)]
    assert small.value > 3 and large.value == 0
    assert released.value >= 3  # anchors, windows and cuts
