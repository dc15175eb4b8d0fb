import hashlib

import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

from candlemill.llm import merkle as M


def edits(rows):
    rows = sorted(rows, reverse=True)
    out = {}
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        cut = len(text) // 3
        out[i] = text[: len(text) - cut] + after[:cut]
    return out


@pytest.mark.parametrize("n", [1, 2, 40])
def test_edits_and_likeness(spark, n):
    texts = [f"Line {i} of it. Second sentence {i * 7}.\nMore text {i % 5}! Ends {i}." for i in range(n)]
    texts += odd_texts() if n > 2 else []
    wanted = edits([(i, t or "") for i, t in enumerate(texts)])
    rows = M.compare_edits(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["n_chars"] == len(text) and r["edited"] == wanted[r["doc_id"]]
        assert r["fingerprint"] == M.fingerprint(text)
        assert r["edited_fingerprint"] == M.fingerprint(r["edited"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_edited"] == 1) >= (text == r["edited"])


def test_test_table_is_nearer_to_its_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.compare_edits(docs).collect()
    assert len(rows) == docs.count()
    near = sorted(r["near_edited"] for r in rows)
    assert near[len(near) // 20] > 0.4
    assert sorted(r["near_next"] for r in rows)[len(rows) * 9 // 10] < 0.2
    assert sum(r["near_edited"] >= r["near_next"] for r in rows) >= len(rows) * 0.97


def test_roots_and_branches():
    a = "One. Two.\nThree.\n\nFour. Five.\n"
    assert M.fingerprint(a) == M.fingerprint(str(a))
    assert M.fingerprint(a).split(":")[0] != M.fingerprint(a + " ").split(":")[0]
    assert "".join(M._LEAF.findall(a)) == a
    tree = M.tree(M.fingerprint(a))
    assert tree.length == len(a) and len(tree.children) == 2
    b = a.replace("Three", "Thr33")
    assert M.differences(M.fingerprint(a), M.fingerprint(b)) == [(10, 17, 10, 17)]
    assert M.differences(M.fingerprint(a), M.fingerprint(a)) == []
    assert M.likeness(M.fingerprint(""), M.fingerprint("")) == 1
    assert M.likeness(M.fingerprint(""), M.fingerprint(a)) == 0
    whole = M.likeness(M.fingerprint(a), M.fingerprint(b))
    assert whole == pytest.approx(2 * (len(a) - 7) / (2 * len(a)))


def test_repeated_and_null_keys_clashing_names_empty_table(spark):
    df = spark.createDataFrame([(1, "a b."), (1, "a b."), (None, "c."), (2, None)], "doc_id long, text string")
    rows = M.compare_edits(df).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in rows) == [
        ("1", 4), ("1", 4), ("2", 0), ("None", 2),
    ]
    assert M.compare_edits(df.limit(0)).count() == 0
    named = M.fingerprints(df.withColumn("fingerprint", F.lit(1)), ["doc_id", "fingerprint"])
    assert named.columns == ["doc_id", "fingerprint", "_fingerprint"]
    assert named.count() == 4


def test_digest_of_the_query(spark):
    from candlemill.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = edits([(r[0], r[1] or "") for r in docs])
    for r in QUERIES["op5_merkle"](spark, folder).collect():
        assert r["edited_sha256"] == hashlib.sha256(wanted[r["doc_id"]].encode()).hexdigest()
