import itertools

import numpy as np
import pyarrow as pa
import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

from candlemill.llm import quality_crf as Q
from candlemill.llm.common import crc_mod, text_buffer

FOLDER = "/root/testdata/sf0.01"


def test_forward_backward_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(0, 6, 4)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        unary, switch = rng.normal(size=(offsets[-1], 2)), rng.normal(size=(2, 2))
        got, pairs, total = Q.forward_backward(unary, switch, offsets)
        wanted, both, whole = np.zeros_like(unary), np.zeros((2, 2)), 0.0
        for a, b in zip(offsets, offsets[1:]):
            if a == b:
                continue
            paths = list(itertools.product((0, 1), repeat=b - a))
            scores = [
                sum(unary[a + i, s] for i, s in enumerate(p)) + sum(switch[x] for x in zip(p, p[1:]))
                for p in paths
            ]
            whole += np.logaddexp.reduce(scores)
            weight = np.exp(scores - np.logaddexp.reduce(scores))
            for p, w in zip(paths, weight):
                for i, s in enumerate(p):
                    wanted[a + i, s] += w
                for x in zip(p, p[1:]):
                    both[x] += w
        assert got == pytest.approx(wanted) and pairs == pytest.approx(both)
        assert total == pytest.approx(whole)


def test_line_features():
    lines = Q.line_features(*text_buffer(pa.array(["AB cd\n\n cd 12\nAB cd", None, "x|"])))
    assert lines.offsets.tolist() == [0, 3, 3, 4]
    names = ["bias", *Q.BASE_FEATURES]
    first = dict(zip(names, lines.features[0]))
    assert first["capitals"] == pytest.approx(0.5) and first["new_words"] == 1
    assert lines.features[2][names.index("repeated")] == 1
    assert lines.features[1][names.index("new_words")] == pytest.approx(0.5)
    assert lines.features[3][names.index("bars")] == pytest.approx(0.5)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held_out = crc_mod("doc_id", 5) == 0
    model = Q.fit(docs, labels, learn=~held_out)
    scored = Q.score_documents(docs.where(held_out), model, ["doc_id"])
    rows = scored.join(labels, "doc_id").toPandas()
    good = rows["score"] >= 0.3
    assert (good == (rows["quality"] == 1)).mean() > 0.97
    assert good[rows["quality"] == 1].all()


@pytest.fixture(scope="module")
def model(spark):
    texts = ["Plain words of a text, with more.\nAnother line here."] * 4 + ["%%% $$$ ###\n&&& !!!"] * 4
    labels = [(i, int(i < 4)) for i in range(8)] + [(3, 0), (None, 1), (5, None), (6, 7)]
    return Q.fit(
        documents(spark, texts),
        spark.createDataFrame(labels, "doc_id long, quality int"),
        learn=F.lit(True),
    )


def test_odd_texts(spark, model):
    given = odd_texts() + ["Some words of a text.", "$$$ %%%"]
    rows = Q.score_documents(documents(spark, given), model, ["doc_id"], lines=True).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(got) == len(given) and all(0 <= r["score"] <= 1 for r in rows)
    assert got[0]["score"] == got[1]["score"] == got[2]["score"]
    assert got[5]["score"] == got[6]["score"]
    assert got[len(given) - 2]["score"] > got[len(given) - 1]["score"]
    assert len(got[4]["good"]) == 2 and got[0]["good"] == []


def test_without_labels_clashing_names_and_empty_table(spark):
    df = documents(spark, ["a", None]).withColumn("score", F.lit("x"))
    none = Q.fit(df, spark.createDataFrame([], "doc_id long, quality int"), learn=F.lit(True))
    found = Q.score_documents(df, none, ["doc_id", "score"])
    assert found.columns == ["doc_id", "score", "_score"]
    assert [r["_score"] for r in found.collect()] == [0.5, 0.5]
    assert Q.score_documents(df.limit(0), none, ["doc_id"]).count() == 0
    one = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    assert Q.fit(df, one, learn=F.lit(True)).base_rate == 1
