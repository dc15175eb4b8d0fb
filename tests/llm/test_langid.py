import itertools

import numpy as np
import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

from candlemill.llm import langid as L
from candlemill.llm.common import crc_mod, text_buffer

import pyarrow as pa


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.integers(0, 6, 3)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(size=(offsets[-1], 3)) * 3
        path = L.best_languages(scores, offsets, 2.0)

        def value(s, q):
            return s[np.arange(len(q)), list(q)].sum() - 2.0 * sum(a != b for a, b in zip(q, q[1:]))

        for a, b in zip(offsets, offsets[1:]):
            s = scores[a:b]
            best = max(value(s, q) for q in itertools.product(range(3), repeat=b - a))
            assert value(s, tuple(path[a:b])) == pytest.approx(best)


def test_viterbi_with_many_languages():
    scores = np.full((6, 200), -9.0)
    path = [199, 199, 150, 150, 130, 130]
    scores[np.arange(6), path] = 0.0
    assert L.best_languages(scores, np.array([0, 6]), 2.0).tolist() == path


def test_words_and_trigrams():
    words = L.read_words(*text_buffer(pa.array(["Été 12 l'an", None, "я"])))
    assert words.lengths.tolist() == [3, 3, 1]
    assert words.offsets.tolist() == [0, 2, 2, 3]
    assert [L.SCRIPTS[s] for s in words.scripts] == ["Latin", "Latin", "Cyrillic"]
    same = L.read_words(*text_buffer(pa.array(["été", "ÉTÉ"])))
    assert same.slots[:4].tolist() == same.slots[4:].tolist()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = crc_mod("doc_id", 4) == 2
    model = L.fit(docs, learn=~held_out)
    found = L.identify(docs.where(held_out), model, ["doc_id", "lang"])
    share = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.98


@pytest.fixture(scope="module")
def model(spark):
    rows = [
        (i, t, lang)
        for i, (t, lang) in enumerate(
            [("the quick brown fox and the dog with that", "en"), ("der die und das ist nicht ein", "de"),
             ("привет мир это язык", "ru")] * 5
        )
    ] + [(90, "nothing", None), (91, None, "en")]
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def test_mixed_text_spans_and_scripts(spark, model):
    text = "the fox and the dog with that brown quick the fox der die und das ist nicht ein der die und мир"
    got = L.identify(documents(spark, [text]), model, ["doc_id"], spans=True).first()
    assert [s["lang"] for s in got["spans"]] == ["en", "de", "ru"]
    assert text.encode()[got["spans"][2]["start"] : got["spans"][2]["end"]].decode() == "мир"
    assert got["lang_pred"] == "en" and 0.5 < got["score"] < 0.7


def test_odd_texts(spark, model):
    given = odd_texts() + ["123 !!", "the fox"]
    rows = L.identify(documents(spark, given), model, ["doc_id"]).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == len(given)
    assert [i for i, (lang, _) in got.items() if lang == "und"] == [0, 1, 2, len(given) - 2]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert got[5] == got[6]


def test_nothing_learnt_clashing_names_and_empty_table(spark):
    df = documents(spark, ["some text"]).withColumn("score", F.lit(1))
    none = L.fit(df, F.lit(False))
    found = L.identify(df, none, ["doc_id", "score"])
    assert found.columns == ["doc_id", "score", "lang_pred", "_score"]
    assert found.first()["lang_pred"] == "und"
    assert L.identify(df.limit(0), none, ["doc_id"]).count() == 0


def test_words_end_where_the_script_changes(spark):
    texts = {
        "en": "the dog went out into the green garden and then it came back to the house again",
        "zh": "今天天气很好我们去公园散步然后回家吃饭看书学习中文",
        "ru": "сегодня хорошая погода мы идём гулять в парк а потом домой",
    }
    rows = [(i, t, lang, "s", 1) for i, (lang, t) in enumerate(list(texts.items()) * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = L.fit(docs, learn=F.lit(True), penalty=4.0)
    given = ["the dog今天天气很好我们去公园散步", "dogсегодня", "今天, the dog went!", "él 3x", "12 ?"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in L.identify(df, model, ["doc_id"], spans=True).collect()}
    cut = {
        i: [(s["lang"], given[i].encode()[s["start"] : s["end"]].decode()) for s in r["spans"]]
        for i, r in found.items()
    }
    assert cut[0] == [("en", "the dog"), ("zh", "今天天气很好我们去公园散步")]
    assert found[0]["lang_pred"] == "zh" and found[0]["score"] == pytest.approx(13 / 19)
    assert [lang for lang, _ in cut[1]] == ["en", "ru"]
    assert [lang for lang, _ in cut[2]] == ["zh", "en"]
    assert len(cut[3]) <= 1 and found[3]["score"] == 1.0
    assert found[4]["lang_pred"] == "und" and found[4]["score"] == 0.0
