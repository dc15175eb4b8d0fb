import re

import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

import corpus_pipeline as C

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("steps")
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for n, (_, apply) in enumerate(C.STAGES):
        apply(spark, docs[-1], FOLDER).write.parquet(f"{folder}/{n}")
        docs.append(spark.read.parquet(f"{folder}/{n}"))
    return docs


def test_stages_keep_the_columns(steps):
    assert len(C.STAGES) == 5
    assert all(df.columns == COLUMNS for df in steps[:-1])


def test_quality_keeps_good_documents(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    left = steps[1].join(labels, "doc_id").groupBy("quality").count().collect()
    given = steps[0].join(labels, "doc_id").groupBy("quality").count().collect()
    left, given = ({r["quality"]: r["count"] for r in x} for x in (left, given))
    assert left[1] == given[1] and left.get(0, 0) <= 0.1 * given[0]


def test_one_of_each_group_stays(steps):
    from test_minhash import brute

    rows = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    kept = {i for i, (_, _, kept) in brute(rows, 5).items() if kept}
    assert {r["doc_id"] for r in steps[2].collect()} == kept


def test_secrets_are_masked(steps):
    from test_secret_scan import plain

    before = {r["doc_id"]: r for r in steps[2].collect()}
    for r in steps[3].collect():
        old = before[r["doc_id"]]
        assert plain(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if not plain(old["text"]):
            assert r["text"] == old["text"]


def test_mix_keeps_all_and_interleaves(steps):
    before, after = steps[3].collect(), steps[4].collect()
    assert sorted(map(repr, before)) == sorted(map(repr, after))


def test_tokens(steps):
    rows = steps[5].collect()
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in steps[4].collect()}


def test_run_equals_the_stages(spark, steps):
    assert sorted(map(repr, C.run(spark, FOLDER).collect())) == sorted(map(repr, steps[5].collect()))


def test_run_has_the_order_of_the_mix(spark, steps):
    placed = C.pfair_mix.mix(steps[3], F.length("text"), block_size=C.MIX_BLOCK).collect()
    wanted = [r["doc_id"] for r in sorted(placed, key=lambda r: (r["slot"], r["start"], r["doc_id"]))]
    got = sorted(C.run(spark, FOLDER).collect(), key=lambda r: r["place"])
    assert [r["place"] for r in got] == list(range(len(wanted)))
    assert [r["doc_id"] for r in got] == wanted != sorted(wanted)


def test_place_follows_parts_not_the_scan(spark, tmp_path):
    # Later parts are larger, so a scan reads them first.
    rows = spark.range(1000).withColumn("part", F.floor(F.sqrt("id") / 4))
    path = str(tmp_path / "t")
    ordered = rows.repartitionByRange(8, "id").sortWithinPartitions("id")
    ordered.select("id", F.repeat(F.lit("x"), F.col("part").cast("int")).alias("text")).write.parquet(path)
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) > 1
    for df in (stored, ordered):
        assert all(r["id"] == r["place"] for r in C.with_place(df, ["id"]).collect())
    assert C.with_place(stored.limit(0), ["id"]).count() == 0


def test_near_duplicates_are_decided_by_row(spark):
    one, two = ("".join(f"{w}{i} " for i in range(60)) for w in ("alpha", "beta"))
    rows = [(1, one), (2, one + "end"), (2, two), (3, two), (3, two), (4, "other " * 9), (4, "other " * 9)]
    docs = spark.createDataFrame(rows + [(None, one)] * 2, "doc_id long, text string")
    got = C.without_near_duplicates(spark, docs, FOLDER).collect()
    wanted = [(1, one), (2, two), (4, "other " * 9), (None, one), (None, one)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


def test_odd_rows_in_every_stage(spark):
    docs = documents(spark, odd_texts() + ["password=abcdef12345 x"])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    docs = docs.withColumn("spans", F.lit(1)).withColumn("score", F.lit(2))
    for name, apply in C.STAGES:
        found = apply(spark, docs, FOLDER)
        assert found.count() <= docs.count(), name
        assert apply(spark, docs.limit(0), FOLDER).count() == 0, name
        if name != C.STAGES[-1][0]:
            assert found.columns == docs.columns
    masked = C.without_secrets(spark, docs, FOLDER).where("text LIKE '%SECRET%'").first()
    assert re.fullmatch(r"\[SECRET\] x", masked["text"])
