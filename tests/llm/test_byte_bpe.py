import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from llm_data import documents, odd_texts
from pyspark.errors import PythonException

from candlemill.llm import byte_bpe as B

VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = B.load_ranks(VOCAB)
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(7)
    alphabet = "abcdeé ß漢字😀\n\t .,!?'1234567890_  ‍\x1c\x85"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    return made + ["<|endoftext|> it's they'll", "a" * 3000, " " * 2000 + "x"] + odd_texts()


def test_ids_equal_the_rank_library_and_decode_to_the_text(spark, reference):
    given = texts()
    encoded = B.encode(documents(spark, given), ["doc_id"], VOCAB, PATTERN)
    rows = B.decode(encoded, ["doc_id", "ids", "packed"], VOCAB).collect()
    assert len(rows) == len(given)
    for r in rows:
        ids = reference.encode_ordinary(given[r["doc_id"]] or "")
        assert list(r["ids"]) == ids
        assert bytes(r["packed"]) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(r["decoded"]) == (given[r["doc_id"]] or "").encode()


def test_offsets_cover_the_text(spark, reference):
    given = texts()
    found = B.encode(documents(spark, given), ["doc_id"], VOCAB, PATTERN, offsets=True)
    for r in found.collect():
        text, at = given[r["doc_id"]] or "", 0
        tokens = [reference.decode_single_token_bytes(i) for i in r["ids"]]
        for token, a, b in zip(tokens, r["starts"], r["ends"]):
            assert a <= at <= b and token in text[a:b].encode()
            at = b
        assert at == len(text)


def test_long_texts_are_cut_without_changing_tokens(reference):
    text = " ".join(["some words, 123"] * 50) + "  \n\n  end"
    parts = B.pieces(text, 40)
    assert len(parts) > 5 and "".join(parts) == text
    cut = [i for p in parts for i in reference.encode_ordinary(p)]
    assert cut == reference.encode_ordinary(text)


def test_split_characters():
    whole = "a😀é".encode()
    assert B.token_texts([whole[:3], whole[3:6], whole[6:]]) == ["a", "😀", "é"]
    assert B.token_texts([b"\xf0\x9f"]) == ["�"]
    assert B.token_texts([]) == []


def test_clashing_names_empty_table_and_bad_ids(spark):
    df = documents(spark, ["x"]).withColumnRenamed("lang", "ids")
    found = B.encode(df, ["doc_id", "ids"], VOCAB, PATTERN)
    assert found.columns == ["doc_id", "ids", "_ids", "packed"]
    assert found.first()["_ids"] == [B.load_ranks(VOCAB)[b"x"]]
    assert B.encode(df.limit(0), ["doc_id"], VOCAB, PATTERN).count() == 0
    bad = spark.createDataFrame([(1, [-1])], "doc_id int, ids array<int>")
    with pytest.raises(PythonException):
        B.decode(bad, ["doc_id"], VOCAB).collect()
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert [bytes(r["decoded"]) for r in B.decode(none, ["doc_id"], VOCAB).collect()] == [b"", b""]


def test_digest_of_the_query(spark, reference):
    from candlemill.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in QUERIES["op3_byte_bpe"](spark, folder).collect()}
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = reference.encode_ordinary(doc["text"] or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        got = rows[doc["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()


def test_outputs_are_digests_of_what_they_name(spark, reference, monkeypatch):
    monkeypatch.setattr(B, "_REMEMBERED_BYTES", 20_000)
    monkeypatch.setattr(B, "_ENCODE_BYTES", 500)
    given = texts()
    new = ["decoded_sha256", "n_tokens", "ids_sha256", "ids"]
    found = B.encode(documents(spark, given), ["doc_id"], VOCAB, PATTERN, outputs=new)
    assert found.columns == ["doc_id", *new]
    for r in found.collect():
        text = given[r["doc_id"]] or ""
        ids = reference.encode_ordinary(text)
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_a_task_gives_back_its_memory():
    import os

    import numpy as np

    from candlemill.llm.common import release_memory

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

    before = resident()
    held = [bytes(1000) for _ in range(200_000)] + [np.ones(1000)]
    assert resident() > before + 150
    del held
    release_memory()
    assert resident() < before + 60


def test_tasks_get_small_batches_and_give_memory_back(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from candlemill.llm import common

    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    found = B.encode(texts, ["text"], VOCAB, PATTERN, outputs=["n_tokens"])  # sets the limit
    assert found.agg(F.sum("n_tokens")).first()[0] == 3000 * found.first()["n_tokens"]

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    sizes = texts.mapInArrow(measure, "n long, bytes long").collect()
    assert sum(r["n"] for r in sizes) == 3000 and max(r["bytes"] for r in sizes) < 1.1 * common.BATCH_BYTES
    released = spark.sparkContext.accumulator(0)
    plain = common.release_memory

    def counted():
        released.add(1)
        plain()

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common, "release_memory", counted)
        common.map_lean(texts, measure, "n long, bytes long").collect()
    assert released.value == 1
