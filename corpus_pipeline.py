"""From raw documents to token ids, in five stages.

Each stage takes the documents its predecessor left and all but the last give
documents with the same columns: good ones, one of each group of near
duplicates, without secrets, in the order of a weighted mix of sources, and
at last as token ids with their place in that order.
"""

from __future__ import annotations

import re

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm import byte_bpe, minhash, pfair_mix, quality_crf, secret_scan
from candlemill.llm.common import crc_mod, unclashing
from candlemill.session import range_sort, small_table, stage

# Documents that score less go.
GOOD_FROM = 0.3
# Code points per block of the mix.
MIX_BLOCK = 20_000


def _part(path: str) -> tuple[int, str]:
    """What orders the files of a table: the number of the part, then the name."""
    number = re.match(r"part-(\d+)", path.rpartition("/")[2])
    return int(number[1]) if number else -1, path


def with_place(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a stored table and ``place``, the row's number in it from 0.

    A scan does not keep the order of files, so the place comes from the file
    and the row's index inside it. Other tables are stored first. The driver
    sees a number per file.
    """
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        docs = stage(docs, "placed")
    hidden = docs.metadataColumn("_metadata")
    path = hidden["file_path"].alias("_path")
    indices = docs.select(path, hidden["row_index"].alias("_row")).groupBy("_path")
    sizes = {r["_path"]: r["n"] for r in indices.agg((F.max("_row") + 1).alias("n")).collect()}
    files, offsets, before = sorted(sizes, key=_part), [], 0
    for file in files:
        offsets.append(before)
        before += sizes[file]
    table = small_table(
        docs.sparkSession, _path=(pa.string(), files), _offset=(pa.int64(), offsets)
    )
    return (
        docs.select(*columns, path, hidden["row_index"].alias("_row"))
        .join(F.broadcast(table), "_path")
        .select(*columns, (F.col("_offset") + F.col("_row")).alias("place"))
    )


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_crf.fit(docs, labels, learn=crc_mod("doc_id", 5) != 0)
    scored = quality_crf.score_documents(docs, model, docs.columns)
    return scored.where(F.col(scored.columns[-1]) >= GOOD_FROM).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates.

    Each row is decided by its own text. Where rows share an id, they are
    numbered in the order of ids and then of content, and the first of a group
    stays. Rows with null ids stay.
    """
    key, rows = "doc_id", docs
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        key = unclashing(docs.columns, "row")
        numbered = with_place(stage(range_sort(docs, ["doc_id"]), "by-id"), docs.columns)
        place = F.when(F.col("doc_id").isNotNull(), F.col("place"))
        rows = stage(numbered.select(*docs.columns, place.alias(key)), "numbered")
    found = minhash.near_duplicates(rows, key)
    gone = found.where(~F.col("kept")).select(key).distinct()
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose secrets are masked, with their new lengths."""
    found = secret_scan.find_secrets(docs, docs.columns)
    spans = found.columns[-1]
    clean = found.withColumn("text", secret_scan.redact("text", spans))
    has = F.size(spans) > 0
    return clean.withColumn(
        "n_chars", F.when(has, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mix with tempered source weights."""
    slot, start = (unclashing(docs.columns, n) for n in ("slot", "start"))
    placed = pfair_mix.mix(docs, F.length("text"), block_size=MIX_BLOCK)
    return (
        placed.repartitionByRange(slot, start)
        .sortWithinPartitions(slot, start, "doc_id")
        .select(*docs.columns)
    )


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, its place, and whether decoding gives its text again."""
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    named = with_place(docs, ["doc_id", "lang", "source", "text"]).withColumn(
        "sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    )
    kept = ["doc_id", "lang", "source", "place", "sha"]
    new = ["n_tokens", "ids", "decoded_sha256"]
    encoded = byte_bpe.encode(named, kept, vocab, public_tokenizers.PATTERN, outputs=new)
    same = F.col("decoded_sha256") == F.col("sha")
    return encoded.select(*kept[:-1], *new[:2], same.alias("round_trip"))


STAGES = [
    ("quality classifier", good_documents),
    ("near duplicates", without_near_duplicates),
    ("secret scan", without_secrets),
    ("source mix", mixed),
    ("byte-level BPE", token_ids),
]

# A trained classifier is not expressible in SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the documents in ``sf_dir`` after all stages; ``place`` orders the mix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{number}")
    return docs
