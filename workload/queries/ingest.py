"""Manifest, checksums, logs, raw files, copies."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schema
from candlemill.operators import report
from candlemill.session import new_folder, stage
from candlemill.sources import archives, klines as raw_files, store
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import plain, rounded, run

BASE_URL = "https://archive.example/klines"

_MONTHS = """SELECT replace(o_orderpriority, ' ', '') AS symbol,
      unnest(range(CAST(min(date_trunc('month', o_orderdate)) AS TIMESTAMP),
        CAST(max(date_trunc('month', o_orderdate)) AS TIMESTAMP) + INTERVAL 1 MONTH,
        INTERVAL 1 MONTH)) AS m
    FROM orders GROUP BY 1"""


def _periods(spark: SparkSession, sf: str) -> DataFrame:
    """Months each order priority spans, as if it were a market symbol."""
    symbol = F.replace(F.col("o_orderpriority"), F.lit(" "), F.lit(""))
    spans = T.table(spark, sf, "orders").groupBy(symbol.alias("symbol")).agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return archives.month_periods(spans, T.KEYS, "first", "last")


@run(
    O.query(
        """SELECT symbol, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
             strftime(m, '%Y-%m') AS period FROM months""",
        (), months=_MONTHS,
    )
)
def month_periods(spark: SparkSession, sf: str) -> DataFrame:
    return _periods(spark, sf)


_ZIP = "concat(symbol, '-1m-', strftime(m, '%Y-%m'), '.zip')"


@run(
    O.query(
        f"""SELECT symbol, period, zip_filename, concat(zip_filename, '.CHECKSUM')
              AS checksum_filename,
              concat('{BASE_URL}/', symbol, '/1m/', zip_filename) AS zip_url,
              concat('{BASE_URL}/', symbol, '/1m/', zip_filename, '.CHECKSUM') AS checksum_url
            FROM (SELECT symbol, strftime(m, '%Y-%m') AS period, {_ZIP} AS zip_filename
                  FROM months)""",
        (), months=_MONTHS,
    )
)
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return archives.manifest(_periods(spark, sf), BASE_URL).drop("year", "month")


# Documents stand for archives: their text is the content. The language says
# whether the checksum text is right, wrong, blank or absent.
_DOC_NAME = "concat('doc-', CAST(doc_id AS {text}), '.zip')"
_DOC_FILES = f"""SELECT {_DOC_NAME.format(text='VARCHAR')} AS zip_filename, lang,
      sha256(text) AS digest, octet_length(encode(text)) AS bytes FROM documents"""
_DOC_VERIFIED = """SELECT *, bytes > 0 AS download_ok,
      CASE lang WHEN 'en' THEN true WHEN 'de' THEN false END AS checksum_ok,
      CASE lang WHEN 'en' THEN digest WHEN 'de' THEN repeat('0', 64) END AS expected_hash,
      CASE WHEN lang IN ('en', 'de') THEN digest END AS actual_hash
    FROM files"""


def _doc_archives(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = T.table(spark, sf, "documents").select("doc_id", "text", "lang")
    name = F.expr(_DOC_NAME.format(text="STRING")).alias("zip_filename")
    digest = F.sha2("text", 256)
    listed = docs.select(name, "doc_id")
    landed = docs.select(
        name,
        F.octet_length("text").cast("long").alias("zip_size_bytes"),
        digest.alias("actual_hash"),
    )
    lang = F.col("lang")
    text = (
        F.when(lang == "en", F.concat(F.lit("\n "), F.upper(digest), F.lit("  "), name))
        .when(lang == "de", F.concat(F.repeat(F.lit("0"), F.lit(64)), F.lit("\tother.zip")))
        .when(lang == "fr", F.lit(" \n\t"))
    )
    checksums = docs.select(name, text.alias("checksum_text"))
    return listed, landed, checksums.dropna()


def _doc_verified(spark: SparkSession, sf: str) -> DataFrame:
    return archives.verify_checksums(*_doc_archives(spark, sf))


@run(
    O.query(
        "SELECT zip_filename, download_ok, CAST(checksum_ok AS VARCHAR) AS checksum_ok, "
        "expected_hash, actual_hash FROM verified",
        (), files=_DOC_FILES, verified=_DOC_VERIFIED,
    )
)
def checksum_verify(spark: SparkSession, sf: str) -> DataFrame:
    verified = _doc_verified(spark, sf).select(
        "zip_filename", "download_ok", "checksum_ok", "expected_hash", "actual_hash"
    )
    return plain(verified, "checksum_ok")


@run(
    O.query(
        "SELECT zip_filename, CAST(checksum_ok AS VARCHAR) AS checksum_ok FROM verified "
        "WHERE download_ok AND checksum_ok IS DISTINCT FROM false",
        (), files=_DOC_FILES, verified=_DOC_VERIFIED,
    )
)
def ingest_gate(spark: SparkSession, sf: str) -> DataFrame:
    kept = archives.usable(_doc_verified(spark, sf)).select("zip_filename", "checksum_ok")
    return plain(kept, "checksum_ok")


@run(
    O.query(
        f"""SELECT 'all' AS period, zip_filename, concat('{BASE_URL}/', zip_filename) AS zip_url,
              concat('{BASE_URL}/', zip_filename, '.CHECKSUM') AS checksum_url, download_ok,
              CAST(checksum_ok AS VARCHAR) AS checksum_ok,
              coalesce(download_ok AND checksum_ok IS DISTINCT FROM false, false) AS extract_ok,
              CAST(bytes AS BIGINT) AS zip_size_bytes, expected_hash, actual_hash
            FROM verified""",
        (), files=_DOC_FILES, verified=_DOC_VERIFIED,
    )
)
def ingest_log(spark: SparkSession, sf: str) -> DataFrame:
    """The audit log without its time stamp, appended and read back."""
    verified = stage(_doc_verified(spark, sf), "verified")
    named = verified.withColumns(
        {
            "period": F.lit("all"),
            "zip_url": F.concat(F.lit(f"{BASE_URL}/"), F.col("zip_filename")),
            "checksum_url": F.concat(F.lit(f"{BASE_URL}/"), F.col("zip_filename"),
                                     F.lit(".CHECKSUM")),
        }
    )
    extracted = archives.usable(verified).select("zip_filename", F.lit(True).alias("extract_ok"))
    log = archives.ingest_log(named, extracted)
    folder = new_folder(spark, "ingest-log")
    archives.append_log(log, folder)
    return plain(spark.read.schema(log.schema).parquet(folder).drop("timestamp"), "checksum_ok")


@run(
    O.query(
        f"""SELECT {_DOC_NAME.format(text='VARCHAR')} AS zip_filename, doc_id FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)"""
    )
)
def pending(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents have landed, those labelled toxic as empty files."""
    name = F.expr(_DOC_NAME.format(text="STRING")).alias("zip_filename")
    listed = T.table(spark, sf, "documents").select(name, "doc_id")
    size = F.when(F.col("toxic") == 0, F.lit(1)).otherwise(F.lit(0))
    landed = T.table(spark, sf, "labels").select(name, size.alias("zip_size_bytes"))
    return archives.pending(listed, landed)


def _csv_folder(spark: SparkSession, sf: str) -> str:
    """Raw candles as headerless CSV, one folder of parts per monthly file."""
    folder = new_folder(spark, "csv")
    rows = T.klines(spark, sf).select(*schema.RAW_COLUMNS, "source_file")
    rows.write.partitionBy("source_file").option("header", False).csv(folder)
    return folder


_LINEAGE_SQL = """symbol, source_file,
    concat('2024-', substr(source_file, length(source_file) - 5, 2)) AS file_period,
    CAST(2024 AS INTEGER) AS file_year,
    CAST(substr(source_file, length(source_file) - 5, 2) AS INTEGER) AS file_month"""


@run(
    O.query(
        f"""SELECT {_LINEAGE_SQL}, open_time, open, high, low, close, volume, close_time,
              quote_asset_volume, number_of_trades, taker_buy_base_volume,
              taker_buy_quote_volume, "ignore" FROM bronze""",
        ("bronze",),
        "open high low close volume quote_asset_volume taker_buy_base_volume "
        "taker_buy_quote_volume ignore",
    )
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(raw_files.read_bronze(spark, _csv_folder(spark, sf)))


@run(
    O.query(
        f"""SELECT * REPLACE (CAST(file_year AS DOUBLE) AS file_year,
              CAST(file_month AS DOUBLE) AS file_month)
            FROM (SELECT event_id, {_LINEAGE_SQL} FROM klines WHERE symbol <> 'error' UNION ALL
                  SELECT event_id, NULL, 'other.csv', NULL, NULL, NULL FROM klines
                  WHERE symbol = 'error')""",
        ("klines",),
    )
)
def csv_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """File names parsed; the rows of one symbol come from a file named otherwise."""
    other = F.col("symbol") == "error"
    name = F.when(other, F.lit("other.csv")).otherwise(F.col("source_file"))
    rows = T.klines(spark, sf).select("event_id", name.alias("source_file"))
    return plain(raw_files.with_lineage(rows), "file_year", "file_month")


@run(
    O.query(
        """SELECT source_file, count(*) AS rows FROM bronze GROUP BY source_file
           UNION ALL SELECT NULL, count(*) FROM bronze""",
        ("bronze",),
    )
)
def rows_per_file(spark: SparkSession, sf: str) -> DataFrame:
    return report.rows_per_file(T.bronze(spark, sf))


@run(
    O.query(
        "SELECT event_id, symbol, open_ts, close, CAST(number_of_trades AS DOUBLE) "
        "AS number_of_trades FROM stamped",
        ("stamped",),
    )
)
def union_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Per-file frames with differing column order and number types, stacked."""
    rows = T.stamped(spark, sf)
    columns = ["event_id", "symbol", "open_ts", "close", "number_of_trades"]
    early = rows.filter(F.col("open_ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    late = rows.filter(F.col("open_ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    widened = late.withColumn("number_of_trades", F.col("number_of_trades").cast("double"))
    return early.select(*columns).unionByName(widened.select(*reversed(columns)))


@run(
    O.query(
        "SELECT count(*) AS rows_written, count(*) AS rows_read, true AS verified FROM silver",
        ("silver",),
    )
)
def copy_verify(spark: SparkSession, sf: str) -> DataFrame:
    source = new_folder(spark, "layer")
    store.write_layer(T.silver(spark, sf), source)
    return store.verified_copy(spark, source, new_folder(spark, "copy"))


@run(
    O.query(
        "SELECT count(*) AS rows, true AS has_files, true AS has_size FROM bars", ("bars",)
    )
)
def stored_size(spark: SparkSession, sf: str) -> DataFrame:
    """The stored bar layer has files and a size, which depend on the encoder, and all rows."""
    folder = new_folder(spark, "layer")
    store.write_sorted(T.hour_bars(spark, sf), folder, ["symbol", "open_ts"], unique=True)
    n = spark.read.parquet(folder).count()
    return store.stored_size(spark, folder).select(
        F.lit(n).cast("long").alias("rows"),
        (F.col("files") > 0).alias("has_files"),
        (F.col("megabytes") > 0).alias("has_size"),
    )


# Each document is an archive of its text; every 7th loses its end.
_SPOILED = "doc_id % 7 = 3"


def _zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        contents = []
        for text, spoiled in zip(batch["text"], batch["spoiled"]):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("member.csv", text)
            content = bytearray(out.getvalue())
            if spoiled:
                # A wrong byte of the stored checksum, met at the member's end.
                content[content.index(b"PK\x01\x02") + 16] ^= 0xFF
            contents.append(bytes(content))
        yield pd.DataFrame({"path": "file:/in/" + batch["name"], "content": contents})


@run(
    O.query(
        f"""SELECT zip_filename, extract_ok,
              CASE WHEN extract_ok THEN len(lines) ELSE 0 END AS lines,
              CASE WHEN extract_ok THEN CAST(coalesce(list_sum(list_transform(lines,
                lambda x: length(x))), 0) AS BIGINT) ELSE 0 END AS chars
            FROM (SELECT {_DOC_NAME.format(text='VARCHAR')} AS zip_filename,
                    NOT ({_SPOILED}) AS extract_ok,
                    CASE WHEN text = '' THEN [] ELSE
                      string_split(regexp_replace(text, chr(10) || '$', ''), chr(10)) END AS lines
                  FROM documents)"""
    )
)
def archive_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Archives made in Spark and unpacked; damaged ones give no line."""
    docs = T.table(spark, sf, "documents").select(
        F.expr(_DOC_NAME.format(text="STRING")).alias("name"), "text",
        F.expr(_SPOILED).alias("spoiled"),
    )
    files = stage(docs.mapInPandas(_zipped, "path string, content binary"), "archives")
    lines = stage(archives.unpack(files), "lines")
    status = archives.extraction_status(lines)
    counted = (
        archives.whole_lines(lines, status)
        .groupBy("zip_filename")
        .agg(F.count("line").alias("lines"), F.sum(F.length("line")).alias("chars"))
    )
    return (
        docs.select(F.col("name").alias("zip_filename"))
        .join(status, "zip_filename", "left")
        .join(counted, "zip_filename", "left")
        .select(
            "zip_filename",
            F.coalesce("extract_ok", F.lit(True)).alias("extract_ok"),
            F.coalesce("lines", F.lit(0)).alias("lines"),
            F.coalesce("chars", F.lit(0)).cast("long").alias("chars"),
        )
    )


_CARD = "concat(CAST(s_suppkey AS {text}), '|', s_name)"
# Files that a task writes.
_CARDS_PER_TASK = 1_000


def _card_writer(folder: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Writes each card to a file of its own; a task that runs again writes the same ones.

    Spark's writers take milliseconds per file, as they set its rights by a
    process of its own on a local store.
    """

    find = archives.file_system

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, root = find(folder)
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for card in batch["card"]:
                with target.open_output_stream(f"{root}/part-{task:05d}-{n}.txt") as file:
                    file.write(f"{card or ''}\n".encode())
                n += 1
        yield pd.DataFrame({"files": [n]})

    return write


@run(
    O.query(
        f"""SELECT sha256({_CARD.format(text='VARCHAR')} || chr(10)) AS actual_hash,
              CAST(octet_length(encode({_CARD.format(text='VARCHAR')})) + 1 AS BIGINT)
                AS zip_size_bytes
            FROM supplier"""
    )
)
def landed_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes and SHA-256 digests of stored files, one per supplier, read as bytes."""
    folder = new_folder(spark, "landed")
    cards = T.table(spark, sf, "supplier").select(F.expr(_CARD.format(text="STRING")).alias("card"))
    # A number of its own, as adaptive execution would take so few bytes to one task.
    tasks = min(cards.count() // _CARDS_PER_TASK + 1, archives.MEMBER_TASKS)
    target, root = archives.file_system(folder)
    target.create_dir(root, recursive=True)
    cards.repartition(tasks).mapInPandas(_card_writer(folder), "files long").collect()
    return archives.landed_files(spark, folder, "*.txt").select("actual_hash", "zip_size_bytes")
