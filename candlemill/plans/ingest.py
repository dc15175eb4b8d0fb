"""From landed archives to bronze rows and an audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.session import stage
from candlemill.sources import archives, klines, store


def ingest(
    spark: SparkSession,
    periods: DataFrame,
    base_url: str,
    landing: str,
    checksums: DataFrame,
    bronze_path: str,
    log_path: str,
    interval: str = "1m",
) -> DataFrame:
    """Verify what has landed, unpack what is not proven wrong, keep a log.

    ``periods`` has ``symbol, year, month, period``; ``landing`` is the folder
    of archives; ``checksums`` has ``zip_filename, checksum_text``. An archive
    gives all its rows or, when it is damaged, none; bronze is written if any
    archive is whole. Returns the manifest rows still to be fetched.
    """
    folder = landing.rstrip("/")
    listed = archives.manifest(periods, base_url, interval)
    landed = stage(archives.landed_files(spark, folder), "landed")
    verified = stage(archives.verify_checksums(listed, landed, checksums), "verified")
    names = archives.usable(verified).select("zip_filename")
    lines = archives.archive_lines(spark, folder)
    lines = stage(lines.join(names, "zip_filename", "left_semi"), "lines")
    # An archive whose members are all empty has no lines; it is fine too.
    status = names.join(archives.extraction_status(lines), "zip_filename", "left")
    status = stage(
        status.select("zip_filename", F.coalesce("extract_ok", F.lit(True)).alias("extract_ok")),
        "status",
    )
    if not status.where("extract_ok").isEmpty():
        whole = archives.whole_lines(lines, status)
        rows = klines.to_bronze(klines.parse_lines(whole))
        store.write_sorted(rows, bronze_path, ["symbol", "open_time", "source_file"])
    archives.append_log(archives.ingest_log(verified, status), log_path)
    return archives.pending(listed, landed)
