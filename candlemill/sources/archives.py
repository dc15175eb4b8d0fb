"""Monthly archives: manifest, checksums, what is still to fetch, unpacking."""

from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.session import stage

LOG_COLUMNS = [
    "timestamp", "period", "zip_filename", "zip_url", "checksum_url",
    "download_ok", "checksum_ok", "extract_ok", "zip_size_bytes",
    "expected_hash", "actual_hash",
]

_LINES_PER_BATCH = 20_000
# Larger files are read in pieces for their digest, as no row can hold them.
ROW_BYTES = 256 << 20
# Tasks that members of archives are dealt to at most; further members share them.
MEMBER_TASKS = 10_000
# What a damaged archive raises; anything else is a fault of its own.
_DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)


def month_periods(
    spans: DataFrame, keys: Sequence[str], first: str, last: str
) -> DataFrame:
    """One row per calendar month from ``first`` to ``last``, both included."""
    start, end = (
        F.date_trunc("MONTH", F.col(c).cast("timestamp")).cast("date") for c in (first, last)
    )
    months = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month")))
    return spans.select(*keys, F.explode(months).alias("_month")).select(
        *keys,
        F.year("_month").alias("year"),
        F.month("_month").alias("month"),
        F.date_format("_month", "yyyy-MM").alias("period"),
    )


def manifest(
    periods: DataFrame, base_url: str, interval: str = "1m", symbol: str = "symbol"
) -> DataFrame:
    """Archive and checksum names and addresses of every (symbol, month)."""
    name = F.format_string(
        "%s-%s-%d-%02d.zip", F.col(symbol), F.lit(interval), F.col("year"), F.col("month")
    )
    base = F.concat(F.lit(base_url.rstrip("/") + "/"), F.col(symbol), F.lit(f"/{interval}/"))
    return (
        periods.withColumn("zip_filename", name)
        .withColumn("checksum_filename", F.concat("zip_filename", F.lit(".CHECKSUM")))
        .withColumn("zip_url", F.concat(base, F.col("zip_filename")))
        .withColumn("checksum_url", F.concat(base, F.col("checksum_filename")))
    )


def open_file(path: str) -> BinaryIO:
    """Open a file for reading at any place, by the path that Spark gives it.

    Knows local paths and what Arrow's file systems know; pass another function
    where a store needs settings of its own.
    """
    store, inside = file_system(path)
    if isinstance(store, fs.LocalFileSystem):
        return open(inside, "rb")
    return store.open_input_file(inside)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path as Spark gives it, and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if rest else path
    return fs.FileSystem.from_uri("s3:" + rest if scheme in ("s3a", "s3n") else path)


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``path``, ``length`` and, if asked for, ``content`` of the files that are not empty."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def landed_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.zip",
    opener: Callable[[str], BinaryIO] = open_file,
) -> DataFrame:
    """Names, sizes and SHA-256 digests of the archives in ``folder``, of any size."""
    files = _listed(spark, folder, pattern)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["path"]:
                with opener(path) as file:
                    found.append(hashlib.file_digest(file, "sha256").hexdigest())
            yield batch.assign(actual_hash=found)

    whole = files.where(F.col("length") <= ROW_BYTES).select(
        "path", "length", F.sha2("content", 256).alias("actual_hash")
    )
    large = files.where(F.col("length") > ROW_BYTES).select("path", "length")
    both = whole.union(large.mapInPandas(digests, "path string, length long, actual_hash string"))
    return both.select(
        F.element_at(F.split("path", "/"), -1).alias("zip_filename"),
        F.col("length").alias("zip_size_bytes"),
        "actual_hash",
    )


def pending(listed: DataFrame, landed: DataFrame) -> DataFrame:
    """Archives not yet there, or there but empty."""
    done = landed.filter(F.col("zip_size_bytes") > 0).select("zip_filename")
    return listed.join(done, "zip_filename", "left_anti")


def verify_checksums(
    listed: DataFrame, landed: DataFrame, checksums: DataFrame
) -> DataFrame:
    """Compare each landed archive with its checksum text.

    ``checksum_ok`` is true, false, or NULL when there is nothing to compare
    with: no archive, no text, or a blank one. Only the first word of the text
    counts. ``checksums`` has ``zip_filename`` and ``checksum_text``.
    """
    word = F.lower(F.nullif(F.regexp_extract("checksum_text", r"(\S+)", 1), F.lit("")))
    expected = checksums.select("zip_filename", word.alias("expected_hash"))
    known = F.col("expected_hash").isNotNull()
    joined = listed.join(landed, "zip_filename", "left").join(expected, "zip_filename", "left")
    return joined.withColumns(
        {
            "download_ok": F.coalesce(F.col("zip_size_bytes") > 0, F.lit(False)),
            "zip_size_bytes": F.coalesce("zip_size_bytes", F.lit(0)),
            "actual_hash": F.when(known, F.lower("actual_hash")),
            "checksum_ok": F.col("expected_hash") == F.lower("actual_hash"),
        }
    )


def usable(verified: DataFrame) -> DataFrame:
    """Landed archives that are not proven wrong."""
    return verified.filter(F.col("download_ok") & F.coalesce("checksum_ok", F.lit(True)))


def ingest_log(verified: DataFrame, extracted: DataFrame) -> DataFrame:
    """One audit row per archive; ``extracted`` has ``zip_filename, extract_ok``."""
    return (
        verified.join(extracted, "zip_filename", "left")
        .withColumn("extract_ok", F.coalesce("extract_ok", F.lit(False)))
        .withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
        .select(*LOG_COLUMNS)
    )


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").option("compression", "zstd").parquet(path)


_LINES = "zip_filename string, member string, line string, ok boolean"


def _lines(path: str, member: str | None, lines: list[str | None], ok: bool) -> pd.DataFrame:
    name = path.rsplit("/", 1)[-1]
    return pd.DataFrame({"zip_filename": name, "member": member, "line": lines, "ok": ok})


def _member_lines(archive: zipfile.ZipFile, name: str) -> Iterator[list[str]]:
    """Lines of a member in bounded batches."""
    lines: list[str] = []
    with archive.open(name) as member:
        for line in io.TextIOWrapper(member, "utf-8", errors="replace"):
            lines.append(line.rstrip("\r\n"))
            if len(lines) == _LINES_PER_BATCH:
                yield lines
                lines = []
    if lines:
        yield lines


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        for lines in _member_lines(archive, name):
                            yield _lines(path, name, lines, True)
            except _DAMAGE:
                yield _lines(path, None, [None], False)


def unpack(files: DataFrame) -> DataFrame:
    """Lines of all members of archives given by ``path`` and ``content``.

    A damaged archive adds a row that is not ``ok`` to what could be read of
    it; ``whole_lines`` leaves such archives out. A task passes lines on in
    batches, so it never holds a whole unpacked archive. For archives in files
    ``archive_lines`` holds no packed one either.
    """
    return files.select("path", "content").mapInPandas(_unpack, _LINES)


def archive_members(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.zip",
    opener: Callable[[str], BinaryIO] = open_file,
) -> DataFrame:
    """``path``, ``member`` and unpacked ``size`` of all members of the archives in a folder.

    Tasks read the tables of contents at the ends of the files. An archive
    without a readable one has a row with a null member.
    """

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path in (path for batch in batches for path in batch["path"]):
            try:
                with opener(path) as file, zipfile.ZipFile(file) as archive:
                    found = [(i.filename, i.file_size) for i in archive.infolist()]
            except _DAMAGE:
                found = [(None, None)]
            if found:
                names, sizes = zip(*found)
                sizes = pd.array(sizes, dtype="Int64")
                yield pd.DataFrame({"path": path, "member": names, "size": sizes})

    files = _listed(spark, folder, pattern).select("path")
    return files.mapInPandas(contents, "path string, member string, size long")


def archive_lines(
    spark: SparkSession,
    path: str,
    pattern: str = "*.zip",
    opener: Callable[[str], BinaryIO] = open_file,
) -> DataFrame:
    """Lines of the archives in a folder, as ``unpack`` gives them.

    Members are dealt to tasks of their own and read from their place in the
    file, so no task holds an archive or a member, whatever their size. Runs a
    job.
    """
    members = stage(archive_members(spark, path, pattern, opener), "members")
    tasks = max(1, min(members.count(), MEMBER_TASKS))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name in zip(batch["path"], batch["member"]):
                if name is None:
                    yield _lines(path, None, [None], False)
                    continue
                try:
                    with opener(path) as file, zipfile.ZipFile(file) as archive:
                        for lines in _member_lines(archive, name):
                            yield _lines(path, name, lines, True)
                except _DAMAGE:
                    yield _lines(path, name, [None], False)

    return members.select("path", "member").repartition(tasks).mapInPandas(read, _LINES)


def extraction_status(lines: DataFrame) -> DataFrame:
    return lines.groupBy("zip_filename").agg(F.min("ok").alias("extract_ok"))


def whole_lines(lines: DataFrame, status: DataFrame) -> DataFrame:
    """Lines of archives that unpacked to their end; ``lines`` should be staged."""
    good = status.where("extract_ok").select("zip_filename")
    return lines.where("ok").join(good, "zip_filename", "left_semi")
