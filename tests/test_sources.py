import hashlib
import io
import zipfile
from datetime import date
from pathlib import Path

import pytest
from helpers import minute, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from candlemill.session import object_store_conf
from candlemill.plans import ingest, layers
from candlemill.sources import archives, klines, store

LINE = "{t},1.0,2.0,0.5,1.5,10,{u},15,3,5,7.5,0"


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    good = LINE.format(t=1704067200000, u=1704067259999)
    (folder / "ABC-1m-2024-01.csv").write_text(
        "\n".join([good, good.replace("1.0,", "x,", 1), "1704067260000,1.0",
                   good.replace(",1.5,", ",,", 1), good + ",extra", good.replace("2.0", "NaN")])
    )
    (folder / "other.csv").write_text(good)
    (folder / "notes.txt").write_text(good)
    return str(folder)


def test_csv_scan(spark, csv_folder):
    df = klines.read_bronze(spark, csv_folder)
    assert rows_of(df, "source_file", "symbol", "file_period", "file_year", "file_month") == [
        ("ABC-1m-2024-01.csv", "ABC", "2024-01", 2024, 1),
        ("ABC-1m-2024-01.csv", "ABC", "2024-01", 2024, 1),
        ("other.csv", None, None, None, None),
    ]
    row = df.filter("symbol is not null").first()
    assert (row.open_time, row.open, row.number_of_trades, row.ignore) == (
        1704067200000, 1.0, 3, 0.0)


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        klines.read_raw(spark, str(tmp_path / "absent"))


def test_month_periods(frame):
    spans = frame([("ABC", date(2019, 1, 1), date(2026, 2, 28)), ("X", None, None)],
                  "symbol string, a date, b date")
    months = archives.month_periods(spans, ["symbol"], "a", "b")
    got = rows_of(months, "period")
    assert len(got) == 86 and got[0] == ("2019-01",) and got[-1] == ("2026-02",)
    backwards = frame(
        [("ABC", date(2024, 3, 1), date(2024, 2, 1))], "symbol string, a date, b date")
    assert archives.month_periods(backwards, ["symbol"], "a", "b").count() == 0


def test_manifest_names(frame):
    periods = frame([("ABC", 2019, 1)], "symbol string, year int, month int")
    row = archives.manifest(periods, "https://archive.example/data/").first()
    assert row.zip_filename == "ABC-1m-2019-01.zip"
    assert row.checksum_url == (
        "https://archive.example/data/ABC/1m/ABC-1m-2019-01.zip.CHECKSUM")


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    with zipfile.ZipFile(folder / "a.zip", "w") as z:
        z.writestr("a1.csv", "1\r\n2\n")
        z.writestr("a2.csv", "3")
        z.writestr("empty.csv", "")
    (folder / "bad.zip").write_bytes(b"PK not an archive")
    (folder / "none.zip").write_bytes(b"")
    return folder


def test_archives(spark, landing):
    lines = archives.archive_lines(spark, str(landing))
    assert rows_of(lines.filter("ok"), "zip_filename", "member", "line") == [
        ("a.zip", "a1.csv", "1"), ("a.zip", "a1.csv", "2"), ("a.zip", "a2.csv", "3")]
    assert rows_of(archives.extraction_status(lines), "zip_filename", "extract_ok") == [
        ("a.zip", True), ("bad.zip", False)]


def test_members_are_read_by_tasks_of_their_own(spark, landing, monkeypatch):
    with zipfile.ZipFile(landing / "b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(12):
            z.writestr(f"in/b{i}.csv", "x\n" * i)
    content = bytearray((landing / "b.zip").read_bytes())
    content[content.index(b"PK\x01\x02") + 16] ^= 0xFF  # the stored checksum of b0
    (landing / "c d.zip").write_bytes(bytes(content))
    with zipfile.ZipFile(landing / "nothing.zip", "w"):
        pass
    members = archives.archive_members(spark, str(landing))
    assert members.where("member IS NULL").count() == 1
    assert members.where("path LIKE '%b.zip'").agg(F.sum("size")).first()[0] == 2 * 66
    lines = archives.archive_lines(spark, str(landing))
    assert lines.rdd.getNumPartitions() == members.count()
    assert rows_of(archives.extraction_status(lines), "zip_filename", "extract_ok") == [
        ("a.zip", True), ("b.zip", True), ("bad.zip", False), ("c d.zip", False)]
    whole = archives.whole_lines(lines, archives.extraction_status(lines))
    assert whole.where("zip_filename = 'b.zip'").groupBy("member").count().count() == 11
    monkeypatch.setattr(archives, "MEMBER_TASKS", 2)
    fewer = archives.archive_lines(spark, str(landing))
    assert fewer.rdd.getNumPartitions() == 2
    assert rows_of(fewer, *lines.columns) == rows_of(lines, *lines.columns)


def test_archives_that_no_row_can_hold(spark, tmp_path):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("a.csv", "1\n2\n")
    with open(tmp_path / "large.zip", "wb") as file:
        file.truncate(2**31 + 5)  # a hole on disk; archives may begin with other bytes
        file.seek(0, 2)
        file.write(packed.getvalue())
    lines = archives.archive_lines(spark, str(tmp_path))
    assert rows_of(lines, "member", "line", "ok") == [("a.csv", "1", True), ("a.csv", "2", True)]
    row = archives.landed_files(spark, str(tmp_path)).first()
    with open(tmp_path / "large.zip", "rb") as file:
        assert row.actual_hash == hashlib.file_digest(file, "sha256").hexdigest()
    assert row.zip_size_bytes == 2**31 + 5 + len(packed.getvalue())


def test_checksums_and_gate(spark, frame, landing, tmp_path):
    files = archives.landed_files(spark, str(landing))
    digest = hashlib.sha256((landing / "a.zip").read_bytes()).hexdigest()
    assert files.filter("zip_filename = 'a.zip'").first().actual_hash == digest
    names = ["a.zip", "bad.zip", "none.zip", "absent.zip"]
    listed = frame(
        [(n, f"p{i}") for i, n in enumerate(names)], "zip_filename string, period string")
    texts = frame(
        [("a.zip", f"\n{digest.upper()}  a.zip"), ("bad.zip", "0000 bad.zip"),
         ("none.zip", " \n "), ("absent.zip", digest)],
        "zip_filename string, checksum_text string",
    )
    verified = archives.verify_checksums(listed, files, texts)
    got = {r.zip_filename: r for r in verified.collect()}
    assert [got[n].checksum_ok for n in names] == [True, False, None, None]
    assert [got[n].download_ok for n in names] == [True, True, False, False]
    assert got["none.zip"].expected_hash is None and got["none.zip"].actual_hash is None
    no_text = archives.verify_checksums(listed, files, texts.filter("false"))
    assert rows_of(archives.usable(no_text), "zip_filename") == [("a.zip",), ("bad.zip",)]
    assert rows_of(archives.usable(verified), "zip_filename") == [("a.zip",)]
    assert rows_of(archives.pending(listed, files), "zip_filename") == [
        ("absent.zip",), ("none.zip",)]

    url = verified.withColumns({"zip_url": F.lit("u"), "checksum_url": F.lit("c")})
    done = frame([("a.zip", True)], "zip_filename string, extract_ok boolean")
    log, path = archives.ingest_log(url, done), str(tmp_path / "log")
    archives.append_log(log, path)
    archives.append_log(log, path)
    back = spark.read.parquet(path)
    assert back.columns == archives.LOG_COLUMNS and back.count() == 8
    assert back.filter("extract_ok").count() == 2


def test_write_count_copy_and_size(spark, frame, tmp_path):
    df = frame([(i, f"{i % 3}") for i in range(50)], "a int, b string")
    path = str(tmp_path / "layer")
    assert store.write_layer(df, path) == 50
    assert store.write_sorted(df, path, ["a"]) == 50
    row = store.verified_copy(spark, path, str(tmp_path / "copy")).first()
    assert (row.rows_written, row.rows_read, row.verified) == (50, 50, True)
    size = store.stored_size(spark, path).first()
    files = list(Path(path).glob("*.parquet"))
    assert size.files == len(files) and all(".zstd." in f.name for f in files)
    assert size.megabytes == pytest.approx(sum(f.stat().st_size for f in files) / 2**20)


def test_quarters_hold_all_rows_in_time_order(spark, frame, tmp_path):
    rows = [(minute(i * 1_440 * 5), "ABC"[i % 3]) for i in range(120)]
    df = frame(rows, "open_ts timestamp_ntz, symbol string").withColumn(
        "year_quarter", F.concat(F.year("open_ts"), F.lit("-Q"), F.quarter("open_ts")))
    path = tmp_path / "quarters"
    assert store.write_quarters(df, str(path), ["open_ts", "symbol"]) == 120
    folders = sorted(p.name for p in path.glob("year_quarter=*"))
    assert folders[0] == "year_quarter=2024-Q1" and len(folders) == 7
    assert rows_of(spark.read.parquet(str(path)), *df.columns) == rows_of(df, *df.columns)
    for file in path.glob("*/*.parquet"):
        times = [r.open_ts for r in spark.read.parquet(str(file)).collect()]
        assert times == sorted(times)


def test_report_is_one_file(frame, tmp_path):
    table = frame([("b", 2), ("a", 1)], "k string, n int").repartition(3)
    store.write_report(table, str(tmp_path / "t"), ["k"])
    (file,) = (tmp_path / "t").glob("*.csv")
    assert file.read_text() == "k,n\na,1\nb,2\n"


def test_object_store_settings_come_from_the_environment():
    conf = object_store_conf({"S3A_ENDPOINT": "http://store:9000", "S3A_ACCESS_KEY": "k"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert "spark.hadoop.fs.s3a.secret.key" not in conf


def test_ingest_stage(spark, frame, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    line = LINE.format(t=1704067200000, u=1704067259999)
    digests = {}
    for month, content in (("01", f"{line}\n{line},extra\n"), ("02", line), ("03", "")):
        path = landing / f"ABC-1m-2024-{month}.zip"
        with zipfile.ZipFile(path, "w") as z:
            z.writestr(f"ABC-1m-2024-{month}.csv", content)
        digests[month] = hashlib.sha256(path.read_bytes()).hexdigest()
    (landing / "ABC-1m-2024-04.zip").write_bytes(b"broken")
    spans = frame([("ABC", date(2024, 1, 1), date(2024, 5, 31))],
                  "symbol string, a date, b date")
    texts = frame([("ABC-1m-2024-01.zip", digests["01"]), ("ABC-1m-2024-02.zip", "0 wrong")],
                  "zip_filename string, checksum_text string")
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    left = ingest.ingest(
        spark, archives.month_periods(spans, ["symbol"], "a", "b"), "https://archive.example",
        str(landing), texts, bronze, log)
    assert rows_of(left, "period") == [("2024-05",)]
    assert rows_of(spark.read.parquet(bronze), "source_file", "open", "close_time") == [
        ("ABC-1m-2024-01.csv", 1.0, 1704067259999)] * 2
    assert rows_of(spark.read.parquet(log), "period", "download_ok", "checksum_ok",
                   "extract_ok") == [
        ("2024-01", True, True, True), ("2024-02", True, False, False),
        ("2024-03", True, None, True), ("2024-04", True, None, False),
        ("2024-05", False, None, False)]


def test_a_damaged_archive_gives_no_rows(spark, frame, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    line = LINE.format(t=1704067200000, u=1704067259999)
    for month, n in (("01", 3), ("02", 44_640)):
        path = landing / f"ABC-1m-2024-{month}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"ABC-1m-2024-{month}.csv", f"{line}\n" * n)
    content = bytearray(path.read_bytes())
    content[content.index(b"PK\x01\x02") + 16] ^= 1  # the stored checksum
    path.write_bytes(bytes(content))
    spans = frame([("ABC", date(2024, 1, 1), date(2024, 2, 28))], "symbol string, a date, b date")
    texts = frame([], "zip_filename string, checksum_text string")
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    ingest.ingest(
        spark, archives.month_periods(spans, ["symbol"], "a", "b"), "https://archive.example",
        str(landing), texts, bronze, log)
    rows = spark.read.parquet(bronze)
    assert {r.source_file for r in rows.collect()} == {"ABC-1m-2024-01.csv"} and rows.count() == 3
    assert rows_of(spark.read.parquet(log), "period", "extract_ok") == [
        ("2024-01", True), ("2024-02", False)]


def test_an_empty_folder_raises_and_leaves_the_layer(spark, frame, tmp_path):
    bronze, empty = str(tmp_path / "bronze"), tmp_path / "csv"
    empty.mkdir()
    store.write_layer(frame([(1,)], "a int"), bronze)
    with pytest.raises(FileNotFoundError, match="csv"):
        layers.build_bronze(spark, str(empty), bronze)
    assert spark.read.parquet(bronze).count() == 1


def test_growing_reports_follow_their_order(frame, tmp_path):
    table = frame([(i % 7, i) for i in range(400)], "k int, n int").repartition(3)
    store.write_report(table, str(tmp_path / "t"), ["k", "n"], single=False)
    files = sorted((tmp_path / "t").glob("*.csv"))
    rows = [tuple(map(int, x.split(","))) for f in files for x in f.read_text().split("\n")[1:] if x]
    assert rows == sorted((i % 7, i) for i in range(400))


def test_everything_is_pending_before_the_first_archive(spark, frame, tmp_path):
    listed = frame([("a.zip",)], "zip_filename string")
    assert archives.pending(listed, archives.landed_files(spark, str(tmp_path))).count() == 1


def test_ingest_of_nothing(spark, frame, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "ABC-1m-2024-01.zip").write_bytes(b"broken")
    spans = frame([("ABC", date(2024, 1, 1), date(2024, 1, 31))], "symbol string, a date, b date")
    texts = frame([("ABC-1m-2024-01.zip", "0")], "zip_filename string, checksum_text string")
    left = ingest.ingest(
        spark, archives.month_periods(spans, ["symbol"], "a", "b"), "https://archive.example",
        str(landing), texts, str(tmp_path / "bronze"), str(tmp_path / "log"))
    assert left.count() == 0
    assert spark.read.parquet(str(tmp_path / "log")).first().extract_ok is False


def test_landed_digests_of_files_from_several_tasks(spark, tmp_path):
    import duckdb

    from workload.queries import QUERIES, SQL

    rows = [(i, f"Supplier#{i} é") for i in range(2_300)] + [(7, "again"), (7, "again"), (None, "x"), (8, None)]
    suppliers = spark.createDataFrame(rows, "s_suppkey long, s_name string")
    suppliers.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    known = {p for p in Path(spark.conf.get("spark.checkpoint.dir")).glob("*/landed-*")}
    found = QUERIES["landed_digests"](spark, str(tmp_path))
    got = sorted((r["actual_hash"], r["zip_size_bytes"]) for r in found.collect())
    cards = [f"{key}|{name}\n".encode() if key is not None and name is not None else b"\n" for key, name in rows]
    assert got == sorted((hashlib.sha256(c).hexdigest(), len(c)) for c in cards)
    (folder,) = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("*/landed-*")) - known
    parts = {p.name.split("-")[1] for p in folder.glob("part-*.txt")}
    assert len(parts) >= 3
