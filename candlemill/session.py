"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Naive timestamps mean UTC everywhere in this package.
TIME_ZONE = "UTC"

_local_folder: str | None = None


def get_session(app_name: str = "candlemill", **conf: object) -> SparkSession:
    """Session with the settings the operators rely on; ``conf`` adds more."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def object_store_conf(env: dict[str, str] | None = None) -> dict[str, str]:
    """S3A settings from the environment; credentials never live in code.

    Reads ``S3A_ENDPOINT``, ``S3A_ACCESS_KEY``, ``S3A_SECRET_KEY`` and
    ``S3A_SSL``. Unset names are left to the cluster's own configuration.
    """
    env = dict(os.environ) if env is None else env
    conf = {
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    for name, key in (
        ("S3A_ENDPOINT", "spark.hadoop.fs.s3a.endpoint"),
        ("S3A_ACCESS_KEY", "spark.hadoop.fs.s3a.access.key"),
        ("S3A_SECRET_KEY", "spark.hadoop.fs.s3a.secret.key"),
        ("S3A_SSL", "spark.hadoop.fs.s3a.connection.ssl.enabled"),
    ):
        if env.get(name):
            conf[key] = env[name]
    return conf


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, so that epoch and naive timestamps agree."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one in ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it then gets a
    temporary folder, which no other machine has to see and which goes with
    the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="candlemill-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody has used yet, inside the shared folder.

    Grouped by application, so that what a finished run left can be removed.
    """
    root = shared_folder(spark).rstrip("/")
    return f"{root}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Cuts the lineage so that it survives lost executors, fixes the values of
    position columns, and keeps column pruning for whoever reads it next.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, **columns: tuple[pa.DataType, Sequence]) -> DataFrame:
    """A table of driver-side values, kept in the plan: no Python workers."""
    arrays = {name: pa.array(list(values), kind) for name, (kind, values) in columns.items()}
    return spark.createDataFrame(pa.table(arrays))


def range_sort(df: DataFrame, by: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows in ``by`` order over partitions of similar size that follow each other.

    Unless ``by`` is ``unique``, rows that tie on it are ordered by content,
    and identical ones by their place, so that many copies of a row still
    spread over partitions. Places are taken after a local sort: a task that
    runs again numbers its rows as it did before.
    """
    if unique:
        return df.repartitionByRange(*by).sortWithinPartitions(*by)
    content = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    # The local sort only has to be repeatable; a hash sorts fastest.
    placed = (
        df.withColumn("_content", F.xxhash64(*content))
        .sortWithinPartitions("_content", *by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    full = [*by, "_content", "_place"]
    return placed.repartitionByRange(*full).sortWithinPartitions(*full).drop(*full[-2:])
