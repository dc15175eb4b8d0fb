"""The candles as a stream that is read to its end; open results are not given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.operators import clean
from candlemill.session import new_folder
from candlemill.streaming.bars import stream_bars as closed_bars
from candlemill.streaming.clean import stream_keep_first, stream_silver
from candlemill.streaming.features import stream_minute_features
from workload import oracle as O
from workload import tables as T
from workload.queries.shared import rounded, run

_LATE_BY = "10 minutes"
# The time up to which the stream is final: its watermark after the last row.
_FINAL = "(SELECT max(open_ts) - INTERVAL 10 MINUTE FROM {source})"


def _klines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw candles of a stream over the file or folder of events."""
    schema = T.table(spark, sf, "events").schema
    # A pattern, as a stream takes no single file.
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return spark.sql(T.KLINES_SPARK, events=events)


def _drained(rows: DataFrame) -> DataFrame:
    """What a stream gives once its source is exhausted."""
    spark = rows.sparkSession
    path = new_folder(spark, "stream")
    query = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", new_folder(spark, "stream-state"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.schema(rows.schema).parquet(path)
    naive = F.col("open_ts").cast("timestamp_ntz")
    return found.withColumn("open_ts", naive)


@run(
    O.query(
        "SELECT symbol, open_ts, source_file, event_id, open, close FROM first_rows "
        f"WHERE open_ts <= {_FINAL.format(source='present')}",
        ("first_rows",),
    )
)
def stream_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    present = clean.with_timestamps(clean.not_null_rows(clean.typed(_klines(spark, sf))))
    kept = stream_keep_first(present, T.KEYS, T.TIEBREAK, _LATE_BY)
    return _drained(kept).select("symbol", "open_ts", "source_file", "event_id", "open", "close")


_BAR = "symbol open_ts open high low close volume rows_in_bar"


@run(
    O.query(
        f"SELECT {', '.join(_BAR.split())} FROM bars "
        f"WHERE open_ts + INTERVAL 1 HOUR <= {_FINAL.format(source='present')}",
        ("bars",), "open high low close volume",
    )
)
def stream_bars(spark: SparkSession, sf: str) -> DataFrame:
    rows = stream_silver(_klines(spark, sf), T.KEYS, T.TIEBREAK, _LATE_BY)
    return rounded(_drained(closed_bars(rows)).select(*_BAR.split()))


_CHANGES = "close_diff_1m return_1m log_return_1m abs_log_return_1m volatility_60 range_hl_pct"


@run(
    O.query(
        f"SELECT symbol, open_ts, event_id, {', '.join(_CHANGES.split())} FROM bronze_1m "
        f"WHERE open_ts <= {_FINAL.format(source='bronze')}",
        ("bronze_1m",), _CHANGES,
    )
)
def stream_returns(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.with_timestamps(clean.bronze_rows(_klines(spark, sf)))
    found = stream_minute_features(rows, T.KEYS, T.TIEBREAK, _LATE_BY)
    return rounded(_drained(found).select("symbol", "open_ts", "event_id", *_CHANGES.split()))
