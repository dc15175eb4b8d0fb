"""Returns and rolling statistics of a stream of candles.

Per series the state holds the rows that the watermark has not passed yet and a
ring of the last rows before them, as many as the widest window looks back. When
the watermark passes a row, no earlier one can come any more: a timer takes it
in its place in order, it gets its statistics and enters the ring.

Windows count rows, as in batch. The state of a series is bounded by the widest
window and the rows inside the watermark's delay, but a first batch may be a
whole table, as no watermark has passed any of it. So waiting rows lie in the
state store as sorted runs of small blocks, which are merged a few blocks at a
time: a task holds some ten thousand rows of a series, however many it has.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from candlemill.functions import candle as C
from candlemill.operators.features import DAY_BARS, MINUTE_WINDOW, WEEK_BARS
from candlemill.streaming.clean import timed_by

# Rows whose windows are laid out at a time.
_ROWS_AT_ONCE = 4_096
# Waiting rows of a block, of a run as it comes in, and runs of one size that
# are merged into a larger one.
BLOCK_ROWS = 2_048
RUN_ROWS = 65_536
RUNS_OF_A_SIZE = 8
# The store that keeps state on disk, and the setting that names it.
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class Step:
    """A new column from ``column``: a change from the row before, or a rolling statistic.

    ``kind`` is difference, simple_return, log_return, log_difference, absolute,
    mean or std; the last two look at ``rows`` rows and are missing until all of
    them have a value.
    """

    name: str
    kind: str
    column: str
    rows: int = 1


BAR_STEPS = (
    Step("return_1h", "simple_return", "close"),
    Step("log_return_1h", "log_return", "close"),
    Step("sma_24h", "mean", "close", DAY_BARS),
    Step("sma_168h", "mean", "close", WEEK_BARS),
    Step("volatility_24h", "std", "log_return_1h", DAY_BARS),
    Step("volume_sma_24h", "mean", "volume", DAY_BARS),
)
MINUTE_STEPS = (
    Step("close_diff_1m", "difference", "close"),
    Step("return_1m", "simple_return", "close"),
    Step("log_return_1m", "log_return", "close"),
    Step("log_diff_close_1m", "log_difference", "close"),
    Step("abs_log_return_1m", "absolute", "log_return_1m"),
    Step("volatility_60", "std", "log_return_1m", MINUTE_WINDOW),
)


def lookback(steps: Sequence[Step]) -> int:
    """How many rows before a row its columns depend on."""
    back: dict[str, int] = {}
    for s in steps:
        own = s.rows - 1 if s.kind in ("mean", "std") else int(s.kind != "absolute")
        back[s.name] = own + back.get(s.column, 0)
    return max(back.values(), default=0)


def _log(x: np.ndarray) -> np.ndarray:
    return np.log(np.where(x > 0, x, np.nan))


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.where(b == 0, np.nan, b)


def _rolled(values: np.ndarray, rows: int, std: bool) -> np.ndarray:
    """Mean or deviation of the last ``rows`` values, missing unless all of them are there."""
    out = np.full(len(values), np.nan)
    if len(values) < rows:
        return out
    frames = np.lib.stride_tricks.sliding_window_view(values, rows)
    for a in range(0, len(frames), _ROWS_AT_ONCE):
        some = frames[a : a + _ROWS_AT_ONCE]
        at = slice(rows - 1 + a, rows - 1 + a + len(some))
        if not std:
            out[at] = some.mean(axis=1)
        elif rows > 1:
            out[at] = some.std(axis=1, ddof=1)
    return out


def apply_steps(rows: pd.DataFrame, steps: Sequence[Step]) -> pd.DataFrame:
    """``rows`` of one series in order, with the columns of ``steps``."""
    values = {c: rows[c].to_numpy(float) for c in {s.column for s in steps} & set(rows.columns)}
    kinds: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
        "difference": lambda x, before: x - before,
        "simple_return": lambda x, before: _divided(x, before) - 1,
        "log_return": lambda x, before: _log(_divided(x, before)),
        "log_difference": lambda x, before: _log(x) - _log(before),
        "absolute": lambda x, before: np.abs(x),
    }
    for s in steps:
        x = values[s.column]
        if s.kind in ("mean", "std"):
            values[s.name] = _rolled(x, s.rows, s.kind == "std")
        else:
            values[s.name] = kinds[s.kind](x, np.concatenate([[np.nan], x[:-1]])[: len(x)])
    return rows.assign(**{s.name: values[s.name] for s in steps})


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _sorted(rows: pa.Table, order: Sequence[str]) -> pa.Table:
    """``rows`` by ``order``, nulls last."""
    return rows.take(pc.sort_indices(rows, [(c, "ascending") for c in order]))


def _merged(runs: Sequence[Iterator[pa.Table]], order: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of all ``runs`` in order; a run gives its own in order, table by table.

    Of each run two tables or so are held. Rows up to the least of the last
    ones held can be followed by none that is smaller.
    """
    held, open_runs = None, dict(enumerate(runs))
    counts = dict.fromkeys(open_runs, 0)
    while open_runs or held is not None:
        new = [] if held is None else [held]
        for n in [n for n in open_runs if counts[n] < BLOCK_ROWS]:
            table = next(open_runs[n], None)
            if table is None:
                del open_runs[n]
            else:
                new.append(table.append_column("_run", pa.array(np.full(len(table), n, np.int32))))
        if not new:
            return
        held = _sorted(pa.concat_tables(new), order)
        run = held["_run"].to_numpy()
        last = {n: np.flatnonzero(run == n)[-1:] for n in open_runs}
        stop = min((int(at[0]) + 1 if len(at) else 0 for at in last.values()), default=len(run))
        if stop:
            yield held.slice(0, stop).drop_columns(["_run"])
        held = held.slice(stop).combine_chunks() if stop < len(run) else None
        counts = {n: int((run[stop:] == n).sum()) for n in open_runs}


def _resized(tables: Iterator[pa.Table], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``rows``."""
    parts, n = [], 0
    for table in tables:
        parts.append(table)
        n += len(table)
        if n >= rows:
            whole = pa.concat_tables(parts)
            full = n - n % rows
            for at in range(0, full, rows):
                yield whole.slice(at, rows)
            n -= full
            parts = [whole.slice(full).combine_chunks()]
    if n:
        yield pa.concat_tables(parts)


class _Waiting:
    """Rows of one series that wait for the watermark, as sorted runs of blocks.

    ``blocks`` maps a number to a stored block. The index lists the runs, each
    as its size class and blocks (number, first and last time); it is small.
    """

    def __init__(self, blocks, index: dict, order: Sequence[str]):
        self.blocks, self.index, self.order = blocks, index, order

    def _span(self, rows: pa.Table) -> tuple[int, int]:
        times = rows[self.order[0]]
        return times[0].cast("int64").as_py(), times[-1].cast("int64").as_py()

    def _stored(self, tables: Iterator[pa.Table]) -> list[tuple[int, int, int]]:
        run = []
        for rows in _resized(tables, BLOCK_ROWS):
            number = self.index["next"]
            self.index["next"] = number + 1
            self.blocks.updateValue((number,), (_packed(rows),))
            run.append((number, *self._span(rows)))
        return run

    def _taken(self, run: list) -> Iterator[pa.Table]:
        """All blocks of a run, which leave the state."""
        for number, *_ in run:
            rows = _unpacked(bytes(self.blocks.getValue((number,))[0]))
            self.blocks.removeKey((number,))
            yield rows

    def _taken_until(self, run: list, until: int) -> Iterator[pa.Table]:
        """The rows of a run up to a time, which leave the state; the run keeps the others."""
        while run and run[0][1] <= until:
            number, _, last = run[0]
            rows = _unpacked(bytes(self.blocks.getValue((number,))[0]))
            times = rows[self.order[0]].cast("int64").to_numpy()
            stop = int(np.searchsorted(times, until, "right"))
            if stop == len(rows):
                self.blocks.removeKey((number,))
                run.pop(0)
            else:
                self.blocks.updateValue((number,), (_packed(rows.slice(stop)),))
                run[0] = (number, int(times[stop]), last)
            yield rows.slice(0, stop)

    def add(self, rows: pa.Table) -> None:
        """Store rows as a run; many runs of a size become one of the next."""
        runs, size = self.index["runs"], 0
        runs.append([size, self._stored(iter([_sorted(rows, self.order)]))])
        while len(alike := [r for r in runs if r[0] == size]) >= RUNS_OF_A_SIZE:
            merged = self._stored(_merged([self._taken(r[1]) for r in alike], self.order))
            runs[:] = [r for r in runs if r[0] != size]
            size += 1
            runs.append([size, merged])

    def closed(self, until: int) -> Iterator[pa.Table]:
        """Rows up to ``until`` in order, which leave the state."""
        runs = self.index["runs"]
        yield from _merged([self._taken_until(r[1], until) for r in runs], self.order)
        runs[:] = [r for r in runs if r[1]]

    def first(self) -> int | None:
        """The time of the first row, if there is any."""
        return min((r[1][0][1] for r in self.index["runs"]), default=None)


class _OverRows(StatefulProcessor):
    """Keeps the rows of a series until the watermark passes them, then adds the steps.

    States: ``index`` of the waiting blocks with the time of the timer, the
    ``blocks`` themselves, and the ``ring``. Times are microseconds.
    """

    def __init__(self, steps: Sequence[Step], order: Sequence[str], schema: pa.Schema):
        self.steps, self.order, self.schema = steps, order, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "index string")
        self.ring = handle.getValueState("ring", "rows binary")
        self.blocks = handle.getMapState("blocks", "number long", "rows binary")

    def _waiting(self) -> _Waiting:
        known = self.index.get()
        index = json.loads(known[0]) if known else {"next": 0, "runs": [], "timer": None}
        return _Waiting(self.blocks, index, self.order)

    def _keep(self, waiting: _Waiting, fired: int | None = None) -> None:
        """Store the index and see to a timer for the first waiting row."""
        first, timer = waiting.first(), waiting.index["timer"]
        if timer == fired:
            timer = None  # the engine removes it
        # A timer fires when the watermark has reached it.
        due = None if first is None else -(-first // 1000)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        waiting.index["timer"] = due
        self.index.update((json.dumps(waiting.index),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting, parts, n = self._waiting(), [], 0
        for part in rows:
            part = part.set_axis(self.schema.names, axis=1)  # pandas renames some on the way
            parts.append(pa.Table.from_pandas(part, self.schema, preserve_index=False))
            n += len(part)
            if n >= RUN_ROWS:
                waiting.add(pa.concat_tables(parts))
                parts, n = [], 0
        if n:
            waiting.add(pa.concat_tables(parts))
        self._keep(waiting)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, look_back = self._waiting(), lookback(self.steps)
        stored = self.ring.get()
        ring = _unpacked(bytes(stored[0])) if stored else self.schema.empty_table()
        until = timerValues.getCurrentWatermarkInMs() * 1000
        for closed in _resized(waiting.closed(until), _ROWS_AT_ONCE):
            known = pa.concat_tables([ring, closed])
            yield apply_steps(known.to_pandas(), self.steps)[len(ring) :]
            ring = known.slice(max(0, len(known) - look_back)).combine_chunks()
        self.ring.update((_packed(ring),))
        self._keep(waiting, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def stream_over_rows(
    rows: DataFrame,
    keys: Sequence[str],
    steps: Sequence[Step],
    order: Sequence[str] = ("open_ts",),
    late_by: str = "10 minutes",
) -> DataFrame:
    """Rows that the watermark has passed, with the columns of ``steps``.

    ``order`` starts with the event time. Equal to windows over each series
    without the rows that came too late, which are dropped, as are rows without
    a time. Rows that tie on ``order`` are taken in any order. The event time
    stays zoned. Makes RocksDB the session's state store for streams that start
    from now on, as this state needs a store on disk.
    """
    timed = timed_by(rows, order[0], late_by).where(F.col(order[0]).isNotNull())
    schema = timed.schema
    out = T.StructType([*schema.fields, *[T.StructField(s.name, T.DoubleType()) for s in steps]])
    # Whole numbers with nulls are kept as they came, not as floats.
    arrow = pa.schema(
        [pa.field(f.name, _ARROW.get(f.dataType.typeName(), pa.string())) for f in schema.fields]
    )
    rows.sparkSession.conf.set(_STORE_KEY, _STORE)
    return timed.groupBy(*keys).transformWithStateInPandas(
        _OverRows(tuple(steps), tuple(order), arrow), out, "append", "eventTime"
    )


# How state columns are stored, by Spark type.
_ARROW = {
    "timestamp": pa.timestamp("us"),
    "timestamp_ntz": pa.timestamp("us"),
    "double": pa.float64(),
    "float": pa.float32(),
    "long": pa.int64(),
    "integer": pa.int32(),
    "boolean": pa.bool_(),
}


def stream_bar_features(
    bars: DataFrame, keys: Sequence[str] = ("symbol",), late_by: str = "0 seconds"
) -> DataFrame:
    """``features.bar_features`` on a stream of bars, one per series and time."""
    close = F.col("close")
    ready = bars.withColumns(
        {
            "range_hl": C.range_hl(F.col("high"), F.col("low")),
            "body_oc": C.body_oc(F.col("open"), close),
        }
    )
    return stream_over_rows(ready, keys, BAR_STEPS, late_by=late_by)


def stream_minute_features(
    candles: DataFrame,
    keys: Sequence[str] = ("symbol",),
    tiebreak: Sequence[str] = (),
    late_by: str = "10 minutes",
) -> DataFrame:
    """``features.minute_features`` on a stream of typed candles."""
    close, open_, high, low = (F.col(c) for c in ("close", "open", "high", "low"))
    ready = candles.withColumns(
        {
            "range_hl": C.range_hl(high, low),
            "range_hl_pct": C.range_hl_pct(high, low, close),
            "body_abs": C.body_abs(open_, close),
            "body_pct": C.body_pct(open_, close),
        }
    )
    return stream_over_rows(ready, keys, MINUTE_STEPS, ["open_ts", *tiebreak], late_by)
