"""The same results in SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from workload.tables import KLINES_DUCKDB

STAMP = (
    "CASE WHEN {c} >= 100000000000000 THEN make_timestamp({c}) "
    "ELSE make_timestamp({c} * 1000) END"
)

_VALID = (
    "high >= open AND high >= close AND high >= low AND low <= open "
    "AND low <= close AND low <= high AND volume >= 0"
)


def regime(ts: str, start: str, end: str, include_end: bool) -> str:
    op = "<=" if include_end else "<"
    return (
        f"CASE WHEN {ts} < TIMESTAMP '{start}' THEN 'pre_covid' "
        f"WHEN {ts} {op} TIMESTAMP '{end}' THEN 'covid' ELSE 'post_covid' END"
    )


KLINE_REGIME = regime("open_ts", "2024-01-10 00:00:00", "2024-01-20 23:59:59", True)
KLINE_BACKFILL = regime("open_ts", "2024-01-12 00:00:00", "2024-01-22 00:00:00", False)
ORDER_REGIME = regime("open_ts", "1997-03-01 00:00:00", "1999-05-31 23:59:59", True)


def ratio(w: str, price: str = "close") -> str:
    return f"({price} / nullif(lag({price}) OVER {w}, 0))"


def ln(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN ln({x}) END)"


def rolled(aggregate: str, value: str, k: int, min_rows: int | None = None) -> str:
    frame = (
        "OVER (PARTITION BY symbol ORDER BY {order} "
        f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    )
    return (
        f"CASE WHEN count({value}) {frame} >= {k if min_rows is None else min_rows} "
        f"THEN {aggregate}({value}) {frame} END"
    )


def _minute(source: str) -> str:
    """1-minute features of ``source`` in (open_ts, source_file, event_id) order."""
    w = "(PARTITION BY symbol ORDER BY open_ts, source_file, event_id)"
    vol = rolled("stddev_samp", "log_return_1m", 60).format(
        order="open_ts, source_file, event_id"
    )
    return f"""
      SELECT *, abs(log_return_1m) AS abs_log_return_1m, {vol} AS volatility_60 FROM (
        SELECT *,
          close - lag(close) OVER {w} AS close_diff_1m,
          {ratio(w)} - 1 AS return_1m,
          {ln(ratio(w))} AS log_return_1m,
          {ln('close')} - lag({ln('close')}) OVER {w} AS log_diff_close_1m,
          high - low AS range_hl,
          (high - low) / nullif(close, 0) AS range_hl_pct,
          abs(close - open) AS body_abs,
          abs(close - open) / nullif(open, 0) AS body_pct
        FROM {source})"""


def _features(source: str) -> str:
    """Bar features of ``source`` in time order."""
    w = "(PARTITION BY symbol ORDER BY open_ts)"
    parts = {
        "sma_24h": rolled("avg", "close", 24),
        "sma_168h": rolled("avg", "close", 168),
        "volatility_24h": rolled("stddev_samp", "log_return_1h", 24),
        "volume_sma_24h": rolled("avg", "volume", 24),
    }
    rolls = ", ".join(f"{v.format(order='open_ts')} AS {k}" for k, v in parts.items())
    return f"""
      SELECT *, {rolls} FROM (
        SELECT *, high - low AS range_hl, close - open AS body_oc,
          {ratio(w)} - 1 AS return_1h, {ln(ratio(w))} AS log_return_1h
        FROM {source})"""


def _bars(source: str, unit: str, sums: bool = True, order: str = "open_ts") -> str:
    total = """
        coalesce(sum(volume), 0) AS volume,
        coalesce(sum(quote_asset_volume), 0) AS quote_asset_volume,
        CAST(coalesce(sum(number_of_trades), 0) AS BIGINT) AS number_of_trades,
        coalesce(sum(taker_buy_base_volume), 0) AS taker_buy_base_volume,
        coalesce(sum(taker_buy_quote_volume), 0) AS taker_buy_quote_volume,"""
    return f"""
      SELECT symbol, CAST(date_trunc('{unit}', open_ts) AS TIMESTAMP) AS open_ts,
        arg_min(open, {order}) AS open, max(high) AS high, min(low) AS low,
        arg_max(close, {order}) AS close, {total if sums else ''}
        count(*) AS rows_in_bar
      FROM (SELECT * FROM {source}) GROUP BY ALL"""


_YEAR_QUARTER = "concat(CAST(year(open_ts) AS VARCHAR), '-Q', CAST(quarter(open_ts) AS VARCHAR))"

VIEWS = {
    "klines": KLINES_DUCKDB,
    "stamped": f"""SELECT *, {STAMP.format(c='open_time')} AS open_ts,
        {STAMP.format(c='close_time')} AS close_ts FROM klines""",
    "bronze": """SELECT * FROM stamped WHERE open_time IS NOT NULL AND close_time IS NOT NULL
        AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL""",
    "present": "SELECT * FROM bronze WHERE open_ts IS NOT NULL AND close_ts IS NOT NULL "
    "AND volume IS NOT NULL",
    "first_rows": """SELECT * FROM present QUALIFY row_number() OVER
        (PARTITION BY symbol, open_ts ORDER BY source_file, event_id) = 1""",
    "silver": f"SELECT * FROM first_rows WHERE {_VALID}",
    "bars": _bars("silver", "hour"),
    "features": _features("bars"),
    "gold": f"""SELECT *, CAST(NULL AS BOOLEAN) AS bar_complete,
        {KLINE_REGIME} AS market_regime,
        CAST(year(open_ts) AS INTEGER) AS year, CAST(month(open_ts) AS INTEGER) AS month,
        CAST(day(open_ts) AS INTEGER) AS day, CAST(hour(open_ts) AS INTEGER) AS hour
        FROM features""",
    "bronze_1m": _minute("bronze"),
    "silver_1m": _minute("silver"),
    "ticks": """SELECT o_orderpriority AS symbol, o_orderdate AS open_ts, o_orderkey,
        o_totalprice AS open, o_totalprice AS high, o_totalprice AS low,
        o_totalprice AS close FROM orders""",
    "days": _bars("ticks", "day", sums=False, order="(open_ts, o_orderkey)"),
    "day_returns": f"""SELECT *,
        {ln(ratio('(PARTITION BY symbol ORDER BY open_ts)'))} AS log_return_1h FROM days""",
    "season": """SELECT max(CASE WHEN rn = floor((n - 1) * 0.25 + 0.5) THEN close END) AS q1,
        max(CASE WHEN rn = floor((n - 1) * 0.75 + 0.5) THEN close END) AS q3
        FROM (SELECT close, row_number() OVER (ORDER BY close) - 1 AS rn,
              count(*) OVER () AS n FROM gold WHERE close IS NOT NULL)""",
    "model": f"""SELECT symbol, open_ts, year, month, day, hour,
        CAST(quarter(open_ts) AS INTEGER) AS quarter, {_YEAR_QUARTER} AS year_quarter,
        market_regime,
        CASE WHEN close <= (SELECT q1 FROM season) THEN 'low'
             WHEN close >= (SELECT q3 FROM season) THEN 'high' ELSE 'mid' END AS price_season,
        open, high, low, close, volume, quote_asset_volume, number_of_trades,
        taker_buy_base_volume, taker_buy_quote_volume, range_hl, body_oc, return_1h,
        log_return_1h, sma_24h, sma_168h, volatility_24h, volume_sma_24h,
        close AS target_close FROM gold""",
    "model_clean": """SELECT * FROM model WHERE return_1h IS NOT NULL
        AND log_return_1h IS NOT NULL AND sma_24h IS NOT NULL AND sma_168h IS NOT NULL
        AND volatility_24h IS NOT NULL AND volume_sma_24h IS NOT NULL""",
}

_NEEDS = {
    "klines": [],
    "stamped": ["klines"],
    "bronze": ["stamped"],
    "present": ["bronze"],
    "first_rows": ["present"],
    "silver": ["first_rows"],
    "bars": ["silver"],
    "features": ["bars"],
    "gold": ["features"],
    "bronze_1m": ["bronze"],
    "silver_1m": ["silver"],
    "ticks": [],
    "days": ["ticks"],
    "day_returns": ["days"],
    "season": ["gold"],
    "model": ["season"],
    "model_clean": ["model"],
}


def _chain(names: tuple[str, ...], extra: dict[str, str]) -> list[tuple[str, str]]:
    done: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS[name]:
            visit(need)
        if name not in done:
            done.append(name)

    for name in names:
        visit(name)
    return [(n, VIEWS[n]) for n in done] + list(extra.items())


def query(
    body: str, views: tuple[str, ...] = (), doubles: tuple[str, ...] | str = (), **extra: str
) -> str:
    """``body`` over the named views, with the ``doubles`` rounded to 6 digits."""
    chain = _chain(views, extra)
    parts = [f"{n} AS MATERIALIZED ({sql})" for n, sql in chain]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    if not doubles:
        return head + body
    names = doubles.split() if isinstance(doubles, str) else doubles
    rounded = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in names)
    return f"{head}SELECT * REPLACE ({rounded}) FROM ({body})"


def nearest(source: str, column: str, prob: float) -> str:
    """Scalar subquery: the value at rank floor((n - 1) * p + 0.5)."""
    return (
        f"(SELECT max(CASE WHEN rn = floor((n - 1) * {prob} + 0.5) THEN v END) FROM "
        f"(SELECT v, row_number() OVER (ORDER BY v) - 1 AS rn, count(*) OVER () AS n "
        f"FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {source}) WHERE v IS NOT NULL))"
    )


def quartile_line(source: str, column: str, dataset: str | None = None) -> str:
    """One line of the outlier table."""
    q1, q3 = nearest(source, column, 0.25), nearest(source, column, 0.75)
    tag = f"'{dataset}' AS dataset, " if dataset else ""
    return f"""SELECT {tag}'{column}' AS variable, q1, q3, q3 - q1 AS iqr,
        q1 - 1.5 * (q3 - q1) AS lower_limit, q3 + 1.5 * (q3 - q1) AS upper_limit,
        (SELECT count(*) FROM {source} WHERE {column} < q1 - 1.5 * (q3 - q1)
            OR {column} > q3 + 1.5 * (q3 - q1)) AS outliers,
        CAST((SELECT count(*) FROM {source} WHERE {column} < q1 - 1.5 * (q3 - q1)
            OR {column} > q3 + 1.5 * (q3 - q1)) AS DOUBLE)
            / (SELECT count(*) FROM {source}) * 100 AS outlier_pct
        FROM (SELECT {q1} AS q1, {q3} AS q3)"""


def describe(source: str, columns: list[str]) -> str:
    """Statistics as rows, variables as columns."""
    lines = []
    for statistic, sql in (
        ("count", "CAST(count({c}) AS DOUBLE)"),
        ("null_count", "CAST(count(*) - count({c}) AS DOUBLE)"),
        ("mean", "avg({c})"),
        ("std", "stddev_samp({c})"),
        ("min", "CAST(min({c}) AS DOUBLE)"),
        ("max", "CAST(max({c}) AS DOUBLE)"),
    ):
        cells = ", ".join(f'{sql.format(c=c)} AS "{c}"' for c in columns)
        lines.append(f"SELECT '{statistic}' AS statistic, {cells} FROM {source}")
    for statistic, prob in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        cells = ", ".join(f'{nearest(source, c, prob)} AS "{c}"' for c in columns)
        lines.append(f"SELECT '{statistic}' AS statistic, {cells}")
    return " UNION ALL ".join(lines)


def histogram(source: str, column: str, bins: int) -> str:
    return f"""
      SELECT CAST(b.range AS INTEGER) AS bin,
        lo + b.range * ((hi - lo) / {bins}) AS lower,
        lo + (b.range + 1) * ((hi - lo) / {bins}) AS upper,
        count(h.bin) AS rows
      FROM range({bins}) b
      CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) limits
      LEFT JOIN (
        SELECT least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS bin
        FROM (SELECT {column} AS v FROM {source} WHERE {column} IS NOT NULL)
        CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
      ) h ON h.bin = b.range
      GROUP BY b.range, lo, hi"""


def box(source: str, column: str, by: str, groups: list[str]) -> str:
    listed = ", ".join(f"({i}, '{g}')" for i, g in enumerate(groups))
    return f"""
      SELECT CAST(g.place AS INTEGER) AS place, g.name AS {by}, s.q1, s.median, s.q3,
        least(s.lo, s.q1) AS whisker_low, greatest(s.hi, s.q3) AS whisker_high,
        CAST(s.outliers AS DOUBLE) AS outliers, CAST(s.n AS DOUBLE) AS rows
      FROM (VALUES {listed}) g(place, name)
      LEFT JOIN (
        SELECT {by} AS name, max(q1) AS q1, max(median) AS median, max(q3) AS q3,
          min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS lo,
          max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS hi,
          count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers,
          count(*) AS n
        FROM (SELECT {by}, {column} AS v,
                quantile_cont({column}, 0.25) OVER (PARTITION BY {by}) AS q1,
                quantile_cont({column}, 0.5) OVER (PARTITION BY {by}) AS median,
                quantile_cont({column}, 0.75) OVER (PARTITION BY {by}) AS q3
              FROM {source} WHERE {column} IS NOT NULL)
        GROUP BY {by}
      ) s ON s.name = g.name"""


def gaps(source: str) -> str:
    """Rows, duplicates, span and gaps per symbol."""
    return f"""
      SELECT symbol, count(*) AS rows,
        count(*) - count(DISTINCT open_ts) AS duplicates,
        min(open_ts) AS min_ts, max(open_ts) AS max_ts,
        count(*) FILTER (d <> 60000000) AS gaps,
        CAST(max(d) FILTER (d <> 60000000) // 1000000 AS BIGINT) AS largest_gap_seconds
      FROM (SELECT symbol, open_ts, epoch_us(open_ts)
              - lag(epoch_us(open_ts)) OVER (PARTITION BY symbol ORDER BY open_ts) AS d
            FROM {source})
      GROUP BY symbol"""


def state(source: str, dataset: str, width: int) -> str:
    return f"""
      SELECT '{dataset}' AS dataset, CAST(sum(rows) AS BIGINT) AS rows,
        CAST({width} AS BIGINT) AS columns, min(min_ts) AS min_ts, max(max_ts) AS max_ts,
        CAST(sum(duplicates) AS BIGINT) AS duplicates, CAST(sum(gaps) AS BIGINT) AS gaps,
        max(largest_gap_seconds) AS largest_gap_seconds
      FROM ({gaps(source)})"""
