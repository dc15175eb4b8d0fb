"""One number that orders rows as several columns do.

A struct of columns orders rows too, but an aggregate that carries a struct
has to sort; a decimal has a fixed width, which a hash aggregate can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions.candle import micros

# By type, what makes the least value 0, and the number of values.
# Timestamps are microseconds of the years 1 to 9999.
_SPANS = {
    "boolean": (0, 2),
    "byte": (1 << 7, 1 << 8),
    "short": (1 << 15, 1 << 16),
    "integer": (1 << 31, 1 << 32),
    "date": (1 << 31, 1 << 32),
    "long": (1 << 63, 1 << 64),
    "timestamp": (1 << 58, 1 << 59),
    "timestamp_ntz": (1 << 58, 1 << 59),
}
_LARGEST = 10**38


def _whole(column: Column, kind: str) -> Column:
    if kind.startswith("timestamp"):
        return micros(column)
    if kind == "date":
        return F.unix_date(column)
    return column.cast("int") if kind == "boolean" else column


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def packed_order(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """A decimal that orders rows as ``columns`` do, nulls first.

    None if a column has no fixed width or all together need more than 38 digits.
    """
    kinds = [df.schema[c].dataType.typeName() for c in columns]
    size = 1
    for kind in kinds:
        if kind not in _SPANS:
            return None
        size *= _SPANS[kind][1] + 1  # one more for null
    if size >= _LARGEST:
        return None
    key = _decimal(0)
    for c, kind in zip(columns, kinds):
        least, values = _SPANS[kind]
        place = _whole(F.col(c), kind).cast("decimal(20,0)") + _decimal(least + 1)
        key = key * _decimal(values + 1) + F.coalesce(place, _decimal(0))
    return key
