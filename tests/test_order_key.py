import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from candlemill.functions.order_key import packed_order

DDL = "a timestamp_ntz, b bigint, c int, d date, e boolean, s string"


def some_rows():
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    stamps = [None, datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59, 999_999), base, base + timedelta(microseconds=1)]
    wholes = [None, -(2**63), 2**63 - 1, 0, 1, -1]
    days = [None, date(1, 1, 1), date(9999, 12, 31), date(2024, 1, 1)]
    return [
        (rng.choice(stamps), rng.choice(wholes), rng.choice([None, -5, 0, 2**31 - 1, -(2**31)]),
         rng.choice(days), rng.choice([None, True, False]), rng.choice("xy"))
        for _ in range(200)
    ]


def test_number_orders_as_the_columns_do(frame):
    df = frame(some_rows(), DDL)
    for columns in (["a", "b"], ["b", "c"], ["c", "d", "e"], ["e", "a"], ["b"]):
        key = packed_order(df, columns)
        pairs = df.select(F.struct(*columns).alias("t"), key.alias("k"))
        by_key = pairs.groupBy("t").agg(F.min("k").alias("k"), F.max("k").alias("same")).orderBy("t").collect()
        assert all(r["k"] == r["same"] for r in by_key)
        assert [r["k"] for r in by_key] == sorted({r["k"] for r in by_key}) and len(by_key) > 3


def test_what_has_no_fixed_width_is_not_packed(frame):
    df = frame(some_rows(), DDL)
    assert packed_order(df, ["a", "s"]) is None
    assert packed_order(df, ["b", "a", "c"]) is None
