"""Rows packed for a shuffle come back as they were."""

import datetime as dt

from pyspark.sql import functions as F

from claimlake.functions import packing
from claimlake.functions.packing import pack
from tests.conftest import rows

SHAPE = "id int, a string, `b.c` string, raw binary, d date, e string, f double, g array<string>"
ROWS = [(1, "x", "", b"\x00\xff", dt.date(2024, 1, 1), "end", 0.5, ["p"]), (2, None, None, None, None, None, None, None),
        (3, "", "\u00e9\u4e16\U0001f600", b"", dt.date(1, 1, 1), None, -0.0, []), (4, None, "tail", None, None, "", float("inf"), [None]),
        (5, "a,b\\n\"", " lead", None, None, "z" * 70000, None, None)]


def returned(df, keep=()):
    packed, whole = pack(df, keep)
    assert list(whole) == df.columns
    return packed, packed.repartition(3, F.lit(1) * F.col("id")).select(*[c.alias(name) for name, c in whole.items()])


def test_round_trip(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, SHAPE)
    packed, back = returned(df)
    assert packed.columns == ["id", "raw", "d", "f", "g", "__texts", "__lengths"]
    assert back.dtypes == df.dtypes and rows(back) == rows(df)
    packed, back = returned(df, keep=["e"])
    assert "e" in packed.columns and rows(back) == rows(df)
    monkeypatch.setattr(packing, "MAX_TEXTS", 2)
    packed, back = returned(df)
    assert "e" in packed.columns and rows(back) == rows(df)


def test_texts_are_bytes(spark):
    """Bytes that are no UTF-8 come back as the same bytes."""
    df = spark.range(1).select("id", F.unhex(F.lit("61FFC3")).cast("string").alias("a"), F.lit("b").alias("b"))
    assert rows(returned(df)[1].select("id", F.hex(F.col("a").cast("binary")), "b")) == [(0, "61FFC3", "b")]


def test_nothing_to_pack(spark):
    df = spark.range(3).withColumn("a", F.lit("x"))
    packed, back = returned(df)
    assert packed.columns == df.columns and rows(back) == rows(df)


def test_fewer_bytes_in_flight(spark):
    df = spark.range(10).select("id", *[F.concat(F.lit(n), F.col("id")).alias(n) for n in "abcdefghij"])
    packed = pack(df)[0]
    width = lambda x: 8 * len(x.columns)
    assert width(packed) == 24 and width(df) == 88
