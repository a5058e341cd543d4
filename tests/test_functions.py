import datetime as dt

from pyspark.sql import functions as F

from claimlake.functions import (
    changed,
    display_name,
    in_year,
    is_publishable,
    money_sum,
    month_key,
    prefixed_key,
    quarantine_flag,
    surrogate_key,
)
from claimlake.functions.predicates import month_number, month_text


def test_surrogate_key_null_in_null_out(spark):
    df = spark.createDataFrame([("7", "hos-a"), (None, "hos-a"), ("7", None)], "id string, ds string")
    got = [r[0] for r in df.select(surrogate_key("id", "ds")).collect()]
    assert got == ["7-hos-a", None, None]


def test_prefixed_key_sources(spark):
    df = spark.createDataFrame([("P1", "hos-a"), ("P1", "hos-b"), ("P1", "hos-x"), ("P1", None), (None, "hos-a")],
                               "id string, ds string")
    got = [r[0] for r in df.select(prefixed_key("id", "ds")).collect()]
    assert got == ["H1-P1", "H2-P1", "H2-P1", "H2-P1", None]


def test_display_name(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee")], "f string, l string")
    assert [r[0] for r in df.select(display_name("f", "l")).collect()] == ["Ann Lee", None]


def test_quarantine_truth_table(spark):
    data = [
        ("1", dt.date(2000, 1, 1), "Ann", False),
        (None, dt.date(2000, 1, 1), "Ann", True),
        ("1", None, "Ann", True),
        ("1", dt.date(2000, 1, 1), None, True),
        ("1", dt.date(2000, 1, 1), "NULL", True),
        ("1", dt.date(2000, 1, 1), "null", True),
        ("1", dt.date(2000, 1, 1), "Nullah", False),
    ]
    df = spark.createDataFrame(data, "id string, dob date, first string, expect boolean")
    flag = quarantine_flag(["id", "dob", "first"], {"first": ["null"]})
    for got, expect in df.select(flag, "expect").collect():
        assert got is expect


def test_quarantine_flag_never_null(spark):
    df = spark.createDataFrame([(None,)], "first string")
    # the sentinel test on a NULL is NULL; the flag still comes out FALSE
    assert df.select(quarantine_flag([], {"first": ["null"]})).first()[0] is False


def test_changed_null_unsafe_and_safe(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("a", None), (None, "a"), (None, None)], "t string, s string")
    unsafe = [r[0] for r in df.select(changed([(F.col("t"), F.col("s"))])).collect()]
    safe = [r[0] for r in df.select(changed([(F.col("t"), F.col("s"))], null_safe=True)).collect()]
    assert unsafe == [False, True, False, False, False]
    assert safe == [False, True, True, True, False]


def test_in_year_boundaries(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(in_year("d", 2024)).collect()]
    assert got == [False, True, True, False, None]


def test_in_year_pushes_both_bounds(spark, tmp_dir):
    path = f"{tmp_dir}/dates"
    spark.createDataFrame([(dt.date(2024, 5, 1),)], "d date").write.parquet(path)
    plan = spark.read.parquet(path).filter(in_year("d", 2024))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2024-01-01)" in plan and "LessThan(d,2025-01-01)" in plan


def test_month_key_and_number(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),), (dt.date(999, 12, 1),)], "d date")
    out = df.select(month_key("d").alias("a"), month_text(month_number("d")).alias("b")).collect()
    assert [tuple(r) for r in out] == [("202403", "202403"), ("099912", "099912")]


def test_is_publishable(spark):
    df = spark.createDataFrame([(True, False), (True, True), (False, False), (None, False), (True, None)],
                               "c boolean, q boolean")
    assert [r[0] for r in df.select(is_publishable("c", "q")).collect()] == [True, False, False, None, None]


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    assert df.agg(money_sum("x")).first()[0] == 3.0


from hypothesis import given, settings, strategies as st  # noqa: E402

_VALS = st.one_of(st.none(), st.sampled_from(["a", "b", "NULL", "null", ""]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(_VALS, _VALS, _VALS, _VALS), min_size=1, max_size=8))
def test_changed_matches_sql_model(spark, pairs):
    """B12 against a model of SQL three-valued logic: OR of `<>`, NULL read as FALSE."""
    df = spark.createDataFrame(pairs, "a1 string, b1 string, a2 string, b2 string")
    got = [r[0] for r in df.select(changed([(F.col("a1"), F.col("b1")), (F.col("a2"), F.col("b2"))])).collect()]

    def neq(x, y):
        return None if x is None or y is None else x != y

    def or3(x, y):
        if x is True or y is True:
            return True
        return None if x is None or y is None else False

    assert got == [bool(or3(neq(a1, b1), neq(a2, b2))) for a1, b1, a2, b2 in pairs]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(_VALS, _VALS), min_size=1, max_size=8))
def test_quarantine_matches_model(spark, data):
    df = spark.createDataFrame(data, "id string, first string")
    got = [r[0] for r in df.select(quarantine_flag(["id", "first"], {"first": ["null"]})).collect()]
    assert got == [i is None or f is None or f.lower() == "null" for i, f in data]
