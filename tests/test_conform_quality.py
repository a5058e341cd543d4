import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake.operators.conform import conform, conform_to, rename, union_sources, with_source_key
from claimlake.operators.quality import flag_quarantine, latest_per_key, quarantined_first
from claimlake.sources.schemas import gold, schema
from tests.conftest import rows


def test_conform_maps_two_shapes_to_one(spark):
    a = spark.createDataFrame([("1", "Ann")], "PatientID string, FirstName string")
    b = spark.createDataFrame([("Bo", "2")], "F_Name string, ID string")
    out = union_sources(conform(a, {"SRC_PatientID": "PatientID", "FirstName": "FirstName"}),
                        conform(b, {"SRC_PatientID": "ID", "FirstName": "F_Name"}))
    assert out.columns == ["SRC_PatientID", "FirstName"]
    assert rows(out) == [("1", "Ann"), ("2", "Bo")]


def test_union_by_name_vs_position(spark):
    a = spark.createDataFrame([("1", "x")], "id string, v string")
    b = spark.createDataFrame([("y", "2")], "v string, id string")  # reordered columns
    assert rows(union_sources(a, b)) == [("1", "x"), ("2", "y")]
    # by position silently misaligns (S11): that is the reference's SELECT * UNION ALL
    assert rows(union_sources(a, b, by="position")) == [("1", "x"), ("y", "2")]


def test_rename_and_source_key(spark):
    df = spark.createDataFrame([("7", "hos-a", 1)], "EncounterID string, datasource string, n int")
    out = with_source_key(df, "EncounterID")
    assert out.columns == ["EncounterID", "SRC_EncounterID", "datasource", "n"]
    assert out.first()["EncounterID"] == "7-hos-a"
    assert rename(df, {"n": "m"}).columns == ["EncounterID", "datasource", "m"]


def test_conform_to_positional_insert_casts(spark):
    cols = [f.name for f in gold("fact_transactions").fields]
    vals = ["t", "s", "e", "p", "H1-x", "d", "I10", 12345, "v", dt.date(2024, 1, 2), dt.date(2024, 2, 1),
            10.5, 5.0, "Co-pay", "c", "hos-a", dt.datetime(2024, 1, 3)]
    names = [f"c{i}" for i in range(len(vals))]
    df = spark.createDataFrame([tuple(vals)], names)
    out = conform_to(df, gold("fact_transactions"))
    assert out.columns == cols
    assert dict(out.dtypes)["ProcedureCode"] == "string"
    assert out.first()["ProcedureCode"] == "12345"


def test_conform_to_by_name_is_case_insensitive(spark):
    df = spark.createDataFrame([("k", "1")], "PATIENT_KEY string, src_patientid string")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("patient_key", T.StringType()), T.StructField("SRC_PatientID", T.StringType())])
    assert conform_to(df, schema, by="name").first() == ("k", "1")


def test_npi_above_int_range_needs_long(spark):
    df = spark.createDataFrame([(3_000_000_000,)], "NPI long")
    assert conform_to(df, schema("NPI long")).first()[0] == 3_000_000_000
    with pytest.raises(Exception):  # ANSI: an int cast overflows loudly (I9)
        df.select(F.col("NPI").cast("int")).collect()


def test_flag_and_order(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("3", None)], "id string, v string")
    out = quarantined_first(flag_quarantine(df, ["id"]))
    flags = [r["is_quarantined"] for r in out.collect()]
    assert flags == [True, False, False]
    assert out.count() == 3  # flagged, never dropped


def test_latest_per_key(spark):
    df = spark.createDataFrame([
        ("A", dt.date(2024, 1, 1), "old"), ("A", dt.date(2024, 1, 2), "new"), ("B", dt.date(2024, 1, 1), "only"),
        (None, dt.date(2024, 1, 1), "n1"), (None, dt.date(2024, 1, 3), "n2"),
    ], "code string, updated date, descr string")
    got = rows(latest_per_key(df, "code", "updated"))
    assert got == [("A", dt.date(2024, 1, 2), "new"), ("B", dt.date(2024, 1, 1), "only"),
                   (None, dt.date(2024, 1, 1), "n1"), (None, dt.date(2024, 1, 3), "n2")]  # S2: NULL keys match nothing


def test_latest_per_key_hot_key_partial_aggregation(spark):
    """A key holding most rows is reduced map-side (partial aggregate before the shuffle)."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ts"))
    out = latest_per_key(df, "k", "ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert out.filter(F.col("k") == "HOT").first()["ts"] == 14999
    assert out.count() == 5001


def test_latest_per_key_keeps_every_null_key_row(spark):
    from claimlake.operators.quality import latest_per_key

    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), (None, 2, "b"), ("k", 1, "old"), ("k", 2, "new")], "key string, at int, v string")
    assert sorted((r["key"] or "", r["v"]) for r in latest_per_key(df, "key", "at").collect()) == [("", "a"), ("", "a"), ("", "b"), ("k", "new")]
