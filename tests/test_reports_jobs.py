"""Job chain P1 -> P4/P5 -> P12/P13/P17 -> P18 on the tiny hospitals, with hand-computed totals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake.operators import marts, reports
from claimlake.operators.history import scd2_apply
from claimlake.operators.joins import probe_size
from claimlake.plans import jobs
from claimlake.sources.schemas import silver
from tests import hospital

TS = dt.datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def star(spark):
    q = jobs.transactions_quality(hospital.transactions(spark))
    tx = scd2_apply(spark.createDataFrame([], silver("transactions")), q, "TransactionID", ts=TS)
    fact = marts.fact_transactions(tx, TS)
    prov = marts.dim_provider(jobs.providers_silver(hospital.providers(spark)))
    dept = marts.dim_department(jobs.departments_silver(hospital.departments(spark)))
    return fact, prov, dept


def test_fact_shape_and_filter(star):
    fact, _, _ = star
    assert fact.count() == 7  # the quarantined row (no EncounterID) is not published
    r = fact.filter(F.col("TransactionID") == "T1-hos-b").first()
    assert r["FK_ProviderID"] == "H2-PROV0001" and r["FK_PatientID"] == "P9-hos-b"
    assert r["FK_DeptID"] == "DEPT001-hos-b" and r["ProcedureCode"] == "99213"
    assert r["EncounterID"] == "E9"  # raw id (S10)


def test_dims(star):
    _, prov, dept = star
    assert prov.count() == 4  # H2-PROV0003 has no department: quarantined
    assert {r["DeptID"] for r in prov.collect()} == {"DEPT001-hos-a", "DEPT002-hos-a", "DEPT001-hos-b",
                                                     "DEPT009-hos-b"}
    assert prov.filter(F.col("ProviderID") == "H1-PROV0002").first()["NPI"] == 3000000001
    assert dept.count() == 3


@pytest.mark.parametrize("mode", ["auto", "never"])
def test_report1_totals(star, mode):
    fact, prov, dept = star
    got = {(r[0], r[1]): r[2] for r in reports.charges_by_provider(fact, prov, dept, broadcast=mode).collect()}
    assert got == {
        ("Ann Lee", "Cardiology"): 351.35,  # 100.10 + 200.20 + 50.05 + 1.00: namesakes merge (S15)
        ("Bob Roy", "Oncology"): 300.30,
        ("Cy Fox", None): 10.00,                                       # provider without department
        (None, None): 7.00,                                            # fact without provider
    }


@pytest.mark.parametrize("mode", ["auto", "never"])
def test_report2_year_and_order(star, mode):
    fact, prov, dept = star
    out = reports.monthly_charges(fact, prov, dept, 2024, broadcast=mode).collect()
    assert [tuple(r) for r in out] == [
        (None, None, "202402", 7.00, 7.00),
        ("Ann Lee", "Cardiology", "202401", 300.30, 80.00),
        ("Ann Lee", "Cardiology", "202412", 50.05, 50.05),
        ("Cy Fox", None, "202402", 10.00, 5.00),
    ]


def test_probe_size_bounds(spark):
    df = spark.range(100).select(F.col("id"), F.lit("abcd").alias("s"))
    p = probe_size(df, max_rows=1000, max_bytes=10_000)
    assert (p.rows, p.bytes, p.bounded) == (100, 100 * (8 + 4), True)
    assert not probe_size(df, max_rows=10).bounded
    assert not probe_size(df, max_bytes=100).bounded


def test_report_broadcasts_only_after_probe(star):
    fact, prov, dept = star
    plan = reports.monthly_charges(fact, prov, dept, 2024)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    plan2 = reports.monthly_charges(fact, prov, dept, 2024, max_rows=1)._jdf.queryExecution().executedPlan()
    # too big to broadcast: the fact is pre-aggregated per provider key before any join
    assert "partial_sum" in plan2.toString()


def test_patients_job(spark):
    a = spark.createDataFrame([("1", "Ann", "L", None, "s", "p", "F", dt.date(1990, 1, 1), "x",
                                dt.date(2024, 1, 1), "hos-a"),
                               ("2", "null", "L", None, "s", "p", "F", dt.date(1990, 1, 1), "x",
                                dt.date(2024, 1, 1), "hos-a")],
                              "PatientID string, FirstName string, LastName string, MiddleName string, SSN string, "
                              "PhoneNumber string, Gender string, DOB date, Address string, ModifiedDate date, "
                              "datasource string")
    b = spark.createDataFrame([("1", "Bo", "M", None, "s", "p", "M", None, "y", dt.date(2024, 1, 2), "hos-b")],
                              "ID string, F_Name string, L_Name string, M_Name string, SSN string, "
                              "PhoneNumber string, Gender string, DOB date, Address string, Updated_Date date, "
                              "datasource string")
    q = jobs.patients_quality(a, b)
    assert q.columns[:2] == ["Patient_Key", "SRC_PatientID"]
    flags = {r["Patient_Key"]: r["is_quarantined"] for r in q.collect()}
    assert flags == {"1-hos-a": False, "2-hos-a": True, "1-hos-b": True}
    sp = jobs.apply_batch(spark.createDataFrame([], silver("patients")), q, "patients", TS)
    assert dict(sp.dtypes)["SRC_ModifiedDate"] == "timestamp"  # I11
    assert marts.dim_patient(sp).count() == 1


def test_encounters_job_and_versions(spark):
    enc = spark.createDataFrame([
        ("E1", "P1", dt.date(2024, 1, 1), "Inpatient", "PROV1", "D1", 99213, dt.date(2024, 1, 1),
         dt.date(2024, 1, 1), "hos-a"),
        (None, "P2", dt.date(2024, 1, 1), "Inpatient", "PROV1", "D1", 99213, dt.date(2024, 1, 1),
         dt.date(2024, 1, 1), "hos-a"),
    ], "EncounterID string, PatientID string, EncounterDate date, EncounterType string, ProviderID string, "
       "DepartmentID string, ProcedureCode int, InsertedDate date, ModifiedDate date, datasource string")
    q = jobs.encounters_quality(enc)
    t1 = jobs.apply_batch(spark.createDataFrame([], silver("encounters")), q, "encounters", TS)
    t2 = jobs.apply_batch(spark.createDataFrame(t1.collect(), silver("encounters")), q, "encounters",
                          dt.datetime(2024, 6, 2))
    assert t2.count() == 3  # unchanged E1 kept once; the NULL-id row is inserted again (S2)


def test_probe_is_a_partial_aggregate_without_limit(spark):
    df = spark.range(0, 1000, numPartitions=16).select(F.col("id"))
    from claimlake.operators.joins import _probe_agg

    plan = _probe_agg(df, 0)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Limit" not in plan


def test_checked_broadcast_modes_and_multi_probe(spark):
    from claimlake.operators.joins import checked_broadcast, probe_sizes

    small = spark.range(5)
    big = spark.range(50)
    p_small, p_big = probe_sizes([small, big], max_rows=10)
    assert (p_small.rows, p_small.bounded, p_big.rows, p_big.bounded) == (5, True, 50, False)
    fact = spark.range(100).withColumnRenamed("id", "k")
    hinted = fact.join(checked_broadcast(small, "always"), F.col("k") == F.col("id"))
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert checked_broadcast(small, "never") is small
    with pytest.raises(ValueError):
        checked_broadcast(small, "sometimes")
