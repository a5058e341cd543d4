"""Bronze folders -> silver -> gold -> reports, over stored tables, two days."""

import datetime as dt

from pyspark.sql import functions as F

from claimlake.plans import layers
from claimlake.sources.schemas import BRONZE_DDL
from tests import hospital


def _patients(spark):
    a = spark.createDataFrame([("P1", "Ann", "L", None, "s", "p", "F", dt.date(1990, 1, 1), "x",
                                dt.date(2024, 1, 1), "hos-a")], BRONZE_DDL["patients_a"])
    b = spark.createDataFrame([("P9", "Bo", "M", None, "s", "p", "M", dt.date(1980, 1, 1), "y",
                                dt.date(2024, 1, 1), "hos-b")], BRONZE_DDL["patients_b"])
    return a, b


def _land(spark, root, tx):
    for h, ds in (("hosa", "hos-a"), ("hosb", "hos-b")):
        tx.filter(F.col("datasource") == ds).write.mode("overwrite").parquet(f"{root}/{h}/transactions")
        tx.limit(0).select("EncounterID", "PatientID", F.col("VisitDate").alias("EncounterDate"),
                           F.col("VisitType").alias("EncounterType"), "ProviderID",
                           F.col("DeptID").alias("DepartmentID"), "ProcedureCode",
                           F.col("InsertDate").alias("InsertedDate"), "ModifiedDate", "datasource") \
            .write.mode("overwrite").parquet(f"{root}/{h}/encounters")
        hospital.providers(spark).filter(F.col("datasource") == ds).write.mode("overwrite").parquet(
            f"{root}/{h}/providers")
        hospital.departments(spark).filter(F.col("datasource") == ds).write.mode("overwrite").parquet(
            f"{root}/{h}/departments")
    a, b = _patients(spark)
    a.write.mode("overwrite").parquet(f"{root}/hosa/patients")
    b.write.mode("overwrite").parquet(f"{root}/hosb/patients")


def test_two_day_run(spark, tmp_dir):
    names = layers.Names(
        silver={k: f"silver_t.{k}" for k in layers.Names().silver},
        gold={k: f"gold_t.{k}" for k in layers.Names().gold})
    bronze, tables = f"{tmp_dir}/bronze", f"{tmp_dir}/tables"
    tx = hospital.transactions(spark)
    _land(spark, bronze, tx)
    cpt = spark.createDataFrame([("1", "c", "visit", "active"), ("2", "c", None, "active")], BRONZE_DDL["cptcodes"])
    layers.build_silver(spark, bronze, tables, dt.datetime(2024, 6, 1), names, cptcodes=cpt)
    layers.build_gold(spark, tables, dt.datetime(2024, 6, 1), names)
    r1, _ = layers.run_reports(spark, 2024, names)
    assert {(r[0], r[1]): r[2] for r in r1.collect()}[("Ann Lee", "Cardiology")] == 351.35

    # day 2: one charge corrected at the source
    tx2 = tx.withColumn("Amount", F.when((F.col("TransactionID") == "T1") & (F.col("datasource") == "hos-a"),
                                         F.lit(110.10)).otherwise(F.col("Amount")))
    _land(spark, bronze, tx2)
    layers.build_silver(spark, bronze, tables, dt.datetime(2024, 6, 2), names)
    layers.build_gold(spark, tables, dt.datetime(2024, 6, 2), names)
    r1, r2 = layers.run_reports(spark, 2024, names)
    assert {(r[0], r[1]): r[2] for r in r1.collect()}[("Ann Lee", "Cardiology")] == 361.35
    silver_tx = spark.table(names.silver["transactions"])
    assert silver_tx.filter(F.col("TransactionID") == "T1-hos-a").count() == 2  # old version kept
    assert silver_tx.filter(F.col("TransactionID").isNull()).count() == 0
    assert spark.table(names.gold["dim_patient"]).count() == 2
    assert [r["cpt_codes"] for r in spark.table(names.gold["dim_cpt_code"]).collect()] == ["1"]
    assert r2.first()["YYYYMM"] == "202402"


def test_registry_loads(spark, tmp_dir):
    import json

    nodes = spark.createDataFrame([("root", True, None, None), ("leaf", False, "A00", "cholera")],
                                  "url string, has_child boolean, code string, t string") \
        .select("url", "has_child", "code", F.struct(F.col("t").alias("@value")).alias("title"))
    edges = spark.createDataFrame([("root", "leaf")], "url string, child_url string")
    roots = spark.createDataFrame([("root",)], "url string")
    path = f"{tmp_dir}/bronze/icd_codes"
    layers.icd_to_bronze(nodes, edges, roots, dt.date(2024, 1, 1), path)
    layers.icd_to_bronze(nodes, edges, roots, dt.date(2024, 1, 2), path)  # appended daily (S5)
    names = layers.Names(silver={k: f"silver_r.{k}" for k in layers.Names().silver},
                         gold={k: f"gold_r.{k}" for k in layers.Names().gold})
    layers.icd_silver_from_bronze(spark, path, f"{tmp_dir}/tables", names)
    assert spark.table(names.silver["icd_codes"]).count() == 1

    listing = spark.createDataFrame([(json.dumps({"results": [{"number": "1"}]}),)], "body string")
    detail = spark.createDataFrame([("1", json.dumps({"results": [{"number": "1", "enumeration_type": "NPI-1",
                                                                   "basic": {"first_name": "Ann"}}]}))],
                                   "number string, body string")
    npath = f"{tmp_dir}/bronze/npi"
    assert layers.npi_to_bronze(listing, detail, dt.date(2024, 1, 1), npath)
    assert not layers.npi_to_bronze(listing.limit(0), detail, dt.date(2024, 1, 2), npath)  # kept
    name = "npi_bronze_t"  # the same as a table
    assert layers.npi_to_bronze(listing, detail, dt.date(2024, 1, 1), f"{tmp_dir}/npi", table=name)
    assert not layers.npi_to_bronze(listing.limit(0), detail, dt.date(2024, 1, 2), f"{tmp_dir}/npi", table=name)
    assert spark.table(name).count() == 1
    layers.npi_silver_from_bronze(spark, npath, f"{tmp_dir}/tables", dt.date(2024, 1, 1), names)
    assert spark.table(names.silver["npi_extract"]).first()["first_name"] == "Ann"
