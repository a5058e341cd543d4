"""Published loads (A18, A19, P19) and the silver runs that apply them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake.plans import layers
from claimlake.sources import history_table, ingest, loads
from claimlake.sources.schemas import BRONZE_DDL
from tests import hospital
from tests.conftest import rows

D = dt.date
PATIENTS = ("hos-b", "dbo.patients")  # the only active row of the default config


def load(spark, tmp_dir, runs, table, at, config=None, sources=None):
    src = sources or {PATIENTS: spark.createDataFrame(table, "id int, v string, Updated_Date date")}
    return loads.publish_loads(spark, config or ingest.load_config(spark), src, f"{tmp_dir}/bronze", runs, at)


def loaded(spark, runs, after=0):
    got = loads.loads_between(spark, runs, after, loads.last_run(spark, runs))
    return sorted((tuple(r) for x in got for r in spark.read.parquet(x["path"]).select("id", "v").collect()), key=str)


def test_exact_border(spark, tmp_dir):
    """Rows at the last watermark are read again, and only those not loaded yet are kept."""
    runs, at = "runs_border_t", dt.datetime(2024, 1, 5)
    table = [(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2)), (2, "b", D(2024, 1, 2)), (None, "n", D(2024, 1, 2))]
    assert load(spark, tmp_dir, runs, table, at) == 1
    assert load(spark, tmp_dir, runs, table, at) == 2
    assert loaded(spark, runs, after=1) == []  # no change at the source: nothing
    table += [(2, "b", D(2024, 1, 2)), (3, "late", D(2024, 1, 2)), (1, "old", D(2024, 1, 1))]
    table[3] = (None, "changed", D(2024, 1, 2))
    load(spark, tmp_dir, runs, table, at)
    assert loaded(spark, runs, after=2) == [(2, "b"), (3, "late"), (None, "changed")]
    table.append((4, "next", D(2024, 1, 3)))
    load(spark, tmp_dir, runs, table, at)
    load(spark, tmp_dir, runs, table, at)
    assert loaded(spark, runs, after=3) == [(4, "next")]
    log = loads.load_log(spark, runs).orderBy("loaddate", "numberofrowscopied").collect()
    assert [r["numberofrowscopied"] for r in log] == [0, 0, 1, 3, 4]
    assert {r["watermarkvalue"] for r in log} == {None, "2024-01-02", "2024-01-03"}


def test_failed_run_loads_nothing(spark, tmp_dir):
    runs = "runs_failed_t"
    config = ingest.load_config(spark).withColumn("is_active", F.when(F.col("tablename") == "dbo.patients", 1).otherwise(0))
    good = spark.createDataFrame([(1, "a", D(2024, 1, 1))], "id int, v string, d date")
    sources = {("hos-a", "dbo.patients"): good.withColumnRenamed("d", "ModifiedDate"),
               PATIENTS: good.withColumnRenamed("d", "Updated_Date").withColumn("v", F.raise_error(F.lit("source is down")).cast("string"))}
    with pytest.raises(Exception, match="source is down"):
        load(spark, tmp_dir, runs, None, dt.datetime(2024, 1, 2), config, sources)
    assert loads.last_run(spark, runs) == 0 and loaded(spark, runs) == []
    sources[PATIENTS] = good.withColumnRenamed("d", "Updated_Date")
    assert load(spark, tmp_dir, runs, None, dt.datetime(2024, 1, 2), config, sources) == 1
    assert loaded(spark, runs) == [(1, "a"), (1, "a")]  # one from each source
    with pytest.raises(KeyError):
        load(spark, tmp_dir, runs, None, dt.datetime(2024, 1, 3), config, {PATIENTS: sources[PATIENTS]})


def sources(spark, tx):
    enc = tx.select("EncounterID", "PatientID", F.col("VisitDate").alias("EncounterDate"), F.col("VisitType").alias("EncounterType"), "ProviderID",
                    F.col("DeptID").alias("DepartmentID"), "ProcedureCode", F.col("InsertDate").alias("InsertedDate"), "ModifiedDate", "datasource")
    frames = {"dbo.transactions": tx, "dbo.encounters": enc, "dbo.providers": hospital.providers(spark), "dbo.departments": hospital.departments(spark)}
    out = {(ds, t): df.filter(F.col("datasource") == ds).drop("datasource") for t, df in frames.items() for ds in ("hos-a", "hos-b")}
    a = spark.createDataFrame([("P1", "Ann", "L", None, "s", "p", "F", D(1990, 1, 1), "x", D(2024, 1, 1), "hos-a"),
                               (None, "Non", "Key", None, "s", "p", "F", D(1990, 1, 1), "x", D(2024, 1, 1), "hos-a")], BRONZE_DDL["patients_a"])
    b = spark.createDataFrame([("P9", "Bo", "M", None, "s", "p", "M", D(1980, 1, 1), "y", D(2024, 1, 1), "hos-b")], BRONZE_DDL["patients_b"])
    return out | {("hos-a", "dbo.patients"): a.drop("datasource"), ("hos-b", "dbo.patients"): b.drop("datasource")}


def test_days_from_sources_to_reports(spark, tmp_dir):
    """Loads, silver, gold and reports on three days, with a silver job that stops between two tables."""
    names = layers.Names(silver={k: f"silver_l.{k}" for k in layers.Names().silver}, gold={k: f"gold_l.{k}" for k in layers.Names().gold})
    config = ingest.load_config(spark).withColumn("is_active", F.lit(1))
    runs, tables = "runs_days_t", f"{tmp_dir}/tables"

    def day(n, tx, silver=True):
        at = dt.datetime(2024, 6, n)
        loads.publish_loads(spark, config, sources(spark, tx), f"{tmp_dir}/bronze", runs, at)
        return layers.build_silver_from_loads(spark, runs, tables, at, names, buckets=3) if silver else None

    def charges():
        layers.build_gold(spark, tables, dt.datetime(2024, 6, 9), names)
        return {(r[0], r[1]): r[2] for r in layers.run_reports(spark, 2024, names)[0].collect()}[("Ann Lee", "Cardiology")]

    tx = hospital.transactions(spark)
    assert day(1, tx) == 1
    first = rows(spark.table(names.silver["patients"]))
    assert charges() == 351.35
    corrected = (F.col("TransactionID") == "T1") & (F.col("datasource") == "hos-a")
    tx2 = tx.withColumn("Amount", F.when(corrected, F.lit(110.10)).otherwise(F.col("Amount"))).withColumn(
        "ModifiedDate", F.when(corrected, F.lit(D(2025, 2, 1))).otherwise(F.col("ModifiedDate")))
    day(2, tx2, silver=False)
    tx3 = tx2.withColumn("Amount", F.when(corrected, F.lit(120.10)).otherwise(F.col("Amount"))).withColumn(
        "ModifiedDate", F.when(corrected, F.lit(D(2025, 2, 2))).otherwise(F.col("ModifiedDate")))
    day(3, tx3, silver=False)
    # a silver job that stopped after its first table's first run
    table = layers.silver_history("transactions", tables, names)
    paths = loads.entity_loads(loads.loads_between(spark, runs, 1, 2), "transactions")[2]
    history_table.apply_stored(spark, table, layers.quality_batch(spark, "transactions", paths), dt.datetime(2024, 6, 2), 2)
    assert layers.build_silver_from_loads(spark, runs, tables, dt.datetime(2024, 6, 4), names) == 3
    assert charges() == 371.35
    t1 = spark.table(names.silver["transactions"]).filter(F.col("TransactionID") == "T1-hos-a")
    assert rows(t1, "Amount", "is_current", "audit_modifieddate") == [
        (100.10, False, dt.datetime(2024, 6, 2)), (110.10, False, dt.datetime(2024, 6, 4)), (120.10, True, dt.datetime(2024, 6, 4))]
    assert rows(spark.table(names.silver["patients"])) == first  # NULL keys are not loaded again
    before = {e: rows(spark.table(names.silver[e])) for e in ("transactions", "encounters")}
    assert layers.build_silver_from_loads(spark, runs, tables, dt.datetime(2024, 6, 5), names) == 3
    assert {e: rows(spark.table(names.silver[e])) for e in before} == before


def test_published_extracts_are_not_stored_again(spark, tmp_dir, monkeypatch):
    """A silver run reads the folders of the loads: what it applies is written once, to the table."""
    names, stored = layers.Names(silver={k: f"silver_once.{k}" for k in layers.Names().silver}), []
    scratch = history_table.scratch_path
    monkeypatch.setattr(history_table, "scratch_path", lambda *a: stored.append(a) or scratch(*a))
    config = ingest.load_config(spark).withColumn("is_active", (F.col("tablename") == "dbo.transactions").cast("int"))
    tx = hospital.transactions(spark)
    days = (tx, tx.withColumn("Amount", F.lit(1.5)).withColumn("ModifiedDate", F.lit(D(2030, 1, 1))))
    for n, rows_ in enumerate(days, 1):
        at = dt.datetime(2024, 6, n)
        loads.publish_loads(spark, config, sources(spark, rows_), f"{tmp_dir}/bronze", "runs_once_t", at)
        assert layers.build_silver_from_loads(spark, "runs_once_t", f"{tmp_dir}/t", at, names, buckets=3) == n
    keyed, table = tx.filter("TransactionID IS NOT NULL").count(), spark.table(names.silver["transactions"])
    assert table.filter("TransactionID IS NOT NULL AND is_current AND Amount = 1.5").count() == keyed
    assert table.count() == 2 * tx.count()
    assert not stored


def test_source_without_a_load(spark, tmp_dir):
    names = layers.Names(silver={k: f"silver_one.{k}" for k in layers.Names().silver})
    config = ingest.load_config(spark)  # patients of hospital B only
    loads.publish_loads(spark, config, sources(spark, hospital.transactions(spark)), f"{tmp_dir}/bronze", "runs_one_t", dt.datetime(2024, 6, 1))
    assert layers.build_silver_from_loads(spark, "runs_one_t", f"{tmp_dir}/t", dt.datetime(2024, 6, 1), names) == 1
    assert rows(spark.table(names.silver["patients"]), "Patient_Key") == [("P9-hos-b",)]
    assert spark.table(names.silver["transactions"]).count() == 0
    assert not spark.catalog.tableExists(names.silver["providers"])
