"""Registered queries: one per operator id of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (via ``standins``) and runs the
library's operators over them; ``claimlake.plans.oracle`` holds the SQL a
second engine runs for the same result. Column names match the oracle's.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions.keys import prefixed_key, surrogate_key
from claimlake.functions.predicates import changed_between
from claimlake.operators import conform as cf
from claimlake.operators import history as hist
from claimlake.operators import marts, nested, quality, reports
from claimlake.plans import jobs, layers, standins as st
from claimlake.session import scratch_path
from claimlake.sources import history_table, ingest, loads, tables
from claimlake.sources.schemas import CONTROL_DDL, GOLD_DDL, schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _gold_ntz(name: str):
    return schema(GOLD_DDL[name].replace("timestamp", "timestamp_ntz"))


# ---------------------------------------------------------------- star + reports
def _tx_quality(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    return jobs.transactions_quality(st.bronze_transactions(spark, sf_dir, day))


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table that the facts read: all transactions, loaded once
    (``p1_silver_transactions`` checks their keys, S6)."""
    return hist.scd2_initial(_tx_quality(spark, sf_dir, 2), st.ntz_schema("transactions"),
                             st.ts_ntz(st.BATCH_TS_1))


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_transactions(silver_transactions(spark, sf_dir), st.ts_ntz(st.REFRESHED_AT))


def gold_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_provider(jobs.providers_silver(st.providers_bronze(spark, sf_dir)))


def gold_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_department(jobs.departments_silver(st.departments_bronze(spark, sf_dir)))


@register("e1_charges_by_provider")
def e1_charges_by_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.charges_by_provider(gold_fact(spark, sf_dir), gold_providers(spark, sf_dir),
                                       gold_departments(spark, sf_dir))


@register("e2_monthly_charges")
def e2_monthly_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monthly_charges(gold_fact(spark, sf_dir), gold_providers(spark, sf_dir),
                                   gold_departments(spark, sf_dir), st.REPORT_YEAR)


@register("p1_silver_transactions")
def p1_silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over two days, stored: the first load, then day 2's batch (23 tracked columns) onto the current part."""
    import uuid

    names = layers.Names(silver={"transactions": f"claimlake_transactions_{uuid.uuid4().hex[:8]}"})
    table = layers.silver_history("transactions", scratch_path(spark, "silver"), names, st.ntz_schema("transactions"))
    for day, ts in ((1, st.BATCH_TS_1), (2, st.BATCH_TS_2)):
        history_table.apply_stored(spark, table, _tx_quality(spark, sf_dir, day), st.ts_ntz(ts), repeatable=True)
    return spark.table(table.name)


@register("p17_fact_transactions")
def p17_fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_fact(spark, sf_dir)


@register("i10_casts")
def i10_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact query's own column names (fixed values), inserted by position with casts."""
    t = marts.publishable(silver_transactions(spark, sf_dir))
    sel = t.select(
        "TransactionID", "SRC_TransactionID", "EncounterID",
        surrogate_key("PatientID", "datasource").alias("FK_Patient_ID"),
        prefixed_key("ProviderID", "datasource").alias("FK_Provider_ID"),
        surrogate_key("DeptID", "datasource").alias("FK_Dept_ID"),
        "ICDCode", F.col("ProcedureCode").alias("CPT_Code"), "VisitType", "ServiceDate", "PaidDate",
        F.col("Amount").alias("Charge_Amt"), F.col("PaidAmount").alias("Paid_Amt"), "AmountType",
        "ClaimID", "datasource", st.ts_ntz(st.REFRESHED_AT),
    )
    return cf.conform_to(sel, _gold_ntz("fact_transactions"), by="position")


@register("p12_dim_provider")
def p12_dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_providers(spark, sf_dir)


@register("p13_dim_department")
def p13_dim_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_departments(spark, sf_dir)


@register("b11_prefixed_key")
def b11_prefixed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = st.table(spark, sf_dir, "supplier")
    ds = (F.when(F.col("s_nationkey") < 10, F.lit("hos-a")).when(F.col("s_nationkey") < 20, F.lit("hos-b"))
          .when(F.col("s_nationkey") < 23, F.lit("hos-c")).otherwise(F.lit(None).cast("string")))
    x = s.select("s_suppkey", ds.alias("datasource"))
    return x.select("s_suppkey", "datasource",
                    prefixed_key(F.col("s_suppkey").cast("string"), "datasource").alias("FK_ProviderID"))


@register("e6_distinct")
def e6_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + E6 + I9: the same providers extracted twice, unioned, made distinct."""
    b = st.providers_bronze(spark, sf_dir)
    return jobs.providers_silver(b, b)


# ---------------------------------------------------------------- conform / quality
def _patients_quality(spark: SparkSession, sf_dir: str, day: int = 2) -> DataFrame:
    a, b = st.patients_bronze(spark, sf_dir, day)
    return jobs.patients_quality(a, b)


@register("b3_conform")
def b3_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = st.patients_bronze(spark, sf_dir)
    return cf.union_sources(cf.conform(a, jobs.PATIENT_MODEL_A), cf.conform(b, jobs.PATIENT_MODEL_B))


@register("b6_quarantine")
def b6_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patients_quality(spark, sf_dir)


@register("g3_quarantined_first")
def g3_quarantined_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantined_first(_patients_quality(spark, sf_dir))


@register("p3_silver_patients")
def p3_silver_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 over two days: both hospitals' patients, 12 tracked columns."""
    day1 = jobs.apply_batch(st.empty_silver(spark, "patients"), _patients_quality(spark, sf_dir, 1),
                            "patients", st.ts_ntz(st.BATCH_TS_1))
    return jobs.apply_batch(day1, _patients_quality(spark, sf_dir, 2), "patients", st.ts_ntz(st.BATCH_TS_2))


@register("p11_dim_patient")
def p11_dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_patient(p3_silver_patients(spark, sf_dir))


@register("b5_surrogate_key")
def b5_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.with_source_key(st.encounters_bronze(spark, sf_dir, 2), "EncounterID")


@register("h1_union_by_name")
def h1_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = st.encounters_bronze(spark, sf_dir, 2)
    a = enc.filter(F.col("datasource") == "hos-a")
    b = enc.filter(F.col("datasource") == "hos-b")
    b = b.select(*reversed(b.columns))  # hospital B lists its columns in another order
    return cf.union_sources(a, b, by="name")


@register("h2_union_by_position")
def h2_union_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = st.encounters_bronze(spark, sf_dir, 2)
    a = enc.filter(F.col("datasource") == "hos-a")
    b = enc.filter(F.col("datasource") == "hos-b")
    return cf.union_sources(a, b, by="position")


# ---------------------------------------------------------------- history (SCD2)
def _enc_quality(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    return jobs.encounters_quality(st.encounters_bronze(spark, sf_dir, day))


def _enc_loaded_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 is the first load of the empty table: every row current at batch 1."""
    return hist.scd2_initial(_enc_quality(spark, sf_dir, 1), st.ntz_schema("encounters"),
                             st.ts_ntz(st.BATCH_TS_1), key="EncounterID")


@register("d5_scd2")
def d5_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.apply_batch(_enc_loaded_day1(spark, sf_dir), _enc_quality(spark, sf_dir, 2),
                            "encounters", st.ts_ntz(st.BATCH_TS_2))


@register("d1_expire")
def d1_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.scd2_expire(_enc_loaded_day1(spark, sf_dir), _enc_quality(spark, sf_dir, 2),
                            "EncounterID", ts=st.ts_ntz(st.BATCH_TS_2), audit=hist.TX_AUDIT)


@register("d2_insert")
def d2_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's two passes over a stored table: D1 is written, then D2 reads it (must equal D5)."""
    root = scratch_path(spark, "passes")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    batch = stored(_enc_quality(spark, sf_dir, 2), "batch")
    day1 = stored(_enc_loaded_day1(spark, sf_dir), "day1")
    expired = stored(hist.scd2_expire(day1, batch, "EncounterID", ts=st.ts_ntz(st.BATCH_TS_2), audit=hist.TX_AUDIT), "pass1")
    return hist.scd2_insert(expired, batch, "EncounterID", ts=st.ts_ntz(st.BATCH_TS_2), audit=hist.TX_AUDIT)


@register("b12_changed")
def b12_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _enc_quality(spark, sf_dir, 1).alias("t")
    s = _enc_quality(spark, sf_dir, 2).alias("s")
    tracked = [c for c in _enc_quality(spark, sf_dir, 1).columns if c != "EncounterID"]
    j = t.join(s, F.col("t.EncounterID") == F.col("s.EncounterID"), "inner")
    return j.select(F.col("t.EncounterID").alias("EncounterID"),
                    changed_between("t", "s", tracked).alias("is_changed"),
                    changed_between("t", "s", tracked, null_safe=True).alias("is_changed_null_safe"))


@register("c4_unmatched")
def c4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.unmatched(_enc_quality(spark, sf_dir, 2), _enc_loaded_day1(spark, sf_dir), "EncounterID")


@register("b8_publishable")
def b8_publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.publishable(d5_scd2(spark, sf_dir))


@register("d6_snapshot")
def d6_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.snapshot(d5_scd2(spark, sf_dir))


@register("e4_versions")
def e4_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.versions_per_key(d5_scd2(spark, sf_dir), "EncounterID")


@register("e5_rows_per_key")
def e5_rows_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.rows_per_source_key(d5_scd2(spark, sf_dir), ["SRC_EncounterID", "datasource"], "PatientID")


@register("s5_latest_per_key")
def s5_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_per_key(st.codes_staged(spark, sf_dir), "icd_code", ["updated_date", "inserted_date"])


@register("d4_upsert_flagged")
def d4_upsert_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.icd_silver(st.codes_known(spark, sf_dir), st.codes_staged(spark, sf_dir))


@register("p15_dim_icd")
def p15_dim_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_icd(d4_upsert_flagged(spark, sf_dir), st.ts_ntz(st.REFRESHED_AT))


@register("p6_silver_cptcodes")
def p6_silver_cptcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 over two days, stored: new, retired and quarantined codes."""
    import uuid

    names = layers.Names(silver={"cptcodes": f"claimlake_cptcodes_{uuid.uuid4().hex[:8]}"})
    table = layers.silver_history("cptcodes", scratch_path(spark, "silver"), names, st.ntz_schema("cptcodes"))
    for day, ts in ((1, st.BATCH_TS_1), (2, st.BATCH_TS_2)):
        history_table.apply_stored(spark, table, jobs.cpt_quality(st.cpt_bronze(spark, sf_dir, day)), st.ts_ntz(ts))
    return spark.table(table.name)


@register("p14_dim_cpt_code")
def p14_dim_cpt_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_cpt_code(p6_silver_cptcodes(spark, sf_dir), st.ts_ntz(st.REFRESHED_AT))


# ---------------------------------------------------------------- registry JSON
NPI_DATE = _dt.date(2024, 1, 3)
NPI_DATE_2 = _dt.date(2024, 1, 4)


@register("j1_flatten_registry")
def j1_flatten_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten_registry(st.npi_detail_docs(spark, sf_dir, unknown=True), NPI_DATE)


@register("j5_detail_for")
def j5_detail_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = nested.detail_for(st.npi_list_docs(spark, sf_dir), st.npi_detail_docs(spark, sf_dir))
    return nested.flatten_registry(detail, NPI_DATE)


@register("p16_dim_npi")
def p16_dim_npi(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = jobs.npi_silver(st.empty_silver(spark, "npi_extract"),
                             nested.flatten_registry(st.npi_detail_docs(spark, sf_dir), NPI_DATE), NPI_DATE)
    return marts.dim_npi(silver, st.ts_ntz(st.REFRESHED_AT))


@register("p8_npi_scd2")
def p8_npi_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 over two days, stored: dates as audit values, five tracked fields."""
    import uuid

    table = layers.npi_history(scratch_path(spark, "silver"), layers.Names(silver={"npi_extract": f"claimlake_npi_{uuid.uuid4().hex[:8]}"}))
    for day, date in ((1, NPI_DATE), (2, NPI_DATE_2)):
        layers.apply_npi(spark, table, nested.flatten_registry(st.npi_detail_docs(spark, sf_dir, day), date), date)
    return spark.table(table.name)


@register("j6_hierarchy_leaves")
def j6_hierarchy_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges, roots = st.hierarchy(spark, sf_dir)
    return nested.code_rows_from(nested.hierarchy_leaves(nodes, edges, roots), NPI_DATE)


# ---------------------------------------------------------------- sources / sinks
@register("a2_path_view")
def a2_path_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.path_view(spark, "claimlake_region", f"{sf_dir}/region.parquet")


@register("a7_append")
def a7_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A7: append the same extract twice to a fresh bronze folder, scan it back."""
    root = scratch_path(spark, "bronze")
    nation = st.table(spark, sf_dir, "nation")
    for _ in range(2):
        tables.write_bronze(nation, f"{root}/hosa/nation", mode="append")
    return tables.read_bronze(spark, root, "hosa", "nation")


@register("a8_overwrite_skip_empty")
def a8_overwrite_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite with the extract; an empty extract later leaves it in place."""
    path = f"{scratch_path(spark, 'bronze')}/npi_extract"
    flat = nested.flatten_registry(st.npi_detail_docs(spark, sf_dir), NPI_DATE)
    tables.write_bronze(flat, path, mode="overwrite", skip_empty=True)
    tables.write_bronze(flat.where(F.lit(False)), path, mode="overwrite", skip_empty=True)
    return spark.read.parquet(path)


@register("a13_full_refresh")
def a13_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + A11 + A12 + A13: declared table, then INSERT OVERWRITE by position."""
    import uuid

    name = f"claimlake_dim_department_{uuid.uuid4().hex[:8]}"
    tables.ensure_table(spark, name, schema(GOLD_DDL["dim_department"]), location=scratch_path(spark, "gold"))
    dims = gold_departments(spark, sf_dir)
    tables.full_refresh(dims, name)
    tables.full_refresh(dims, name)  # a second refresh replaces, never appends
    return spark.table(name)


@register("a11_replace_table")
def a11_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged replacement: v1 written and swapped in, then v2 replaces it in one catalog change."""
    import uuid

    name = f"claimlake_dim_provider_{uuid.uuid4().hex[:8]}"
    root = scratch_path(spark, "gold")
    dims = gold_providers(spark, sf_dir)
    tables.replace_table(dims.where(F.col("datasource") == "hos-a"), name, root)
    tables.replace_table(dims, name, root)
    return spark.table(name)


@register("a15_mapped_load")
def a15_mapped_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two mapped files loaded, and joined so that the answer holds both."""
    root = scratch_path(spark, "landing")
    mapping = [
        {"Container": "raw", "FilePath": "HospitalA", "FileName": "nation.csv",
         "DatabaseName": "rcmhospital_a", "TableName": "Nation"},
        {"Container": "raw", "FilePath": "HospitalA", "FileName": "region.csv",
         "DatabaseName": "rcmhospital_a", "TableName": "Region"},
    ]
    for m, t in zip(mapping, ("nation", "region")):
        st.table(spark, sf_dir, t).write.option("header", True).csv(
            f"{root}/{m['Container']}/{m['FilePath']}/{m['FileName']}")
    loaded = ingest.load_mapped_files(spark, mapping, root, {
        "Nation": schema("n_nationkey int, n_name string, n_regionkey int"),
        "Region": schema("r_regionkey int, r_name string"),
    })
    nation, region = loaded["rcmhospital_a.Nation"], loaded["rcmhospital_a.Region"]
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "full_outer")


@register("a15_checked_load")
def a15_checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer file with its columns in another order, and lines of nation 3 without a readable id:
    rows bound by header name, and those lines set aside."""
    root = scratch_path(spark, "landing")
    mapping = [{"Container": "raw", "FilePath": "HospitalB", "FileName": "patients.csv", "DatabaseName": "rcmhospital_b", "TableName": "Customer"}]
    c = st.table(spark, sf_dir, "customer")
    lost = F.when(F.col("c_nationkey") == 3, "n/a").otherwise(F.col("c_custkey").cast("string"))
    lines = c.select("c_name", F.col("c_nationkey").alias("C_NationKey"), lost.alias("c_custkey"), F.col("c_mktsegment").alias("extra"))
    lines.write.option("header", True).csv(f"{root}/raw/HospitalB/patients.csv")
    shape = schema("c_custkey long, c_name string, c_nationkey int")
    got = ingest.land_mapped_files(spark, mapping, root, {"Customer": shape}, f"{root}/landed")["rcmhospital_b.Customer"]
    count = lambda n: F.lit(n).cast("long")
    rows = got.rows.select("*", F.lit(None).cast("string").alias("line"), count(got.n_rows).alias("n"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in shape.fields]
    return rows.unionByName(got.rejects.select(*none, "line", count(got.n_rejects).alias("n")))


@register("a17_full_extract")
def a17_full_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.extract_full(st.table(spark, sf_dir, "supplier"), "hos-a")


@register("a18_incremental_extract")
def a18_incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.extract_incremental(st.table(spark, sf_dir, "orders"), "o_orderdate",
                                      _dt.date(1998, 1, 1), "hos-b")


def _load_sources(spark: SparkSession, sf_dir: str, day: int) -> dict[tuple[str, str], DataFrame]:
    enc = st.encounters_bronze(spark, sf_dir, day)
    tx = st.bronze_transactions(spark, sf_dir, day)
    prov = st.providers_bronze(spark, sf_dir)
    dept = st.departments_bronze(spark, sf_dir)
    pa, pb = st.patients_bronze(spark, sf_dir, day)
    out: dict[tuple[str, str], DataFrame] = {}
    for ds in ("hos-a", "hos-b"):
        for name, df in (("dbo.encounters", enc), ("dbo.transactions", tx), ("dbo.providers", prov),
                         ("dbo.departments", dept)):
            out[(ds, name)] = df.filter(F.col("datasource") == ds).drop("datasource")
    out[("hos-a", "dbo.patients")] = pa.drop("datasource")
    out[("hos-b", "dbo.patients")] = pb.drop("datasource")
    return out


def _load_days(spark: SparkSession, sf_dir: str, days: int) -> tuple[str, str]:
    """P19 for one or two days into a fresh bronze folder and log table: the
    full loads of hospital B are inactive. Returns (folder, log table)."""
    import uuid

    log, root = f"claimlake_load_logs_{uuid.uuid4().hex[:8]}", scratch_path(spark, "bronze")
    shape = schema(CONTROL_DDL["load_logs"].replace("timestamp", "timestamp_ntz"))
    tables.ensure_table(spark, log, shape, location=scratch_path(spark, "log"))
    inactive = (F.col("datasource") == "hos-b") & (F.col("loadtype") == "Full")
    config = ingest.load_config(spark).withColumn("is_active", F.when(inactive, 0).otherwise(1))
    for day, ts in ((1, st.BATCH_TS_1), (2, st.BATCH_TS_2))[:days]:
        ingest.run_loads(spark, config, _load_sources(spark, sf_dir, day), root, log, st.ts_ntz(ts))
    return root, log


@register("a19_load_log")
def a19_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P19 first run (A16 plan, A17/A18 extracts written, A19 log appended)."""
    return spark.table(_load_days(spark, sf_dir, 1)[1])


@register("a20_latest_watermark")
def a20_latest_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20 after two runs, with what the second wrote: its incremental loads
    start at the largest value that the first one recorded."""
    log = spark.table(_load_days(spark, sf_dir, 2)[1])
    last = ingest.latest_watermark(log)
    return last.join(log, ["data_source", "tablename"]).filter(F.col("loaddate") == F.col("last_loaddate")).select(
        "data_source", "tablename", "last_loaddate", "numberofrowscopied", "watermarkvalue")


@register("p19_loaded_encounters")
def p19_loaded_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hospitals' encounters as two runs left them in bronze."""
    root, _ = _load_days(spark, sf_dir, 2)
    return cf.union_sources(*[tables.read_bronze(spark, root, h, "encounters") for h in ("hosa", "hosb")])


def _two_days_to_silver(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """P19 into P1-P3: two runs loaded and published, each followed by a silver run that applies what is new."""
    import uuid

    tag, root = uuid.uuid4().hex[:8], scratch_path(spark, "loads")
    config = ingest.load_config(spark).withColumn("is_active", (F.col("tablename") == f"dbo.{entity}").cast("int"))
    names = layers.Names(silver={e: f"claimlake_{e}_{tag}" for e in layers.Names().silver})
    for day, ts in ((1, st.BATCH_TS_1), (2, st.BATCH_TS_2)):
        loads.publish_loads(spark, config, _load_sources(spark, sf_dir, day), f"{root}/bronze", f"claimlake_runs_{tag}", st.ts_ntz(ts))
        layers.build_silver_from_loads(spark, f"claimlake_runs_{tag}", f"{root}/silver", st.ts_ntz(ts), names, {entity: st.ntz_schema(entity)})
    return spark.table(names.silver[entity])


@register("p19_two_days_transactions")
def p19_two_days_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days_to_silver(spark, sf_dir, "transactions")


@register("p19_two_days_encounters")
def p19_two_days_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days_to_silver(spark, sf_dir, "encounters")


@register("p19_two_days_patients")
def p19_two_days_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days_to_silver(spark, sf_dir, "patients")


@register("a9_overwrite_table")
def a9_overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table's content and columns replaced by another extract."""
    import uuid

    name = f"claimlake_npi_{uuid.uuid4().hex[:8]}"
    tables.overwrite_table(st.npi_list_docs(spark, sf_dir), name)
    tables.overwrite_table(nested.flatten_registry(st.npi_detail_docs(spark, sf_dir), NPI_DATE), name)
    return spark.table(name)


@register("p9_icd_to_bronze")
def p9_icd_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on two days: the code walk's rows appended to bronze each day."""
    path = f"{scratch_path(spark, 'bronze')}/icd_codes"
    nodes, edges, roots = st.hierarchy(spark, sf_dir)
    for day in (NPI_DATE, NPI_DATE_2):
        layers.icd_to_bronze(nodes, edges, roots, day, path)
    return spark.read.parquet(path)


@register("p10_npi_to_bronze")
def p10_npi_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 on two days: the second answer replaces the first, a later empty one does not."""
    path = f"{scratch_path(spark, 'bronze')}/npi_extract"
    listed = st.npi_list_docs(spark, sf_dir)
    layers.npi_to_bronze(listed, st.npi_detail_docs(spark, sf_dir, 1), NPI_DATE, path)
    layers.npi_to_bronze(listed, st.npi_detail_docs(spark, sf_dir, 2), NPI_DATE_2, path)
    layers.npi_to_bronze(listed.where(F.lit(False)), st.npi_detail_docs(spark, sf_dir, 2), NPI_DATE_2, path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- streaming
@register("st1_stream_scd2")
def st1_stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 as a Structured Streaming run: day 1's extract lands, the stream
    applies it; day 2's extract lands, the same stream (same checkpoint)
    applies only the new files. Must equal ``d5_scd2``."""
    import uuid

    from claimlake.streaming.incremental import run_once

    root = scratch_path(spark, "stream")
    table_name = f"claimlake_encounters_{uuid.uuid4().hex[:8]}"
    clock = {0: st.BATCH_TS_1, 1: st.BATCH_TS_2}
    day1, day2 = (st.encounters_bronze(spark, sf_dir, d) for d in (1, 2))
    kwargs = dict(landing=f"{root}/landing", bronze_schema=day1.schema, table=table_name,
                  table_root=f"{root}/silver", target_schema=st.ntz_schema("encounters"), key="EncounterID",
                  quality=jobs.encounters_quality, batch_time=clock.__getitem__,
                  checkpoint=f"{root}/checkpoint")
    day1.write.mode("append").parquet(f"{root}/landing")
    run_once(spark, **kwargs)
    day2.write.mode("append").parquet(f"{root}/landing")
    run_once(spark, **kwargs)
    return spark.table(table_name)
