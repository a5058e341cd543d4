"""Layer runs over stored tables: bronze folders -> silver tables -> gold tables -> reports.

This is what a scheduled run calls. Each table is replaced through a staged
version folder and one catalog change (``replace_table``); SCD2 tables read
their own current version while the next one is written.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from claimlake.operators import marts, nested, reports
from claimlake.operators.conform import union_sources
from claimlake.operators.history import NPI_AUDIT, PATIENT_AUDIT, TX_AUDIT
from claimlake.plans import jobs
from claimlake.sources import history_table, loads, schemas
from claimlake.sources.history_table import HistoryTable
from claimlake.sources.tables import empty_table, read_bronze, replace_table, write_bronze

HOSPITALS = ("hosa", "hosb")  # bronze folder per source (the load config's targetpath)


@dataclass
class Names:
    """Catalog names of the silver and gold tables."""

    silver: dict[str, str] = field(default_factory=lambda: {
        t: f"silver.{t}" for t in ("transactions", "encounters", "patients", "providers", "departments",
                                   "cptcodes", "icd_codes", "npi_extract")})
    gold: dict[str, str] = field(default_factory=lambda: {
        t: f"gold.{t}" for t in ("fact_transactions", "dim_patient", "dim_provider", "dim_department",
                                 "dim_cpt_code", "dim_icd", "dim_npi")})


def _current(spark: SparkSession, name: str, schema) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else empty_table(spark, schema)


def _bronze(spark: SparkSession, root: str, entity: str) -> list[DataFrame]:
    return [read_bronze(spark, root, h, entity) for h in HOSPITALS]


def build_silver(spark: SparkSession, bronze_root: str, table_root: str, ts: _dt.datetime,
                 names: Names | None = None, cptcodes: DataFrame | None = None) -> None:
    """Apply today's bronze extracts to the silver tables.

    ``cptcodes``: the CPT code file's rows, on days when one has landed.
    """
    n = (names or Names()).silver
    scd2 = {
        "transactions": jobs.transactions_quality(union_sources(*_bronze(spark, bronze_root, "transactions"))),
        "encounters": jobs.encounters_quality(union_sources(*_bronze(spark, bronze_root, "encounters"))),
        "patients": jobs.patients_quality(*_bronze(spark, bronze_root, "patients")),
    }
    if cptcodes is not None:
        scd2["cptcodes"] = jobs.cpt_quality(cptcodes)
    for entity, batch in scd2.items():
        current = _current(spark, n[entity], schemas.silver(entity))
        replace_table(jobs.apply_batch(current, batch, entity, ts), n[entity], table_root)
    replace_table(jobs.providers_silver(*_bronze(spark, bronze_root, "providers")), n["providers"], table_root)
    replace_table(jobs.departments_silver(*_bronze(spark, bronze_root, "departments")), n["departments"],
                  table_root)


def silver_history(entity: str, table_root: str, names: Names | None = None, shape: T.StructType | None = None,
                   buckets: int | None = None) -> HistoryTable:
    """The stored SCD2 table of one entity (``shape``: the declared silver schema by default)."""
    audit = PATIENT_AUDIT if entity == "patients" else TX_AUDIT
    return HistoryTable((names or Names()).silver[entity], table_root, schemas.SCD2_KEYS[entity],
                        shape or schemas.silver(entity), audit, buckets)


def quality_batch(spark: SparkSession, entity: str, paths: Mapping[str, str]) -> DataFrame:
    """P1-P3 (view part) over one run's load folders, by data source; a source without a load adds nothing."""
    if entity == "patients":
        frames = [spark.read.parquet(paths[ds]) if ds in paths else empty_table(spark, schemas.bronze(f"patients_{ds[-1]}"))
                  for ds in ("hos-a", "hos-b")]
        return jobs.patients_quality(*frames)
    quality = {"transactions": jobs.transactions_quality, "encounters": jobs.encounters_quality}[entity]
    return quality(union_sources(*[spark.read.parquet(path) for _, path in sorted(paths.items())]))


def build_silver_from_loads(spark: SparkSession, runs_table: str, table_root: str, ts: _dt.datetime | Column,
                            names: Names | None = None, shapes: Mapping[str, T.StructType] | None = None,
                            buckets: int | None = None, cptcodes: DataFrame | None = None) -> int:
    """P1-P6 from published loads; returns the last run applied.

    Each SCD2 table takes the runs that it has not applied yet, one after the
    other, and records the run in the commit of its rows: a job that failed
    between two tables goes on where each of them is. Providers and
    departments are reloaded from their sources' last full loads.
    ``cptcodes``: the CPT code file's rows, on days when one has landed.
    """
    nm, shapes = names or Names(), shapes or {}
    through = loads.last_run(spark, runs_table)
    tables = {e: silver_history(e, table_root, nm, shapes.get(e), buckets) for e in ("transactions", "encounters", "patients")}
    done = {e: history_table.state_of(spark, t).applied for e, t in tables.items()}
    pending = loads.loads_between(spark, runs_table, min(done.values()), through)
    for entity, table in tables.items():
        for run, paths in sorted(loads.entity_loads(pending, entity).items()):
            if run > done[entity]:
                done[entity] = history_table.apply_stored(spark, table, quality_batch(spark, entity, paths), ts, run, repeatable=True).applied
        if done[entity] < through:
            history_table.mark_applied(spark, table, through)
    if cptcodes is not None:
        table = silver_history("cptcodes", table_root, nm, shapes.get("cptcodes"), buckets)
        history_table.apply_stored(spark, table, jobs.cpt_quality(cptcodes), ts)
    for entity, build in (("providers", jobs.providers_silver), ("departments", jobs.departments_silver)):
        paths = loads.last_full_loads(spark, runs_table, entity, through)
        if paths:
            replace_table(build(*[spark.read.parquet(p) for p in paths]), nm.silver[entity], table_root)
    return through


def build_gold(spark: SparkSession, table_root: str, refreshed_at: _dt.datetime,
               names: Names | None = None) -> None:
    """Reload the star schema from silver (each table in one swap)."""
    nm = names or Names()
    s, g = nm.silver, nm.gold
    # Reports filter the fact by service-date ranges: cluster it by that date.
    replace_table(marts.fact_transactions(spark.table(s["transactions"]), refreshed_at),
                  g["fact_transactions"], table_root, cluster_by=["ServiceDate"])
    replace_table(marts.dim_patient(spark.table(s["patients"])), g["dim_patient"], table_root)
    replace_table(marts.dim_provider(spark.table(s["providers"])), g["dim_provider"], table_root)
    replace_table(marts.dim_department(spark.table(s["departments"])), g["dim_department"], table_root)
    for entity, build in (("cptcodes", marts.dim_cpt_code), ("icd_codes", marts.dim_icd),
                          ("npi_extract", marts.dim_npi)):
        if spark.catalog.tableExists(s[entity]):
            gold_name = {"cptcodes": "dim_cpt_code", "icd_codes": "dim_icd", "npi_extract": "dim_npi"}[entity]
            replace_table(build(spark.table(s[entity]), refreshed_at), g[gold_name], table_root)


def run_reports(spark: SparkSession, year: int, names: Names | None = None) -> tuple[DataFrame, DataFrame]:
    """Report 1 and report 2 over the gold tables."""
    g = (names or Names()).gold
    fact, prov, dept = (spark.table(g[t]) for t in ("fact_transactions", "dim_provider", "dim_department"))
    return (reports.charges_by_provider(fact, prov, dept),
            reports.monthly_charges(fact, prov, dept, year))


def icd_to_bronze(nodes: DataFrame, edges: DataFrame, roots: DataFrame, batch_date: _dt.date,
                  path: str) -> bool:
    """Walk the code hierarchy, shape ICD rows, append them to bronze."""
    rows = nested.code_rows_from(nested.hierarchy_leaves(nodes, edges, roots), batch_date)
    return write_bronze(rows, path, mode="append")


def npi_to_bronze(list_docs: DataFrame, detail_docs: DataFrame, batch_date: _dt.date, path: str,
                  table: str | None = None) -> bool:
    """P10: listed numbers -> detail answers -> flat NPI rows; overwrite bronze
    only when something came back (A8): the folder ``path``, or with ``table``
    that table, whose versions go below ``path``."""
    rows = nested.flatten_registry(nested.detail_for(list_docs, detail_docs), batch_date)
    if table is not None:
        return replace_table(rows, table, path, skip_empty=True) is not None
    return write_bronze(rows, path, mode="overwrite", skip_empty=True)


def icd_silver_from_bronze(spark: SparkSession, bronze_path: str, table_root: str,
                           names: Names | None = None) -> None:
    """Newest staged row per code, upserted into silver."""
    n = (names or Names()).silver["icd_codes"]
    current = _current(spark, n, schemas.silver("icd_codes"))
    replace_table(jobs.icd_silver(current, spark.read.parquet(bronze_path)), n, table_root)


def npi_history(table_root: str, names: Names | None = None, buckets: int | None = None) -> HistoryTable:
    """The stored SCD2 table of the NPI registry."""
    return HistoryTable((names or Names()).silver["npi_extract"], table_root, schemas.SCD2_KEYS["npi_extract"],
                        schemas.silver("npi_extract"), NPI_AUDIT, buckets)


def apply_npi(spark: SparkSession, table: HistoryTable, bronze_npi: DataFrame, run_date: _dt.date) -> history_table.State:
    return history_table.apply_stored(spark, table, jobs.npi_batch(bronze_npi), run_date, tracked=jobs.NPI_TRACKED)


def npi_silver_from_bronze(spark: SparkSession, bronze_path: str, table_root: str, run_date: _dt.date,
                           names: Names | None = None) -> None:
    """NPI bronze -> SCD2 silver with dates as audit values."""
    apply_npi(spark, npi_history(table_root, names), spark.read.parquet(bronze_path), run_date)
