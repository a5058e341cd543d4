"""End-to-end jobs (P1-P19): operators composed, still pure DataFrame -> DataFrame.

Writing is the caller's step (``claimlake.sources.tables``), so each job can
be checked, explained, or staged before it replaces a table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.operators.conform import conform, union_sources, with_source_key
from claimlake.operators.history import NPI_AUDIT, PATIENT_AUDIT, TX_AUDIT, scd2_apply, upsert_flagged
from claimlake.operators.quality import REQUIRED, SENTINELS, flag_quarantine, latest_per_key
from claimlake.sources.schemas import SCD2_KEYS

# Fixed values that must equal the reference's: the common patient model and
# how each hospital's patient columns map onto it.
PATIENT_MODEL_A = {
    "SRC_PatientID": "PatientID", "FirstName": "FirstName", "LastName": "LastName",
    "MiddleName": "MiddleName", "SSN": "SSN", "PhoneNumber": "PhoneNumber", "Gender": "Gender",
    "DOB": "DOB", "Address": "Address", "ModifiedDate": "ModifiedDate", "datasource": "datasource",
}
PATIENT_MODEL_B = {
    "SRC_PatientID": "ID", "FirstName": "F_Name", "LastName": "L_Name",
    "MiddleName": "M_Name", "SSN": "SSN", "PhoneNumber": "PhoneNumber", "Gender": "Gender",
    "DOB": "DOB", "Address": "Address", "ModifiedDate": "Updated_Date", "datasource": "datasource",
}


def transactions_quality(bronze_tx: DataFrame) -> DataFrame:
    """P1 (view part): flag (B6), key ``TransactionID-datasource`` (B5), rename source dates."""
    flagged = flag_quarantine(bronze_tx, REQUIRED["transactions"])
    keyed = with_source_key(flagged, "TransactionID")
    return keyed.withColumnsRenamed({"InsertDate": "SRC_InsertDate", "ModifiedDate": "SRC_ModifiedDate"})


def encounters_quality(bronze_enc: DataFrame) -> DataFrame:
    """P2 (view part): flag, key ``EncounterID-datasource``, rename source dates."""
    flagged = flag_quarantine(bronze_enc, REQUIRED["encounters"])
    keyed = with_source_key(flagged, "EncounterID")
    return keyed.withColumnsRenamed({"InsertedDate": "SRC_InsertedDate",
                                     "ModifiedDate": "SRC_ModifiedDate"})


def patients_quality(bronze_a: DataFrame, bronze_b: DataFrame) -> DataFrame:
    """P3 (view part): conform both hospitals (B3), union (H3), key first (B4/B5), flag."""
    cdm = union_sources(conform(bronze_a, PATIENT_MODEL_A), conform(bronze_b, PATIENT_MODEL_B))
    keyed = cdm.select(F.concat(F.col("SRC_PatientID"), F.lit("-"), F.col("datasource")).alias("Patient_Key"),
                       "*")
    flagged = flag_quarantine(keyed, REQUIRED["patients"], SENTINELS["patients"])
    return flagged.withColumnRenamed("ModifiedDate", "SRC_ModifiedDate")


def providers_silver(*bronze: DataFrame) -> DataFrame:
    """Union (H1), distinct rows (E6) with the flag; NPI kept as ``long``."""
    merged = union_sources(*bronze)
    return merged.select(
        "ProviderID", "FirstName", "LastName", "Specialization", "DeptID",
        F.col("NPI").cast("long").alias("NPI"), "datasource",
        F.when(F.col("ProviderID").isNull() | F.col("DeptID").isNull(), F.lit(True))
        .otherwise(F.lit(False)).alias("is_quarantined"),
    ).distinct()


def departments_silver(*bronze: DataFrame) -> DataFrame:
    """P5 [inferred builder]: union, key ``DeptID-datasource``, flag; full reload."""
    merged = union_sources(*bronze)
    flagged = flag_quarantine(merged, REQUIRED["departments"])
    return flagged.select(
        F.concat(F.col("DeptID"), F.lit("-"), F.col("datasource")).alias("Dept_Id"),
        F.col("DeptID").alias("SRC_Dept_Id"), "Name", "datasource", "is_quarantined")


def cpt_quality(bronze_cpt: DataFrame) -> DataFrame:
    """P6 [inferred builder]: flag CPT rows before their SCD2 apply."""
    return flag_quarantine(bronze_cpt, REQUIRED["cptcodes"])


def apply_batch(target: DataFrame, quality: DataFrame, entity: str,
                ts: _dt.datetime | _dt.date | Column, null_safe: bool = False) -> DataFrame:
    """P1/P2/P3/P6 write step: SCD2-apply one quality-checked batch."""
    audit = PATIENT_AUDIT if entity == "patients" else TX_AUDIT
    return scd2_apply(target, quality, SCD2_KEYS[entity], ts=ts, audit=audit, null_safe=null_safe)


def icd_silver(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Registry codes appended daily (S5) -> newest row per code -> D4 upsert."""
    newest = latest_per_key(staged, "icd_code", ["updated_date", "inserted_date"])
    return upsert_flagged(target, newest, "icd_code", tracked=("code_description",),
                          updates={"code_description": "code_description", "updated_date": "updated_date"})


#: The descriptive fields whose change makes a new version.
NPI_TRACKED = ["first_name", "last_name", "position", "organisation_name", "last_updated"]


def npi_batch(bronze_npi: DataFrame) -> DataFrame:
    """P8 (view part): the registry extract without its refresh date."""
    return bronze_npi.select("npi_id", *NPI_TRACKED)


def npi_silver(target: DataFrame, bronze_npi: DataFrame, run_date: _dt.date | Column) -> DataFrame:
    """NPI extract -> SCD2 with dates (``current_date``) as audit values."""
    return scd2_apply(target, npi_batch(bronze_npi), "npi_id", tracked=NPI_TRACKED, ts=run_date, audit=NPI_AUDIT)
