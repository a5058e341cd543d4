"""Gold star schema: publishable rows, fact and dimensions (B8, B11, B13, D6, E6,
P11-P17). Every builder is a narrow projection of one silver table (no
shuffle) except the two that ask for DISTINCT."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.keys import prefixed_key, surrogate_key
from claimlake.functions.predicates import is_publishable


def _lit_ts(value: _dt.datetime | Column) -> Column:
    """The refresh time: a Column keeps the caller's type (e.g. a zone-free
    ``timestamp_ntz``); a ``datetime`` becomes a ``timestamp`` literal."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def publishable(df: DataFrame, current: bool = True, clean: bool = True,
                current_col: str = "is_current", clean_col: str = "is_quarantined") -> DataFrame:
    """Keep ``is_current = true`` and/or ``is_quarantined = false`` rows.

    Both are plain column predicates, so they reach the parquet scan.
    """
    return df.filter(is_publishable(current_col if current else None, clean_col if clean else None))


def fact_transactions(silver_tx: DataFrame, refreshed_at: _dt.datetime | Column) -> DataFrame:
    """Gold fact from current, clean silver transactions.

    ``FK_ProviderID`` carries the hospital prefix (B11, S9); the encounter id
    stays raw (S10); ``ProcedureCode`` becomes text (I10).
    """
    t = publishable(silver_tx)
    return t.select(
        "TransactionID", "SRC_TransactionID", "EncounterID",
        surrogate_key("PatientID", "datasource").alias("FK_PatientID"),
        prefixed_key("ProviderID", "datasource").alias("FK_ProviderID"),
        surrogate_key("DeptID", "datasource").alias("FK_DeptID"),
        "ICDCode",
        F.col("ProcedureCode").cast("string").alias("ProcedureCode"),
        "VisitType", "ServiceDate", "PaidDate", "Amount", "PaidAmount", "AmountType", "ClaimID",
        "datasource",
        _lit_ts(refreshed_at).alias("refreshed_at"),
    )


def dim_patient(silver_patients: DataFrame) -> DataFrame:
    """Current, clean patients; lower-case column names of the gold table."""
    p = publishable(silver_patients)
    cols = ["Patient_Key", "SRC_PatientID", "FirstName", "LastName", "MiddleName", "SSN",
            "PhoneNumber", "Gender", "DOB", "Address", "datasource"]
    return p.select(*[F.col(c).alias(c.lower()) for c in cols])


def dim_provider(silver_providers: DataFrame) -> DataFrame:
    """Clean providers; ``DeptID`` becomes the department key ``DeptID-datasource``."""
    p = publishable(silver_providers, current=False)
    return p.select("ProviderID", "FirstName", "LastName",
                    surrogate_key("DeptID", "datasource").alias("DeptID"), "NPI", "datasource")


def dim_department(silver_departments: DataFrame) -> DataFrame:
    """Distinct clean departments."""
    d = publishable(silver_departments, current=False)
    return d.select("Dept_Id", "SRC_Dept_Id", "Name", "datasource").distinct()


def dim_cpt_code(silver_cpt: DataFrame, refreshed_at: _dt.datetime | Column) -> DataFrame:
    """Current, clean CPT codes stamped with the refresh time."""
    c = publishable(silver_cpt)
    return c.select("cpt_codes", "procedure_code_category", "procedure_code_descriptions",
                    "code_status", _lit_ts(refreshed_at).alias("refreshed_at"))


def dim_icd(silver_icd: DataFrame, refreshed_at: _dt.datetime | Column) -> DataFrame:
    """Distinct current ICD codes. The reference only selects them and
    never inserts (S4); this returns the selection for loading."""
    c = silver_icd.filter(F.col("is_current_flag") == F.lit(True))
    return (c.select("icd_code", "icd_code_type", "code_description").distinct()
            .withColumn("refreshed_at", _lit_ts(refreshed_at)))


def dim_npi(silver_npi: DataFrame, refreshed_at: _dt.datetime | Column) -> DataFrame:
    """Current NPI rows stamped with the refresh time."""
    n = silver_npi.filter(F.col("is_current_flag") == F.lit(True))
    return n.select("npi_id", "first_name", "last_name", "position", "organisation_name",
                    "last_updated", _lit_ts(refreshed_at).alias("refreshed_at"))
