"""Declared table shapes.

Fixed values that must equal the reference's: the column names, order and
types of its bronze, silver, gold and audit tables. Positional inserts
(A12) depend on the order, so it is kept exactly. Two silver builders are
missing from the reference (departments, CPT codes); their shapes are the
ones their gold readers need, plus the SCD2 audit columns for CPT codes.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: bronze (source systems, plus `datasource` stamped at load)
BRONZE_DDL = {
    "departments": "DeptID string, Name string, datasource string",
    "providers": "ProviderID string, FirstName string, LastName string, Specialization string, "
                 "DeptID string, NPI long, datasource string",
    "patients_a": "PatientID string, FirstName string, LastName string, MiddleName string, SSN string, "
                  "PhoneNumber string, Gender string, DOB date, Address string, ModifiedDate date, "
                  "datasource string",
    "patients_b": "ID string, F_Name string, L_Name string, M_Name string, SSN string, "
                  "PhoneNumber string, Gender string, DOB date, Address string, Updated_Date date, "
                  "datasource string",
    "encounters": "EncounterID string, PatientID string, EncounterDate date, EncounterType string, "
                  "ProviderID string, DepartmentID string, ProcedureCode int, InsertedDate date, "
                  "ModifiedDate date, datasource string",
    "transactions": "TransactionID string, EncounterID string, PatientID string, ProviderID string, "
                    "DeptID string, VisitDate date, ServiceDate date, PaidDate date, VisitType string, "
                    "Amount double, AmountType string, PaidAmount double, ClaimID string, PayorID string, "
                    "ProcedureCode int, ICDCode string, LineOfBusiness string, MedicaidID string, "
                    "MedicareID string, InsertDate date, ModifiedDate date, datasource string",
    "cptcodes": "cpt_codes string, procedure_code_category string, procedure_code_descriptions string, "
                "code_status string",
    "icd_codes": "icd_code string, icd_code_type string, code_description string, inserted_date date, "
                 "updated_date date, is_current_flag boolean",
    "npi_extract": "npi_id string, first_name string, last_name string, position string, "
                   "organisation_name string, last_updated string, refreshed_at date",
}

# ---- fixed values: silver
SILVER_DDL = {
    "transactions": "TransactionID string, SRC_TransactionID string, EncounterID string, PatientID string, "
                    "ProviderID string, DeptID string, VisitDate date, ServiceDate date, PaidDate date, "
                    "VisitType string, Amount double, AmountType string, PaidAmount double, ClaimID string, "
                    "PayorID string, ProcedureCode int, ICDCode string, LineOfBusiness string, "
                    "MedicaidID string, MedicareID string, SRC_InsertDate date, SRC_ModifiedDate date, "
                    "datasource string, is_quarantined boolean, audit_insertdate timestamp, "
                    "audit_modifieddate timestamp, is_current boolean",
    "encounters": "EncounterID string, SRC_EncounterID string, PatientID string, EncounterDate date, "
                  "EncounterType string, ProviderID string, DepartmentID string, ProcedureCode int, "
                  "SRC_InsertedDate date, SRC_ModifiedDate date, datasource string, is_quarantined boolean, "
                  "audit_insertdate timestamp, audit_modifieddate timestamp, is_current boolean",
    "patients": "Patient_Key string, SRC_PatientID string, FirstName string, LastName string, "
                "MiddleName string, SSN string, PhoneNumber string, Gender string, DOB date, Address string, "
                "SRC_ModifiedDate timestamp, datasource string, is_quarantined boolean, "
                "inserted_date timestamp, modified_date timestamp, is_current boolean",
    "providers": "ProviderID string, FirstName string, LastName string, Specialization string, "
                 "DeptID string, NPI long, datasource string, is_quarantined boolean",
    "icd_codes": "icd_code string, icd_code_type string, code_description string, inserted_date date, "
                 "updated_date date, is_current_flag boolean",
    "npi_extract": "npi_id string, first_name string, last_name string, position string, "
                   "organisation_name string, last_updated string, inserted_date date, updated_date date, "
                   "is_current_flag boolean",
    "departments": "Dept_Id string, SRC_Dept_Id string, Name string, datasource string, is_quarantined boolean",
    "cptcodes": "cpt_codes string, procedure_code_category string, procedure_code_descriptions string, "
                "code_status string, is_quarantined boolean, audit_insertdate timestamp, "
                "audit_modifieddate timestamp, is_current boolean",
}

# ---- fixed values: gold
GOLD_DDL = {
    "fact_transactions": "TransactionID string, SRC_TransactionID string, EncounterID string, "
                         "FK_PatientID string, FK_ProviderID string, FK_DeptID string, ICDCode string, "
                         "ProcedureCode string, VisitType string, ServiceDate date, PaidDate date, "
                         "Amount double, PaidAmount double, AmountType string, ClaimID string, "
                         "datasource string, refreshed_at timestamp",
    "dim_patient": "patient_key string, src_patientid string, firstname string, lastname string, "
                   "middlename string, ssn string, phonenumber string, gender string, dob date, "
                   "address string, datasource string",
    "dim_provider": "ProviderID string, FirstName string, LastName string, DeptID string, NPI long, "
                    "datasource string",
    "dim_department": "Dept_Id string, SRC_Dept_Id string, Name string, datasource string",
    "dim_cpt_code": "cpt_codes string, procedure_code_category string, procedure_code_descriptions string, "
                    "code_status string, refreshed_at timestamp",
    "dim_icd": "icd_code string, icd_code_type string, code_description string, refreshed_at timestamp",
    "dim_npi": "npi_id string, first_name string, last_name string, position string, "
               "organisation_name string, last_updated string, refreshed_at timestamp",
}

# ---- fixed values: control tables
CONTROL_DDL = {
    # numberofrowscopied is INT in the reference; bigint here, since one
    # load of a large table passes 2^31 rows. watermarkvalue is ours: the
    # largest watermark that was written, the next incremental bound.
    "load_logs": "data_source string, tablename string, numberofrowscopied bigint, "
                 "watermarkcolumnname string, loaddate timestamp, watermarkvalue string",
    "load_config": "database string, datasource string, tablename string, loadtype string, "
                   "watermark string, is_active int, targetpath string",
    "file_map": "Container string, FilePath string, FileName string, DatabaseName string, TableName string",
}

# The key of each SCD2 silver table. Tracked (change-detecting)
# are all other business columns.
SCD2_KEYS = {
    "transactions": "TransactionID",
    "encounters": "EncounterID",
    "patients": "Patient_Key",
    "npi_extract": "npi_id",
    "cptcodes": "cpt_codes",
}


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def silver(name: str) -> T.StructType:
    return schema(SILVER_DDL[name])


def gold(name: str) -> T.StructType:
    return schema(GOLD_DDL[name])


def bronze(name: str) -> T.StructType:
    return schema(BRONZE_DDL[name])


def control(name: str) -> T.StructType:
    return schema(CONTROL_DDL[name])
