"""Hospital-shaped tables derived from the driver's TPC-H-like tables.

The reference's inputs (two hospitals' databases) are not available, so each
source entity is a Spark projection of a whole driver table. Every rule is
data-driven (no id subsets, no row caps); the same rules are written in SQL
in ``claimlake.plans.oracle`` so DuckDB can check every query.

| entity        | from       | source (`datasource`)                 |
| ------------- | ---------- | ------------------------------------- |
| transactions  | lineitem   | l_orderkey even -> hos-a, odd -> hos-b |
| encounters    | orders     | o_orderkey even -> hos-a, odd -> hos-b |
| patients      | customer   | nations below 13 -> hospital A shape, the rest -> hospital B shape |
| providers     | supplier   | every supplier in both hospitals; those with a negative balance name a department that does not exist |
| departments   | nation     | every nation in both hospitals |
| CPT / ICD     | part       | code = p_partkey, category = p_type, description = p_name |
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.sources.schemas import SILVER_DDL, schema

# Fixed run clock for reproducible checks (B13 / I6: one value per run).
BATCH_TS_1 = _dt.datetime(2024, 1, 1, 0, 0, 0)
BATCH_TS_2 = _dt.datetime(2024, 1, 2, 0, 0, 0)
REFRESHED_AT = _dt.datetime(2024, 1, 3, 0, 0, 0)
DAY1_CUTOFF = _dt.date(2000, 1, 1)
REPORT_YEAR = 1998


def ts_ntz(value: _dt.datetime) -> Column:
    """A time-zone-free timestamp literal (compares equal in any session zone)."""
    return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The DataFrame (file listing + footer schema) is made
    once per application and path; every query still scans the files afresh."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _parity_source(c: str) -> Column:
    return F.when(F.col(c) % 2 == 0, F.lit("hos-a")).otherwise(F.lit("hos-b"))


def bronze_transactions(spark: SparkSession, sf_dir: str, day: int = 2) -> DataFrame:
    """Transactions in the bronze shape, one per line item.

    Day 1 holds those shipped before 2000. On day 2 all are extracted; open
    accepted lines were settled (nothing paid, re-stamped), and closed lines
    of kind N lost their line of business, which NULL-unsafe change tests
    ignore. Open returns of line 7 have no id: quarantined NULL-key rows.
    First lines of kind N name a provider that does not exist. The id takes
    all columns that together are unique in ``lineitem``.
    """
    li = table(spark, sf_dir, "lineitem")
    if day == 1:
        li = li.filter(F.col("l_shipdate") < F.lit(DAY1_CUTOFF))
    ship = F.col("l_shipdate").cast("date")
    flag, open_line = F.col("l_returnflag"), F.col("l_linestatus") == "O"
    paid = F.when(flag == "R", F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    business, modified = F.col("l_linestatus"), ship
    if day == 2:
        settled = open_line & (flag == "A")
        paid = F.when(settled, F.lit(0.0)).otherwise(paid)
        modified = F.when(settled, F.lit(_dt.date(2002, 1, 1))).otherwise(modified)
        business = F.when(~open_line & (flag == "N"), F.lit(None).cast("string")).otherwise(business)
    number = F.concat_ws("-", *[F.col(c).cast("string") for c in
                                ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                         F.date_format(ship, "yyyyMMdd"))
    no_id = open_line & (flag == "R") & (F.col("l_linenumber") == 7)
    stray = (flag == "N") & (F.col("l_linenumber") == 1)
    supplier = F.col("l_suppkey").cast("string")
    return li.select(
        F.when(no_id, F.lit(None).cast("string")).otherwise(number).alias("TransactionID"),
        F.col("l_orderkey").cast("string").alias("EncounterID"),
        F.col("l_partkey").cast("string").alias("PatientID"),
        F.when(stray, F.concat(F.lit("X"), supplier)).otherwise(supplier).alias("ProviderID"),
        F.col("l_linenumber").cast("string").alias("DeptID"),
        ship.alias("VisitDate"),
        ship.alias("ServiceDate"),
        F.date_add(ship, 30).alias("PaidDate"),
        flag.alias("VisitType"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_linestatus").alias("AmountType"),
        paid.alias("PaidAmount"),
        F.col("l_orderkey").cast("string").alias("ClaimID"),
        supplier.alias("PayorID"),
        F.col("l_partkey").cast("int").alias("ProcedureCode"),
        F.col("l_partkey").cast("string").alias("ICDCode"),
        business.alias("LineOfBusiness"),
        F.lit(None).cast("string").alias("MedicaidID"),
        F.lit(None).cast("string").alias("MedicareID"),
        ship.alias("InsertDate"),
        modified.alias("ModifiedDate"),
        _parity_source("l_orderkey").alias("datasource"),
    )


def providers_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers of both hospitals (hospital prefix in the id, as in the
    sources). Every NPI is above 2^31 (I9)."""
    s = table(spark, sf_dir, "supplier")
    dept = F.when(F.col("s_acctbal") < 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey"))
    out = []
    for ds, prefix in (("hos-a", "H1-"), ("hos-b", "H2-")):
        out.append(s.select(
            F.concat(F.lit(prefix), F.col("s_suppkey").cast("string")).alias("ProviderID"),
            F.col("s_name").alias("FirstName"),
            F.col("s_nationkey").cast("string").alias("LastName"),
            F.lit("General").alias("Specialization"),
            dept.cast("string").alias("DeptID"),
            (F.col("s_suppkey") + F.lit(3_000_000_000)).cast("long").alias("NPI"),
            F.lit(ds).alias("datasource"),
        ))
    return out[0].unionByName(out[1])


def departments_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    out = [n.select(F.col("n_nationkey").cast("string").alias("DeptID"), F.col("n_name").alias("Name"),
                    F.lit(ds).alias("datasource")) for ds in ("hos-a", "hos-b")]
    return out[0].unionByName(out[1])


def encounters_bronze(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Encounters as extracted on day 1 (orders placed before 2000) or day 2
    (all orders; open orders escalated to urgent and re-stamped; some
    department ids lost, which NULL-unsafe change tests ignore). Orders with
    status P and priority 5-LOW have no id: quarantined NULL-key rows."""
    o = table(spark, sf_dir, "orders")
    if day == 1:
        o = o.filter(F.col("o_orderdate") < F.lit(DAY1_CUTOFF))
    enc_date = F.col("o_orderdate").cast("date")
    etype = F.col("o_orderpriority")
    modified = enc_date
    dept = F.col("o_orderstatus")
    if day == 2:
        escalated = F.col("o_orderstatus") == "O"
        etype = F.when(escalated, F.lit("1-URGENT")).otherwise(etype)
        modified = F.when(escalated, F.lit(_dt.date(2002, 1, 1))).otherwise(modified)
        dept = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "3-MEDIUM"),
                      F.lit(None).cast("string")).otherwise(dept)
    no_id = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return o.select(
        F.when(no_id, F.lit(None).cast("string")).otherwise(F.col("o_orderkey").cast("string")).alias("EncounterID"),
        F.col("o_custkey").cast("string").alias("PatientID"),
        enc_date.alias("EncounterDate"),
        etype.alias("EncounterType"),
        (F.col("o_custkey") % 100).cast("string").alias("ProviderID"),
        dept.alias("DepartmentID"),
        F.col("o_custkey").cast("int").alias("ProcedureCode"),
        enc_date.alias("InsertedDate"),
        modified.alias("ModifiedDate"),
        _parity_source("o_orderkey").alias("datasource"),
    )


def patients_bronze(spark: SparkSession, sf_dir: str, day: int = 2) -> tuple[DataFrame, DataFrame]:
    """Patients of hospital A (A's column names) and B (B's column names).

    Customers with a negative balance have no date of birth; market segment
    BUILDING stands for a first name typed as the text 'NULL'; FURNITURE
    customers of nation 7 have no id. Day 1 holds balances up to 8000. On day
    2 all are extracted, MACHINERY customers moved, and those of nation 3
    lost their phone number, which NULL-unsafe change tests ignore.
    """
    c = table(spark, sf_dir, "customer")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    first = F.when(segment == "BUILDING", F.lit("NULL")).otherwise(segment)
    dob = F.when(F.col("c_acctbal") < 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit(_dt.date(1950, 1, 1)), nation * 365))
    no_id = (segment == "FURNITURE") & (nation == 7)
    address = F.concat(F.lit("Street "), nation.cast("string"))
    phone, modified = F.lit("555-0100"), F.lit(_dt.date(2023, 12, 31))
    if day == 1:
        c = c.filter(F.col("c_acctbal") <= 8000)
    else:
        moved = segment == "MACHINERY"
        address = F.when(moved, F.concat(F.lit("Avenue "), nation.cast("string"))).otherwise(address)
        modified = F.when(moved, F.lit(_dt.date(2024, 1, 1))).otherwise(modified)
        phone = F.when(nation == 3, F.lit(None).cast("string")).otherwise(phone)
    common = [
        F.when(no_id, F.lit(None).cast("string")).otherwise(F.col("c_custkey").cast("string")), first,
        F.col("c_name"), nation.cast("string"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"),
        phone, F.lit("U"), dob, address, modified,
    ]
    a_names = ["PatientID", "FirstName", "LastName", "MiddleName", "SSN", "PhoneNumber", "Gender", "DOB",
               "Address", "ModifiedDate"]
    b_names = ["ID", "F_Name", "L_Name", "M_Name", "SSN", "PhoneNumber", "Gender", "DOB", "Address",
               "Updated_Date"]
    a = c.filter(F.col("c_nationkey") < 13).select(
        *[e.alias(n) for e, n in zip(common, a_names)], F.lit("hos-a").alias("datasource"))
    b = c.filter(F.col("c_nationkey") >= 13).select(
        *[e.alias(n) for e, n in zip(common, b_names)], F.lit("hos-b").alias("datasource"))
    return a, b


def codes_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code rows (ICD shape) from part: code, type, description, dates, flag."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("icd_code"),
        F.col("p_type").alias("icd_code_type"),
        F.col("p_name").alias("code_description"),
        F.lit(_dt.date(2024, 1, 1)).alias("inserted_date"),
        F.lit(_dt.date(2024, 1, 1)).alias("updated_date"),
        F.lit(True).alias("is_current_flag"),
    )


def ntz_schema(name: str):
    """Silver schema with zone-free audit timestamps, for zone-independent checks."""
    return schema(SILVER_DDL[name].replace("timestamp", "timestamp_ntz"))


def empty_silver(spark: SparkSession, name: str) -> DataFrame:
    from claimlake.sources.tables import empty_table

    return empty_table(spark, ntz_schema(name))


def cpt_bronze(spark: SparkSession, sf_dir: str, day: int = 2) -> DataFrame:
    """CPT rows from part. Day 1 holds parts up to size 48, all active. On day
    2 all are there, those above size 45 are retired, those of size 10 lost
    their description (quarantined), and those of size 11 their category."""
    p = table(spark, sf_dir, "part")
    size, none = F.col("p_size"), F.lit(None).cast("string")
    if day == 1:
        p = p.filter(size <= 48)
        category, description, status = F.col("p_type"), F.col("p_name"), F.lit("active")
    else:
        category = F.when(size == 11, none).otherwise(F.col("p_type"))
        description = F.when(size == 10, none).otherwise(F.col("p_name"))
        status = F.when(size > 45, F.lit("retired")).otherwise(F.lit("active"))
    return p.select(
        F.col("p_partkey").cast("string").alias("cpt_codes"),
        category.alias("procedure_code_category"),
        description.alias("procedure_code_descriptions"),
        status.alias("code_status"),
    )


def codes_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICD codes already in silver: parts up to size 45 (larger ones are new)."""
    return codes_bronze(spark, sf_dir).join(
        table(spark, sf_dir, "part").filter(F.col("p_size") <= 45)
        .select(F.col("p_partkey").cast("string").alias("icd_code")), "icd_code", "left_semi")


def codes_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICD bronze after two daily appends (S5): every code on day 1 (codes of
    type SMALL lost their number: NULL keys), and PROMO codes again on day 2
    with a revised description."""
    p = table(spark, sf_dir, "part")
    day1 = codes_bronze(spark, sf_dir)
    lost = F.col("icd_code_type") == "SMALL"
    day1 = day1.withColumn("icd_code", F.when(lost, F.lit(None).cast("string")).otherwise(F.col("icd_code")))
    day2 = p.filter(F.col("p_type") == "PROMO").select(
        F.col("p_partkey").cast("string").alias("icd_code"),
        F.col("p_type").alias("icd_code_type"),
        F.concat(F.col("p_name"), F.lit(" (revised)")).alias("code_description"),
        F.lit(_dt.date(2024, 1, 2)).alias("inserted_date"),
        F.lit(_dt.date(2024, 1, 2)).alias("updated_date"),
        F.lit(True).alias("is_current_flag"),
    )
    return day1.unionByName(day2)


def _npi_result(s: DataFrame, day: int = 1) -> Column:
    """One registry result per supplier: individuals (NPI-1) in nations below
    12, organisations otherwise; absent fields are left out of the JSON.
    On day 2, suppliers above 8000 were updated, and organisations below a
    1000 balance no longer report their organisation name."""
    individual = F.col("s_nationkey") < 12
    nk = F.col("s_nationkey").cast("string")
    none = F.lit(None).cast("string")
    basic = F.struct(
        F.when(individual, F.col("s_name")).otherwise(none).alias("first_name"),
        F.when(individual, nk).otherwise(none).alias("last_name"),
        F.when(~individual, F.col("s_name")).otherwise(none).alias("authorized_official_first_name"),
        F.when(~individual, nk).otherwise(none).alias("authorized_official_last_name"),
        F.when(~individual & (F.col("s_acctbal") > 5000), F.lit("Director")).otherwise(none)
        .alias("authorized_official_title_or_position"),
        F.when(~individual & ((F.lit(day) == 1) | (F.col("s_acctbal") >= 1000)), F.concat(F.lit("Org "), nk))
        .otherwise(none).alias("organization_name"),
        (F.when(F.col("s_acctbal") > 8000, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")) if day == 2
         else F.lit("2024-01-01")).alias("last_updated"),
    )
    return F.struct(
        F.col("s_suppkey").cast("string").alias("number"),
        F.when(individual, F.lit("NPI-1")).otherwise(F.lit("NPI-2")).alias("enumeration_type"),
        basic.alias("basic"),
    )


def npi_detail_docs(spark: SparkSession, sf_dir: str, day: int = 1, unknown: bool = False) -> DataFrame:
    """One detail answer per supplier number; with ``unknown``, suppliers with a
    negative balance answer with an empty ``results`` list (J1)."""
    s = table(spark, sf_dir, "supplier")
    found = F.col("s_acctbal") >= 0 if unknown else F.lit(True)
    results = F.when(found, F.array(_npi_result(s, day))).otherwise(
        F.array().cast("array<struct<number:string,enumeration_type:string,basic:struct<"
                       "first_name:string,last_name:string,authorized_official_first_name:string,"
                       "authorized_official_last_name:string,authorized_official_title_or_position:string,"
                       "organization_name:string,last_updated:string>>>"))
    return s.select(F.col("s_suppkey").cast("string").alias("number"),
                    F.to_json(F.struct(results.alias("results"))).alias("body"))


def npi_list_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List answers over all suppliers, 20 numbers per page like the registry's
    page size: pages group by ``s_suppkey div 20``, so no page -- and no task
    -- ever holds more than 20 numbers. A second listing repeats those with a
    balance above 9000."""
    s = table(spark, sf_dir, "supplier")
    number = F.struct(F.col("s_suppkey").cast("string").alias("number"))

    def pages(rows: DataFrame, listing: str) -> DataFrame:
        return rows.groupBy(F.lit(listing).alias("listing"), F.floor(F.col("s_suppkey") / 20).alias("page")).agg(
            F.collect_list(number).alias("results"))

    both = pages(s, "all").unionByName(pages(s.filter(F.col("s_acctbal") > 9000), "featured"))
    return both.select("listing", "page", F.to_json(F.struct("results")).alias("body"))


def hierarchy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, roots) of a region -> nation -> supplier code tree.

    Suppliers are leaves (code ``S<key>``, title = name); those with a
    negative balance have no code and are not emitted. Suppliers with a
    balance above 9000 are also linked straight from their region, so they
    are reached twice.
    """
    r, n, s = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))

    def title(c: str) -> Column:
        return F.struct(F.col(c).alias("@value"))

    def url(kind: str, c: str) -> Column:
        return F.concat(F.lit(kind + "/"), F.col(c).cast("string"))

    nodes = (
        r.select(url("region", "r_regionkey").alias("url"), F.lit(True).alias("has_child"),
                 F.lit(None).cast("string").alias("code"), title("r_name").alias("title"))
        .unionByName(n.select(url("nation", "n_nationkey").alias("url"), F.lit(True).alias("has_child"),
                              F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
                              title("n_name").alias("title")))
        .unionByName(s.select(url("supplier", "s_suppkey").alias("url"), F.lit(False).alias("has_child"),
                              F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
                              .otherwise(F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).alias("code"),
                              title("s_name").alias("title")))
    )
    featured = s.filter(F.col("s_acctbal") > 9000).join(n, s["s_nationkey"] == n["n_nationkey"])
    edges = (
        n.select(url("region", "n_regionkey").alias("url"), url("nation", "n_nationkey").alias("child_url"))
        .unionByName(s.select(url("nation", "s_nationkey").alias("url"),
                              url("supplier", "s_suppkey").alias("child_url")))
        .unionByName(featured.select(url("region", "n_regionkey").alias("url"),
                                     url("supplier", "s_suppkey").alias("child_url")))
    )
    roots = r.select(url("region", "r_regionkey").alias("url"))
    return nodes, edges, roots
