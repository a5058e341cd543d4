"""Config-driven bronze loads.

The load config and the file map are a handful of metadata rows (one per
source table), so they are read on the driver to decide *which* Spark jobs
to run; the data itself never passes through the driver. Extracts take any
DataFrame (a parquet landing folder, a JDBC read, ...).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.conform import conform_to
from claimlake.sources.schemas import control
from claimlake.sources.tables import ensure_table, write_bronze

# Fixed values that must equal the reference's load config (10 rows).
LOAD_CONFIG_ROWS = [
    ("rcmhospital_a", "hos-a", "dbo.encounters", "Incremental", "ModifiedDate", 0, "hosa"),
    ("rcmhospital_a", "hos-a", "dbo.patients", "Incremental", "ModifiedDate", 0, "hosa"),
    ("rcmhospital_a", "hos-a", "dbo.transactions", "Incremental", "ModifiedDate", 0, "hosa"),
    ("rcmhospital_a", "hos-a", "dbo.providers", "Full", None, 0, "hosa"),
    ("rcmhospital_a", "hos-a", "dbo.departments", "Full", None, 0, "hosa"),
    ("rcmhospital_b", "hos-b", "dbo.encounters", "Incremental", "ModifiedDate", 0, "hosb"),
    ("rcmhospital_b", "hos-b", "dbo.patients", "Incremental", "Updated_Date", 1, "hosb"),
    ("rcmhospital_b", "hos-b", "dbo.transactions", "Incremental", "ModifiedDate", 0, "hosb"),
    ("rcmhospital_b", "hos-b", "dbo.providers", "Full", None, 0, "hosb"),
    ("rcmhospital_b", "hos-b", "dbo.departments", "Full", None, 0, "hosb"),
]


def load_config(spark: SparkSession, rows: Iterable[tuple] | None = None) -> DataFrame:
    """The load config as a DataFrame (the reference's rows by default)."""
    return spark.createDataFrame(list(rows or LOAD_CONFIG_ROWS), control("load_config"))


def read_load_config(spark: SparkSession, path: str) -> DataFrame:
    """Read a load-config CSV (header, declared schema, no inference)."""
    return spark.read.csv(path, header=True, schema=control("load_config"))


def plan_loads(config: DataFrame) -> DataFrame:
    """The loads to run -- active rows only, with a normalised load mode."""
    return config.filter(F.col("is_active") == F.lit(1)).select(
        "database", "datasource", "tablename",
        F.when(F.lower(F.col("loadtype")) == "incremental", F.lit("incremental"))
        .otherwise(F.lit("full")).alias("mode"),
        F.nullif(F.col("watermark"), F.lit("")).alias("watermark"),
        "targetpath",
    )


#: Where the CSV reader leaves the text of a line that does not fit the declared columns.
REJECT = "__rejected"


def checked_csv(spark: SparkSession, path: str, schema: T.StructType, malformed: str = "fail") -> DataFrame:
    """A headered CSV bound to ``schema`` by the names in its header.

    Columns may come in any order and in any case of letters; further columns
    are read and dropped, a declared one that the header lacks raises. Every
    file of a folder must have the same header (the reader compares them). A
    line that does not fit (too few or too many fields, a value that is not of
    its column's type) fails the job, or with ``malformed="reject"`` comes as
    a row without values whose ``__rejected`` is the line.
    """
    if malformed not in ("fail", "reject"):
        raise ValueError(f"unknown malformed {malformed!r}")
    declared = {f.name.strip().lower(): f for f in schema.fields}
    header = spark.read.csv(path, header=True).columns  # the first line of one file
    names = [c.strip().lower() for c in header]
    missing = [f.name for n, f in declared.items() if n not in names]
    if missing or len(set(names)) < len(names):
        raise ValueError(f"header {header} of {path} lacks {missing}" if missing else f"header {header} of {path} repeats a name")
    bound = T.StructType([T.StructField(c, declared[n].dataType if n in declared else T.StringType()) for c, n in zip(header, names)])
    by_name = dict(zip(names, header))
    options = {"header": True, "enforceSchema": False}
    if malformed == "fail":
        rows = spark.read.csv(path, schema=bound, mode="FAILFAST", **options)
    else:
        rows = spark.read.csv(path, schema=bound.add(REJECT, T.StringType()), columnNameOfCorruptRecord=REJECT, **options)
    fits = F.lit(True) if malformed == "fail" else F.col(REJECT).isNull()
    cols = [F.when(fits, F.col(f"`{by_name[n]}`")).alias(f.name) for n, f in declared.items()]
    return rows.select(*cols, *([] if malformed == "fail" else [REJECT]))


def mapped_files(mapping: Iterable[Mapping[str, str]], root: str,
                 schemas: Mapping[str, T.StructType]) -> dict[str, tuple[str, T.StructType]]:
    """The path and declared schema of each mapped file, by ``DatabaseName.TableName``."""
    by_name = {k.lower(): v for k, v in schemas.items()}
    out: dict[str, tuple[str, T.StructType]] = {}
    for m in mapping:
        schema = by_name.get(m["TableName"].lower())
        if schema is None:
            raise KeyError(f"no schema declared for {m['TableName']}")
        out[f"{m['DatabaseName']}.{m['TableName']}"] = (f"{root.rstrip('/')}/{m['Container']}/{m['FilePath']}/{m['FileName']}", schema)
    return out


def load_mapped_files(spark: SparkSession, mapping: Iterable[Mapping[str, str]], root: str,
                      schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """Read each mapped headered CSV with its declared schema.

    ``mapping`` rows carry ``Container, FilePath, FileName, DatabaseName,
    TableName``; the file is ``{root}/{Container}/{FilePath}/{FileName}``
    and the result is keyed ``DatabaseName.TableName``. ``schemas`` is
    keyed by ``TableName`` (case-insensitive); no schema inference. Columns
    are bound by header name, and a malformed line fails (``checked_csv``);
    ``land_mapped_files`` sets such lines aside.
    """
    return {name: checked_csv(spark, path, schema) for name, (path, schema) in mapped_files(mapping, root, schemas).items()}


@dataclass
class Landed:
    """One mapped file as landed: its ``rows``, the lines set aside (``line``), and how many of each."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def land_mapped_files(spark: SparkSession, mapping: Iterable[Mapping[str, str]], root: str, schemas: Mapping[str, T.StructType],
                      target: str) -> dict[str, Landed]:
    """A15 with rejected lines as an output: each file is parsed once and written below
    ``target/<table>``, rows and rejected lines apart; both are counted as they are written."""
    out: dict[str, Landed] = {}
    for name, (path, schema) in mapped_files(mapping, root, schemas).items():
        seen, folder, bad = Observation(), f"{target.rstrip('/')}/{name}", F.col(REJECT).isNotNull()
        parsed = checked_csv(spark, path, schema, malformed="reject").withColumn("__bad", bad)
        parsed = parsed.observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejects"))
        parsed.write.partitionBy("__bad").parquet(folder)
        landed = spark.read.schema(parsed.schema).parquet(folder)
        out[name] = Landed(landed.filter("NOT __bad").select(*[f"`{f.name}`" for f in schema.fields]),
                           landed.filter("__bad").select(F.col(REJECT).alias("line")), seen.get["rows"], seen.get["rejects"])
    return out


def extract_full(src: DataFrame, datasource: str) -> DataFrame:
    """The whole source, stamped with its ``datasource``."""
    return src.withColumn("datasource", F.lit(datasource))


def extract_incremental(src: DataFrame, watermark: str, last: _dt.date | _dt.datetime | Column | None,
                        datasource: str) -> DataFrame:
    """Rows with ``watermark >= last`` (all rows on a first load, ``last`` NULL).

    ``>=`` re-reads the boundary instant; the SCD2 apply ignores unchanged
    rows, so nothing is duplicated. The comparison is on the raw column, so
    it reaches the parquet scan (or the JDBC query).
    """
    out = src
    if last is not None:
        bound = last if isinstance(last, Column) else F.lit(last)
        out = src.filter(F.col(watermark) >= bound)
    return extract_full(out, datasource)


def latest_watermark(log: DataFrame) -> DataFrame:
    """Last load time per source and table."""
    return log.groupBy("data_source", "tablename").agg(F.max("loaddate").alias("last_loaddate"))


def high_water(log: DataFrame) -> DataFrame:
    """The last recorded watermark value per source and table: the next
    incremental bound. (A load that found no rows records none.)"""
    return log.filter(F.col("watermarkvalue").isNotNull()).groupBy("data_source", "tablename").agg(
        F.max_by("watermarkvalue", "loaddate").alias("watermarkvalue"))


@dataclass
class LoadRun:
    """What one run wrote: the folder of each table, and its log rows."""

    paths: dict[tuple[str, str], str]
    log: DataFrame


def run_loads(spark: SparkSession, config: DataFrame, sources: Mapping[tuple[str, str], DataFrame],
              root: str, log_table: str, loaddate: _dt.datetime | Column) -> LoadRun:
    """Extract each active config row, write it to its target path and log it.

    ``sources`` maps ``(datasource, tablename)`` to the source DataFrame.
    Full loads overwrite ``{root}/{targetpath}/{table}``, incremental ones
    append the rows at or above the largest watermark value that an earlier
    load wrote (A18). That is a value of the column itself, so the clocks of
    source and loader need not agree. The logged count and value are observed
    on the rows as they are written, without a second read. The log table is
    created if absent, and appended to after all tables were written.
    """
    ensure_table(spark, log_table, control("load_logs"))
    bounds = {(r["data_source"], r["tablename"]): r["watermarkvalue"]
              for r in high_water(spark.table(log_table)).collect()}  # a row per configured table
    paths: dict[tuple[str, str], str] = {}
    logged: list[tuple] = []
    for p in plan_loads(config).collect():  # a few metadata rows, never data
        k = (p["datasource"], p["tablename"])
        if k not in sources:
            raise KeyError(f"no source for {k}")
        src, mark = sources[k], p["watermark"]
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        if mark:
            metrics.append(F.max(F.col(mark)).cast("string").alias("high"))
        incremental = p["mode"] == "incremental" and bool(mark)
        if incremental:
            bound = F.lit(bounds[k]).cast(src.schema[mark].dataType) if k in bounds else None
            extract = extract_incremental(src, mark, bound, p["datasource"])
        else:
            extract = extract_full(src, p["datasource"])
        paths[k] = f"{root.rstrip('/')}/{p['targetpath']}/{p['tablename'].rpartition('.')[2]}"
        write_bronze(extract.observe(seen, *metrics), paths[k], "append" if incremental else "overwrite")
        logged.append((*k, seen.get["rows"], mark, seen.get.get("high")))
    shape = T.StructType.fromDDL("data_source string, tablename string, numberofrowscopied bigint, "
                                 "watermarkcolumnname string, watermarkvalue string")
    ts = loaddate if isinstance(loaddate, Column) else F.lit(loaddate)
    log = conform_to(spark.createDataFrame(logged, shape).withColumn("loaddate", ts),
                     spark.table(log_table).schema, by="name")
    log.write.insertInto(log_table)
    return LoadRun(paths, log)
