"""Loads that later steps can rely on (A18, A19, P19): staged, then published by one append.

``run_loads`` of ``claimlake.sources.ingest`` writes into the folders that
readers scan, and logs afterwards. Here every extract of a run goes to a
folder of its own first; the run is published by appending its log rows, all
in one file, to the runs table. Readers take published folders only, so a run
that failed half-way has loaded nothing, and its repetition loads each row
once. Runs are numbered from 1; a consumer keeps the number of the last run
that it applied and asks for those after it (``loads_between``).

One loader at a time writes to a runs table. Folders of failed runs, and full
loads that later ones replaced, are left to the caller's retention job.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from claimlake.sources.ingest import extract_full, plan_loads
from claimlake.sources.schemas import schema
from claimlake.sources.tables import ensure_table

#: One row per table and run. The columns of the load log (A19), the run, and where its rows are.
RUNS_DDL = ("run bigint, mode string, path string, data_source string, tablename string, numberofrowscopied bigint, "
            "watermarkcolumnname string, loaddate timestamp, watermarkvalue string")
LOG_COLUMNS = ("data_source", "tablename", "numberofrowscopied", "watermarkcolumnname", "loaddate", "watermarkvalue")


def load_log(spark: SparkSession, runs_table: str) -> DataFrame:
    """The load log, from the published runs."""
    return spark.table(runs_table).select(*LOG_COLUMNS)


def last_run(spark: SparkSession, runs_table: str) -> int:
    """The number of the last published run (0 if none)."""
    return spark.table(runs_table).agg(F.max("run")).first()[0] or 0


def _reached(spark: SparkSession, runs_table: str) -> dict[tuple[str, str], tuple[str, list[str]]]:
    """Per source table: the last recorded watermark value, and the folders of the loads that reached it."""
    runs = spark.table(runs_table).filter(F.col("watermarkvalue").isNotNull())
    key = ["data_source", "tablename"]
    high = runs.groupBy(*key).agg(F.max_by("watermarkvalue", "run").alias("watermarkvalue"))
    out: dict[tuple[str, str], tuple[str, list[str]]] = {}
    for r in runs.join(high, [*key, "watermarkvalue"]).orderBy("run").collect():  # metadata: loads at the border
        out.setdefault((r["data_source"], r["tablename"]), (r["watermarkvalue"], []))[1].append(r["path"])
    return out


def extract_beyond(src: DataFrame, watermark: str, last: Column, loaded: DataFrame) -> DataFrame:
    """A18 with an exact border: rows after ``last``, and those at ``last`` that are not ``loaded`` yet.

    The original's ``>=`` reads the rows at the border again, and ``>`` would
    lose those stamped later with the same value. Here rows at the border are
    compared whole with the loaded ones, as multisets (``EXCEPT ALL``): a row
    that the source holds twice is loaded twice, and a row changed within the
    border value is loaded as changed. Only rows at the border are shuffled;
    both filters reach the scans.
    """
    at = F.col(watermark) == last
    return src.filter(F.col(watermark) > last).unionByName(src.filter(at).exceptAll(loaded.filter(at).select(*src.columns)))


def publish_loads(spark: SparkSession, config: DataFrame, sources: Mapping[tuple[str, str], DataFrame], root: str,
                  runs_table: str, loaddate: _dt.datetime | Column, threads: int = 4) -> int:
    """Extract every active config row into folders of this run, then publish the run. Returns its number.

    Full loads are taken whole; incremental ones hold the rows beyond the last
    published watermark (``extract_beyond``), or all on a first load. Counts
    and the largest watermark are observed on the rows as they are written.
    The extracts are independent jobs, ``threads`` of them at a time. If one
    fails the run is not published, and the error is raised.
    """
    ensure_table(spark, runs_table, schema(RUNS_DDL))
    plan = plan_loads(config).collect()  # a few metadata rows, never data
    unknown = [(p["datasource"], p["tablename"]) for p in plan if (p["datasource"], p["tablename"]) not in sources]
    if unknown:
        raise KeyError(f"no source for {unknown}")
    run, reached = last_run(spark, runs_table) + 1, _reached(spark, runs_table)
    attempt = f"run={run:08d}-{uuid.uuid4().hex[:8]}"

    def stage(p: Row) -> tuple:
        k, mark = (p["datasource"], p["tablename"]), p["watermark"]
        src, mode = sources[k], p["mode"] if mark else "full"
        if mode == "incremental" and k in reached:
            value, paths = reached[k]
            src = extract_beyond(src, mark, F.lit(value).cast(src.schema[mark].dataType), spark.read.parquet(*paths))
        path = f"{root.rstrip('/')}/{p['targetpath']}/{p['tablename'].rpartition('.')[2]}/{attempt}"
        seen, metrics = Observation(), [F.count(F.lit(1)).alias("rows")]
        if mark:
            metrics.append(F.max(F.col(mark)).cast("string").alias("high"))
        extract_full(src, p["datasource"]).observe(seen, *metrics).write.option("parquet.compression.codec.zstd.level", "9").parquet(path, compression="zstd")
        return run, mode, path, *k, seen.get["rows"], mark, seen.get.get("high")

    with ThreadPoolExecutor(max(1, threads)) as pool:
        logged = list(pool.map(inheritable_thread_target(spark)(stage), plan))
    names = [c.split()[0] for c in RUNS_DDL.split(", ") if not c.startswith("loaddate")]
    shape = schema(", ".join(c for c in RUNS_DDL.split(", ") if not c.startswith("loaddate")))
    ts = loaddate if isinstance(loaddate, Column) else F.lit(loaddate)
    rows = spark.createDataFrame(logged, shape).select(*names, ts.alias("loaddate"))
    target = spark.table(runs_table).schema
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in target.fields])
    rows.coalesce(1).write.insertInto(runs_table)  # one file: all rows of the run appear, or none
    return run


def loads_between(spark: SparkSession, runs_table: str, after: int, through: int) -> list[Row]:
    """The published loads with ``after < run <= through`` that hold rows, by run (metadata)."""
    runs = spark.table(runs_table).filter((F.col("run") > after) & (F.col("run") <= through))
    return runs.filter((F.col("numberofrowscopied") > 0) | (F.col("mode") == "full")).orderBy("run", "data_source").collect()


def entity_loads(loads: list[Row], entity: str) -> dict[int, dict[str, str]]:
    """Folders of one entity's loads: run -> data source -> path."""
    out: dict[int, dict[str, str]] = {}
    for r in loads:
        if r["tablename"].rpartition(".")[2] == entity:
            out.setdefault(r["run"], {})[r["data_source"]] = r["path"]
    return out


def last_full_loads(spark: SparkSession, runs_table: str, entity: str, through: int) -> list[str]:
    """The folder of each data source's last full load of an entity, up to a run."""
    runs = spark.table(runs_table).filter((F.col("run") <= through) & (F.col("mode") == "full"))
    last = runs.groupBy("data_source", "tablename").agg(F.max_by("path", "run").alias("path")).orderBy("data_source")
    return [r["path"] for r in last.collect() if r["tablename"].rpartition(".")[2] == entity]
