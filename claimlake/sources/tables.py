"""Bronze, silver and gold storage.

Plain parquet plus the session catalog: no table format is assumed.
``replace_table`` stages the new content in a fresh directory and points the
table at it in one catalog change, so readers never see a half-written or
empty table (S12), and a plan may read the table it replaces. Old version
folders stay until the caller's retention job removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame the optimizer knows is empty (joins with it fold away)."""
    return spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).where(F.lit(False))


def read_bronze(spark: SparkSession, root: str, source: str, entity: str) -> DataFrame:
    """A1: scan one hospital's entity, ``{root}/{source}/{entity}`` (schema from the footers)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{source}/{entity}")


def path_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A2 / A4: a session view bound straight to a path (``CREATE TEMP VIEW ... USING``)."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"bad view name {name!r}")
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {fmt} OPTIONS (path '{quoted}')")
    return spark.table(name)


def write_bronze(df: DataFrame, path: str, mode: str = "append", skip_empty: bool = False) -> bool:
    """Append to, or overwrite, a parquet directory.

    ``skip_empty``: an extract with no rows leaves the old data in place
    (the registry overwrite only runs when it fetched something). The extract
    is computed once, into a folder of the checkpoint folder, and its rows
    are counted as they are written; what came is then copied to ``path``.
    Readers of a bare path can meet the moment of the copy: keep the extract
    as a table (``replace_table`` with ``skip_empty``) where that matters.
    Returns whether it wrote.
    """
    if skip_empty:
        from claimlake.session import scratch_path

        seen, staged = Observation(), scratch_path(df.sparkSession, "staged")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
        if seen.get["rows"] == 0:
            return False
        df = df.sparkSession.read.schema(df.schema).parquet(staged)
    df.write.mode(mode).parquet(path)
    return True


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                 partition_by: list[str] | None = None) -> None:
    """A10: ``CREATE TABLE IF NOT EXISTS name (schema) USING parquet``."""
    if spark.catalog.tableExists(name):
        return
    db = name.split(".")[0] if "." in name else None
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{part}{loc}")


def _versions_root(spark: SparkSession, name: str) -> str:
    """Where new versions of a table go: beside the folder it points at, or in the warehouse."""
    at = table_location(spark, name)
    if at is None:
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions"
    tail = f"/{name.replace('.', '/')}/v-"
    return at.partition(tail)[0] if tail in at else f"{at.rstrip('/')}__versions"


def overwrite_table(df: DataFrame, name: str, root: str | None = None) -> None:
    """Replace a table's content, and its columns if they changed.

    The rows are staged first. With the same columns the table is then pointed
    at them by one catalog change. With others it is dropped and created over
    the staged rows, two catalog changes, after the rows are there.
    """
    spark = df.sparkSession
    root = root or _versions_root(spark, name)
    if not spark.catalog.tableExists(name) or _shape(df.schema) == _shape(spark.table(name).schema):
        replace_table(df, name, root)
        return
    path = _stage(df, name, root)[0]
    spark.sql(f"DROP TABLE {name}")
    _create_over(spark, name, df.schema, path)


def _shape(s: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in s.fields]


def _stage(df: DataFrame, name: str, root: str, tag: str | None = None, cluster_by: list[str] | None = None) -> tuple[str, int]:
    """Write ``df`` to a fresh version folder; returns it and the number of rows."""
    version = f"{tag}-{uuid.uuid4().hex}" if tag else uuid.uuid4().hex
    path, seen = f"{root.rstrip('/')}/{name.replace('.', '/')}/v-{version}", Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = out.sortWithinPartitions(*cluster_by) if cluster_by else out
    out.write.mode("errorifexists").parquet(path)
    return path, seen.get["rows"]


def _create_over(spark: SparkSession, name: str, shape: T.StructType, path: str) -> None:
    db = name.split(".")[0] if "." in name else None
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{path}'")


def replace_table(df: DataFrame, name: str, root: str, tag: str | None = None,
                  cluster_by: list[str] | None = None, skip_empty: bool = False) -> str | None:
    """A11 + A13 in one commit: stage ``df`` under ``{root}/{name}/v-[tag-]<id>``,
    then point table ``name`` at it (creating it if absent). Returns the new path.

    Unlike TRUNCATE-then-INSERT there is no moment with an empty table, and
    ``df`` may read the table being replaced. ``tag`` (e.g. a stream epoch)
    is part of the folder name, so it is committed with the swap itself; a swap
    without one keeps the last. Rows of another shape than the table's are refused.
    ``cluster_by`` sorts rows within each write task (no shuffle), so each
    parquet row group covers a narrow range of those columns and range
    filters on them skip row groups. With ``skip_empty`` (A8) a table is only
    replaced if rows came, as counted while they were staged; otherwise it
    stays, and None is returned. ``df`` is computed once in any case.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists:
        if _shape(df.schema) != _shape(spark.table(name).schema):
            raise ValueError(f"columns of the new rows differ from those of table {name}")
        if tag is None:  # what streams have committed stays on record
            at = (table_location(spark, name) or "").rstrip("/")
            tag = at.rpartition("/v-")[2].rpartition("-")[0] if "/v-" in at else None
    path, rows = _stage(df, name, root, tag, cluster_by)
    if skip_empty and rows == 0:
        return None
    if exists:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        _create_over(spark, name, df.schema, path)
    return path


def full_refresh(df: DataFrame, name: str, schema: T.StructType | None = None,
                 by: str = "position", root: str | None = None) -> None:
    """A11 + A12 + A13: replace an existing table's rows with ``df``.

    ``df`` is shaped like the table first (positional by default, with store
    casts, as ``INSERT INTO t SELECT`` does). The rows are staged under
    ``root`` (by default beside the table's folder) and swapped in with one
    catalog change (``replace_table``): readers never see an empty table and
    a failed run changes nothing, unlike the reference's TRUNCATE + INSERT (S12).
    """
    from claimlake.operators.conform import conform_to

    spark = df.sparkSession
    replace_table(conform_to(df, schema or spark.table(name).schema, by=by), name, root or _versions_root(spark, name))


def table_location(spark: SparkSession, name: str) -> str | None:
    """The storage folder a catalog table currently points at (None if absent)."""
    if not spark.catalog.tableExists(name):
        return None
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if r["col_name"] == "Location":
            return r["data_type"]
    return None
