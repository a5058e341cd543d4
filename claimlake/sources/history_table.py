"""Stored SCD2 tables whose history is not rewritten.

A table is a view over one partitioned and bucketed files table:

* ``current``: the rows that batches can change, one per key, bucketed by the
  key. Every batch writes a new version of this part only;
* ``history``: expired rows; a batch appends those that it expired;
* ``keyless``: rows whose key is NULL. They match nothing (S2), so they are
  appended too, and never crowd a bucket.

A batch meets the current part where it lies: that part is read bucket by
bucket and never shuffled, whatever the size of the batch. The rows of the
batch are written below ``version=<n>/attempt=<id>`` and become visible by one
``ALTER VIEW``, which also records what was applied. Until then readers see
the version before it; what a failed attempt registered is dropped by the next
one. One writer at a time applies batches to a table.

``as_of`` gives any version whose current part is still there; ``retire``
names the folders that no kept version needs.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.packing import pack
from claimlake.operators.history import TX_AUDIT, Audit, BatchSize, duplicate_check, scd2_current, scd2_initial, size_metrics
from claimlake.session import drop_finished_shuffles, scratch_path

CURRENT, HISTORY, KEYLESS = "current", "history", "keyless"
#: Files that a task keeps open as it writes; a task that needs more sorts the rest of its rows.
OPEN_FILES = 4
#: Payload of a first load for each bucket: a join sorts both sides of a bucket, several times this, in one task's memory.
BUCKET_BYTES = 64 * 1024 * 1024
#: Pages of prefixes and differences, as rows come out of a join sorted by key.
FILE_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "v2"}
_STATE = re.compile(r"/\* state (\{.*?\}) \*/", re.S)


@dataclass(frozen=True)
class HistoryTable:
    """``name``: the view that readers query. ``root``: where its files go.
    ``buckets``: fixed when the table is created. By default the session's
    shuffle partitions, or more if ``apply_stored`` creates the table from a
    first load of more than ``BUCKET_BYTES`` for each."""

    name: str
    root: str
    key: str
    schema: T.StructType
    audit: Audit = TX_AUDIT
    buckets: int | None = None

    @property
    def files(self) -> str:
        return f"{self.name}__files"


@dataclass(frozen=True)
class State:
    """The visible version of a table (0: empty), and the last load run applied to it."""

    version: int = 0
    applied: int = 0


def _query(table: HistoryTable, state: State) -> str:
    cols = ", ".join(f"`{f.name}`" for f in table.schema.fields)
    return (f"SELECT {cols} FROM {table.files} /* state {json.dumps(state.__dict__)} */ "
            f"WHERE version <= {state.version} AND (part <> '{CURRENT}' OR version = {state.version})")


def state_of(spark: SparkSession, table: HistoryTable) -> State:
    """What the view shows, from its own text."""
    if not spark.catalog.tableExists(table.name):
        return State()
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").collect():
        if r["col_name"] == "View Text":
            return State(**json.loads(_STATE.search(r["data_type"]).group(1)))
    raise ValueError(f"{table.name} is not the view of a history table")


def create(spark: SparkSession, table: HistoryTable, first_bytes: int = 0) -> None:
    """The files table and its view, if absent; ``first_bytes``: payload that it is about to take."""
    if spark.catalog.tableExists(table.name):
        return
    if "." in table.name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.name.split('.')[0]}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    buckets = table.buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-first_bytes // BUCKET_BYTES))
    options = ", ".join(f"'{key}' '{value}'" for key, value in FILE_OPTIONS.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.files} ({cols}, version int, attempt string, part string) USING parquet "
              f"OPTIONS ({options}) PARTITIONED BY (version, attempt, part) CLUSTERED BY (`{table.key}`) INTO {buckets} BUCKETS "
              f"LOCATION '{table.root.rstrip('/')}/{table.name.replace('.', '/')}'")
    spark.sql(f"CREATE VIEW IF NOT EXISTS {table.name} AS {_query(table, State())}")


def bucket_count(spark: SparkSession, table: HistoryTable) -> int:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table.files}").collect():
        if r["col_name"] == "Num Buckets":
            return int(r["data_type"])
    raise ValueError(f"{table.files} is not bucketed")


def current_rows(spark: SparkSession, table: HistoryTable, version: int) -> DataFrame:
    """The current part of a version, bucketed by key."""
    part = spark.table(table.files).where((F.col("version") == version) & (F.col("part") == CURRENT))
    return part.select(*[f"`{f.name}`" for f in table.schema.fields])


def as_of(spark: SparkSession, table: HistoryTable, version: int) -> DataFrame:
    """The table as a version left it; raises if its current part was retired."""
    if version < state_of(spark, table).version and not any(
            p["part"] == CURRENT and int(p["version"]) == version for p in _partitions(spark, table)):
        raise ValueError(f"version {version} of {table.name} is not kept")
    return spark.sql(_query(table, State(version)))


@contextmanager
def _bucket_by_bucket(spark: SparkSession):
    """Scans inside read bucketed tables one task a bucket, so what is written again has one file a bucket.

    A task then writes to few files, one for each part: they are open at once,
    so its rows need no sort (which would spill) first.
    """
    values = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def changes(spark: SparkSession, table: HistoryTable, batch: DataFrame, ts: _dt.datetime | _dt.date | Column,
            tracked: Sequence[str] | None = None, null_safe: bool = False, on_duplicate: str = "error",
            key_broadcast: str = "auto", size: BatchSize | None = None) -> DataFrame:
    """What a batch makes of the current rows: kept, expired and new rows (history is not read)."""
    version = state_of(spark, table).version
    if version:
        return scd2_current(current_rows(spark, table, version), batch, table.key, tracked, ts, table.audit, null_safe,
                            on_duplicate, key_broadcast, size=size)
    key = F.col(f"`{table.key}`")
    packed, whole = pack(batch)
    # a key goes to its bucket's task; rows without one are spread over all tasks
    spread = F.coalesce(whole[table.key].cast("string"), F.monotonically_increasing_id().cast("string"))
    dealt = packed.repartition(bucket_count(spark, table), whole[table.key] if table.schema[table.key].dataType != T.StringType() else spread)
    first = scd2_initial(dealt.select(*[c.alias(name) for name, c in whole.items()]), table.schema, ts, table.audit)
    if on_duplicate == "error":
        first = first.unionByName(duplicate_check(batch.where(key.isNotNull()).select(key), table.key, first.schema, table.name))
    return first


def apply_batch(spark: SparkSession, table: HistoryTable, batch: DataFrame, ts: _dt.datetime | _dt.date | Column,
                applied: int | None = None, **how) -> State:
    """D5 onto a stored table: write the new current part, append expired and keyless rows, publish.

    The batch is read several times (measured, joined): ``apply_stored`` stores
    it first unless that does no harm. ``applied`` is recorded in the same commit, as the last load run
    that the table holds. ``how``: see ``changes``. A key that the batch
    repeats is twice in the new current part too: it is looked for there,
    bucket by bucket, without a shuffle, before the part is published.
    """
    create(spark, table)
    state = state_of(spark, table)
    new = State(state.version + 1, state.applied if applied is None else applied)
    live = F.coalesce(F.col(f"`{table.audit.current}`") == F.lit(True), F.lit(False))
    part = F.when(F.col(f"`{table.key}`").isNull(), KEYLESS).when(live, CURRENT).otherwise(HISTORY)
    check = how.get("on_duplicate", "error") == "error"
    rows = changes(spark, table, batch, ts, **how | ({"on_duplicate": "unchecked"} if check else {})).withColumn("part", part)
    _forget_beyond(spark, table, state.version)
    attempt = uuid.uuid4().hex
    rows.createOrReplaceTempView(f"claimlake_batch_{attempt}")
    try:
        with _bucket_by_bucket(spark):
            spark.sql(f"INSERT INTO {table.files} PARTITION (version = {new.version}, attempt = '{attempt[:12]}', part) "
                      f"SELECT * FROM claimlake_batch_{attempt}")
    finally:
        spark.catalog.dropTempView(f"claimlake_batch_{attempt}")
    if check:
        _check_keys(spark, table, batch, new.version)
    spark.sql(f"ALTER VIEW {table.name} AS {_query(table, new)}")
    drop_finished_shuffles(spark)
    return new


def _check_keys(spark: SparkSession, table: HistoryTable, batch: DataFrame, version: int) -> None:
    """Raises if the batch that made ``version`` holds a key twice."""
    key = F.col(f"`{table.key}`")
    if current_rows(spark, table, version).groupBy(key).agg(F.count(F.lit(1)).alias("__cnt")).where("__cnt > 1").count():
        # an earlier, unchecked batch may have brought it
        keys = batch.where(key.isNotNull()).select(key)
        duplicate_check(keys, table.key, keys.schema, table.name).collect()


def _partitions(spark: SparkSession, table: HistoryTable) -> list[dict[str, str]]:
    return [dict(p.split("=") for p in r["partition"].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table.files}").collect()]


def _drop(spark: SparkSession, table: HistoryTable, spec: dict[str, str]) -> str:
    """Unregister one partition; returns its folder (the files stay)."""
    where = f"version = {spec['version']}, attempt = '{spec['attempt']}', part = '{spec['part']}'"
    spark.sql(f"ALTER TABLE {table.files} DROP IF EXISTS PARTITION ({where})")
    return "/".join([table.root.rstrip("/"), table.name.replace(".", "/"), *[f"{k}={v}" for k, v in spec.items()]])


def _forget_beyond(spark: SparkSession, table: HistoryTable, version: int) -> list[str]:
    """Unregister what unpublished attempts wrote."""
    return [_drop(spark, table, spec) for spec in _partitions(spark, table) if int(spec["version"]) > version]


def _size(batch: DataFrame, key: str) -> BatchSize:
    return BatchSize(**batch.agg(*size_metrics(batch, key)).first().asDict())


def apply_stored(spark: SparkSession, table: HistoryTable, batch: DataFrame, ts: _dt.datetime | _dt.date | Column,
                 applied: int | None = None, repeatable: bool = False, **how) -> State:
    """``apply_batch`` of a batch that is measured first.

    A batch is computed once: stored below the checkpoint folder, and measured
    as it is written. One that reads the same each time (``repeatable``: a view
    over files that stay) is measured where it lies, and not written again. A
    first load is not stored either; if it creates the table, it is measured
    for the number of buckets.
    """
    if not state_of(spark, table).version:
        if table.buckets is None and not spark.catalog.tableExists(table.name):
            create(spark, table, _size(batch, table.key).bytes)
    elif repeatable:
        how = how | {"size": _size(batch, table.key)}
    else:
        seen, path = Observation(), scratch_path(spark, "batch")
        batch.observe(seen, *size_metrics(batch, table.key)).write.parquet(path, compression="zstd")
        batch, how = spark.read.schema(batch.schema).parquet(path), how | {"size": BatchSize(**seen.get)}
    return apply_batch(spark, table, batch, ts, applied, **how)


def mark_applied(spark: SparkSession, table: HistoryTable, applied: int) -> State:
    """Record load runs that held nothing for this table."""
    create(spark, table)
    new = State(state_of(spark, table).version, applied)
    spark.sql(f"ALTER VIEW {table.name} AS {_query(table, new)}")
    return new


def retire(spark: SparkSession, table: HistoryTable, keep: int = 2) -> list[str]:
    """Drop the current parts of all but the last ``keep`` versions from the
    files table, and return their folders for the caller's retention job."""
    version = state_of(spark, table).version
    return [_drop(spark, table, spec) for spec in _partitions(spark, table)
            if spec["part"] == CURRENT and int(spec["version"]) <= version - keep]
