"""Incremental bronze -> silver as a Structured Streaming job.

Bronze extracts land as parquet files in a folder. A file-source stream
picks up only files it has not seen (its checkpoint remembers them), and
each micro-batch is applied to the silver table with the SCD2 operator in
``foreachBatch``. Run with ``trigger(availableNow=True)`` on a schedule:
every run processes whatever landed since the last one, then stops.

Exactly-once: ``foreachBatch`` may replay an epoch after a failure. The
epoch number is written into the new table version's folder name, which is
committed by the same catalog change that swaps the table, so a replayed
epoch that already committed is recognised and skipped. (Re-applying would
be harmless for rows with keys, but would insert NULL-key rows twice, S2.)
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.operators.history import TX_AUDIT, Audit, scd2_apply
from claimlake.operators.quality import latest_per_key
from claimlake.session import ensure_checkpoint_dir
from claimlake.sources.tables import empty_table, replace_table, table_location

_EPOCH = re.compile(r"s([0-9a-f]{12})\.(\d+)")


def stream_id(checkpoint: str) -> str:
    """A short name of the stream: epochs count from 0 anew with every checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def committed_epochs(spark: SparkSession, table: str) -> dict[str, int]:
    """The last epoch of each stream applied to ``table``, from its version folder's name."""
    name = (table_location(spark, table) or "").rstrip("/").rpartition("/")[2]
    return {s: int(e) for s, e in _EPOCH.findall(name)}


def committed_epoch(spark: SparkSession, table: str, checkpoint: str) -> int:
    """The last epoch of the stream with this checkpoint applied to ``table`` (-1 if none)."""
    return committed_epochs(spark, table).get(stream_id(checkpoint), -1)


def scd2_stream(spark: SparkSession, landing: str, bronze_schema: T.StructType, table: str,
                table_root: str, target_schema: T.StructType, key: str,
                quality: Callable[[DataFrame], DataFrame],
                batch_time: Callable[[int], _dt.datetime | _dt.date] | None = None,
                audit: Audit = TX_AUDIT, newest_by: list[str] | None = None, null_safe: bool = False,
                checkpoint: str | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream that SCD2-applies newly landed bronze files.

    ``quality`` turns a bronze micro-batch into the silver row shape (key,
    flags). ``newest_by``: when one micro-batch can hold several versions of
    a key (several extracts landed between runs), keep the newest by these
    columns first (S5/S6). ``batch_time(epoch)`` gives the audit time of a
    batch (default: the time the batch starts). The checkpoint defaults to a
    folder under the session's shared ``spark.checkpoint.dir``.
    """
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/claimlake-streams/{table}"
    own = stream_id(checkpoint)
    clock = batch_time or (lambda _epoch: _dt.datetime.now())

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        epochs = committed_epochs(session, table)
        if epoch <= epochs.get(own, -1):
            return  # replay of a batch of this stream that already committed
        rows = quality(batch)
        if newest_by:
            rows = latest_per_key(rows, key, newest_by)
        if session.catalog.tableExists(table):
            current = session.table(table)
        else:
            current = empty_table(session, target_schema)
        new = scd2_apply(current, rows, key, ts=clock(epoch), audit=audit, null_safe=null_safe,
                         on_duplicate="unchecked" if newest_by else "error")
        replace_table(new, table, table_root, tag="-".join(f"s{s}.{e}" for s, e in sorted((epochs | {own: epoch}).items())))

    stream = spark.readStream.schema(bronze_schema).parquet(landing)
    writer = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def run_once(spark: SparkSession, **kwargs) -> None:
    """Start ``scd2_stream`` and wait until everything landed so far is applied."""
    q = scd2_stream(spark, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    # batches run in the stream's own session; drop this session's cached file list
    if spark.catalog.tableExists(kwargs["table"]):
        spark.catalog.refreshTable(kwargs["table"])
