"""Helpers shared by the training-data operators: stored steps, hot keys, ranks.

Hot keys. One key may hold a third of all rows, so a shuffle by that key
would put a third of the data into one task. ``hot_keys`` finds such keys
with mergeable frequent-item sketches (the Misra-Gries family) and counts
them exactly; their number is bounded, so they can be broadcast and their
rows handled map-side, while all other keys shuffle as usual.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key is hot if it holds at least one row in this many; there are no more hot keys than that.
HOT_ONE_IN = 1024
#: Items each sketch tracks (several times HOT_ONE_IN, so that no hot key is missed).
TRACKED = 8192
#: Sketches are merged in this many groups first, so that no single task merges one of every input task.
MERGE_GROUPS = 64


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back.

    Later steps read the stored rows instead of recomputing them; a lost
    executor loses nothing, as the folder is shared.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Jobs started inside send at most ``rows`` rows at once to a Python worker; the setting is put back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, nothing else (``lower`` would change other letters too)."""
    return F.translate(col, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Hot(NamedTuple):
    """Hot keys: their stored ``rows`` (key, n, aggregates) and the ``hashes`` of the keys, HOT_ONE_IN at most."""

    rows: DataFrame
    hashes: list[int]

    def holds(self, key: str) -> Column:
        return F.xxhash64(key).isin(self.hashes) & F.col(key).isNotNull() if self.hashes else F.lit(False)


def hot_keys(df: DataFrame, key: str, aggs: Sequence[Column] = ()) -> Hot:
    """The hot values of ``key`` (not null) with their exact row counts ``n`` and ``aggs``.

    Two passes over ``df`` (store it first if it is costly): sketches per task,
    merged in groups and then once, name the candidates; a second pass counts
    the candidates exactly, folded map-side, and keeps those that really hold
    ``1 / HOT_ONE_IN`` of the rows.
    """
    hashed = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"), (F.spark_partition_id() % MERGE_GROUPS).alias("g"))
    sketches = hashed.groupBy("g").agg(F.expr(f"approx_top_k_accumulate(h, {TRACKED})").alias("s"), F.count("*").alias("rows"))
    # by a key that is always false: a combine without a key fails on a partition without rows
    merged = sketches.groupBy(F.col("g") < 0).agg(F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s"), F.sum("rows").alias("rows"))
    found = merged.select("rows", F.explode(F.expr(f"approx_top_k_estimate(s, {HOT_ONE_IN})")).alias("f"))
    found = found.where(f"f.count * {HOT_ONE_IN} >= rows AND f.count > 1").select(F.col("f.item").alias("h"), "rows").collect()
    maybe, total = Hot(df, [r["h"] for r in found]), found[0]["rows"] if found else 0
    counted = df.where(maybe.holds(key)).groupBy(key).agg(F.count("*").alias("n"), *aggs)
    if not found:
        return Hot(counted, [])  # of no rows: nothing to count or to store
    rows = stored(counted.where(F.col("n") * HOT_ONE_IN >= total), "hot")
    return Hot(rows, [r["h"] for r in rows.select(F.xxhash64(key).alias("h")).collect()])


def lookup(left: DataFrame, right: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per ``key``).

    Rows of hot keys meet the bounded hot part of ``right`` map-side; the rest
    shuffles, and no key of the rest holds more than a small share of the rows.
    """
    if not hot.hashes:
        return left.join(right, key)
    often = hot.holds(key)
    return left.where(often).join(F.broadcast(right.where(often)), key).unionByName(left.where(~often).join(right.where(~often), key))


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by their exact names, dots included."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def ranked(df: DataFrame, part: Sequence[str], cell: Column, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """0-based rank within ``part`` in the order (cell, order), in two levels.

    A window per ``part`` would put a whole part into one task. Rows are
    numbered within (part, cell), and each cell starts where the cells before
    it end. ``cell`` must be a small int; parts x cells rows are broadcast, so
    the caller bounds both. ``df`` is read twice.
    """
    df = df.withColumn("__cell", cell)
    keys = [*part, "__cell"]
    before = Window.partitionBy(*part).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*keys).count().select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    within = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    joined = within.join(F.broadcast(starts), keys)
    return joined.withColumn(name, F.col("__start") + F.col("__n") - 1).drop("__cell", "__n", "__start")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
