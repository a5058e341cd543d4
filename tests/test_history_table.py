"""Stored SCD2 tables: current part rewritten, history appended, one commit a batch."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from claimlake.operators.history import scd2_apply
from claimlake.sources import history_table as ht
from claimlake.sources.schemas import schema
from claimlake.sources.tables import empty_table
from tests.conftest import rows

SHAPE = "k string, v int, w string, audit_insertdate timestamp, audit_modifieddate timestamp, is_current boolean"
BATCH = "k string, v int, w string"
DAY = [dt.datetime(2024, 1, n) for n in range(1, 12)]


def table(name, tmp_dir, buckets=3):
    return ht.HistoryTable(name, f"{tmp_dir}/tables", "k", schema(SHAPE), buckets=buckets)


def batches(seed, n):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 1, 2, 3])
    return [[(f"k{i}", value(), rng.choice([None, "x", "y"])) for i in rng.sample(range(30), rng.choice([0, 5, 25]))]
            + [(None, value(), None)] * rng.choice([0, 2]) for _ in range(n)]


@pytest.mark.parametrize("broadcast", ["auto", "never"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_equals_scd2_apply(spark, tmp_dir, broadcast, null_safe):
    t = table(f"hist_eq_{broadcast}_{null_safe}_t", tmp_dir)
    want = spark.createDataFrame([], SHAPE)
    for day, batch in zip(DAY, batches(7, 5)):
        source = spark.createDataFrame(batch, BATCH)
        want = spark.createDataFrame(scd2_apply(want, source, "k", ts=day, null_safe=null_safe).collect(), SHAPE)
        ht.apply_stored(spark, t, source, day, null_safe=null_safe, key_broadcast=broadcast)
        assert rows(spark.table(t.name)) == rows(want)
    state = ht.state_of(spark, t)
    assert state.version == 5
    assert ht.current_rows(spark, t, 5).filter("NOT is_current OR k IS NULL").count() == 0


def test_keys_of_another_type(spark, tmp_dir):
    t = ht.HistoryTable("hist_int_t", tmp_dir, "k", schema("k int, v int, audit_insertdate timestamp, audit_modifieddate timestamp, is_current boolean"), buckets=2)
    for day, v in zip(DAY, (1, 2)):
        ht.apply_stored(spark, t, spark.createDataFrame([(1, v), (2, 5), (None, 0)], "k int, v int"), day)
    assert rows(spark.table(t.name), "k", "v", "is_current") == [(1, 1, False), (1, 2, True), (2, 5, True), (None, 0, True), (None, 0, True)]


def test_rows_are_shuffled_once_and_written_without_a_sort(spark, tmp_dir, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    t, ran, sql = table("hist_lean_t", tmp_dir), [], type(spark).sql

    def watched(self, query, *args, **kwargs):
        if query.startswith("INSERT"):
            ran.append(sql(self, f"EXPLAIN {query}").first()[0])
        return sql(self, query, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", watched)
    ht.apply_stored(spark, t, spark.createDataFrame([(f"k{i}", i, "x") for i in range(50)], BATCH), DAY[0])
    assert len(ran) == 1 and ran[0].count("Exchange") == 1 and "Sort" not in ran[0], ran
    files = glob.glob(f"{tmp_dir}/tables/hist_lean_t/version=1/*/part=current/*.parquet")
    assert len(files) == 3
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_keys_repeated_by_an_unchecked_batch_are_no_fault_of_the_next(spark, tmp_dir):
    t = table("hist_unchecked_t", tmp_dir)
    ht.apply_stored(spark, t, spark.createDataFrame([("a", 1, "x"), ("a", 2, "x")], BATCH), DAY[0], on_duplicate="unchecked")
    ht.apply_stored(spark, t, spark.createDataFrame([("b", 1, "x")], BATCH), DAY[1])
    assert rows(spark.table(t.name), "k", "v") == [("a", 1), ("a", 2), ("b", 1)]
    with pytest.raises(Exception, match="several source rows for key c"):
        ht.apply_stored(spark, t, spark.createDataFrame([("c", 1, "x"), ("c", 1, "x")], BATCH), DAY[2])


def test_repeated_key_raises_and_changes_nothing(spark, tmp_dir):
    t = table("hist_dup_t", tmp_dir)
    ht.apply_stored(spark, t, spark.createDataFrame([("a", 1, "x")], BATCH), DAY[0])
    for broadcast in ("auto", "never"):
        with pytest.raises(Exception, match="several source rows for key a"):
            ht.apply_stored(spark, t, spark.createDataFrame([("a", 2, "x"), ("a", 3, "x")], BATCH), DAY[1], key_broadcast=broadcast)
    assert rows(spark.table(t.name), "k", "v") == [("a", 1)] and ht.state_of(spark, t) == ht.State(1, 0)
    with pytest.raises(Exception, match="several source rows"):
        ht.apply_stored(spark, table("hist_dup2_t", tmp_dir), spark.createDataFrame([("a", 2, "x"), ("a", 3, "x")], BATCH), DAY[0])


def test_attempt_that_was_not_published(spark, tmp_dir, monkeypatch):
    """Rows are written and registered, the job stops before the commit: readers and the next attempt do not see them."""
    t = table("hist_stop_t", tmp_dir)
    ht.apply_stored(spark, t, spark.createDataFrame([("a", 1, "x")], BATCH), DAY[0], applied=1)
    real = ht._query

    def stop(table_, state):
        if state.version == 2:
            raise RuntimeError("lost")
        return real(table_, state)

    monkeypatch.setattr(ht, "_query", stop)
    batch = spark.createDataFrame([("a", 2, "x"), (None, 0, "x")], BATCH)
    with pytest.raises(RuntimeError):
        ht.apply_stored(spark, t, batch, DAY[1], applied=2)
    monkeypatch.undo()
    assert rows(spark.table(t.name), "v") == [(1,)] and ht.state_of(spark, t) == ht.State(1, 1)
    ht.apply_stored(spark, t, batch, DAY[2], applied=2)
    assert rows(spark.table(t.name), "v", "is_current") == [(0, True), (1, False), (2, True)]
    assert ht.state_of(spark, t) == ht.State(2, 2)


def test_versions_and_retirement(spark, tmp_dir):
    t = table("hist_ver_t", tmp_dir)
    for day, v in zip(DAY, range(1, 5)):
        ht.apply_stored(spark, t, spark.createDataFrame([("a", v, "x"), (None, v, "x")], BATCH), day)
    assert rows(ht.as_of(spark, t, 2), "v", "is_current") == [(1, False), (1, True), (2, True), (2, True)]
    gone = ht.retire(spark, t, keep=2)
    assert len(gone) == 2 and all(os.path.isdir(p) for p in gone)
    assert spark.table(t.name).count() == 8
    with pytest.raises(ValueError, match="not kept"):
        ht.as_of(spark, t, 1)
    assert rows(ht.as_of(spark, t, 3), "v", "is_current") == [(1, False), (1, True), (2, False), (2, True), (3, True), (3, True)]


def size_below(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_bytes_written_do_not_grow_with_history(spark, tmp_dir):
    """A 1 % batch writes about the current part, however much history there is; each bucket has few files."""
    t = table("hist_bytes_t", tmp_dir, buckets=4)
    data = spark.range(40000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(0).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("w"))
    ht.apply_stored(spark, t, data, DAY[0])
    root = f"{t.root}/{t.name}"
    first = size_below(f"{root}/version=1")
    for n in range(1, 5):  # everything changes: history grows by the whole table
        ht.apply_stored(spark, t, data.withColumn("v", F.lit(n)), DAY[n])
    small = data.filter("pmod(hash(k), 100) = 7").withColumn("v", F.lit(99))
    ht.apply_stored(spark, t, small, DAY[6])
    last = size_below(f"{root}/version=6")
    assert last < 1.15 * first < 0.3 * size_below(root)
    current = [f for d, _, files in os.walk(f"{root}/version=6") if "part=current" in d for f in files if f.endswith(".parquet")]
    assert len(current) <= 3 * 4
    assert spark.table(t.name).count() == 40000 * 5 + small.count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_table_is_not_moved(spark, tmp_dir):
    t = table("hist_plan_t", tmp_dir)
    batch = spark.createDataFrame([(f"k{i}", i, "x") for i in range(50)], BATCH)
    ht.apply_stored(spark, t, batch, DAY[0])
    with ht._bucket_by_bucket(spark):
        large = plan_of(ht.changes(spark, t, batch, DAY[1], key_broadcast="never", on_duplicate="unchecked"))
        small = plan_of(ht.changes(spark, t, batch, DAY[1], on_duplicate="unchecked"))
    assert "FullOuter" in large and large.count("Exchange hashpartitioning") == 1  # the batch's
    assert large.count("hist_plan_t__files") == 1
    assert "Exchange hashpartitioning(k" not in small and small.count("FileScan parquet") == 2
    assert small.count("ReadSchema: struct<k:string>") == 1  # the second scan reads the key alone


def test_empty_first_batch(spark, tmp_dir):
    t = table("hist_empty_t", tmp_dir)
    ht.apply_stored(spark, t, empty_table(spark, schema(BATCH)), DAY[0])
    assert spark.table(t.name).count() == 0
    ht.apply_stored(spark, t, spark.createDataFrame([("a", 1, "x")], BATCH), DAY[1])
    assert rows(spark.table(t.name), "k", "v") == [("a", 1)]


@pytest.mark.parametrize("broadcast", ["auto", "never"])
def test_repeatable_batches_are_not_stored_again(spark, tmp_dir, monkeypatch, broadcast):
    t, want, stored = table(f"hist_repeat_{broadcast}_t", tmp_dir), spark.createDataFrame([], SHAPE), []
    monkeypatch.setattr(ht, "scratch_path", lambda *a: stored.append(a))
    for n, (day, batch) in enumerate(zip(DAY, batches(11, 4))):
        spark.createDataFrame(batch, BATCH).write.parquet(f"{tmp_dir}/extract{n}")
        source = spark.read.parquet(f"{tmp_dir}/extract{n}")
        want = spark.createDataFrame(scd2_apply(want, source, "k", ts=day).collect(), SHAPE)
        ht.apply_stored(spark, t, source, day, repeatable=True, key_broadcast=broadcast)
        assert rows(spark.table(t.name)) == rows(want)
    assert not stored
    with pytest.raises(Exception, match="several source rows for key a"):
        ht.apply_stored(spark, t, spark.createDataFrame([("a", 2, "x"), ("a", 3, "x")], BATCH), DAY[5], repeatable=True, key_broadcast=broadcast)


def test_large_batches_are_shuffled_packed(spark, tmp_dir):
    shape = schema(SHAPE.replace("w string", "w string, x string"))
    t = ht.HistoryTable("hist_pack_t", f"{tmp_dir}/tables", "k", shape, buckets=3)
    batch = spark.createDataFrame([(f"k{i}", i, "x", None) for i in range(50)], BATCH + ", x string")
    with ht._bucket_by_bucket(spark):
        ht.create(spark, t)
        first = plan_of(ht.changes(spark, t, batch, DAY[0], on_duplicate="unchecked"))
        ht.apply_stored(spark, t, batch, DAY[0])
        second = plan_of(ht.changes(spark, t, batch, DAY[1], key_broadcast="never", on_duplicate="unchecked"))
    for plan in (first, second):
        below = plan.partition("Exchange hashpartitioning")[2].partition("- ")[2]
        assert plan.count("Exchange hashpartitioning") == 1 and below.lstrip().startswith(("Project", "*")) and "__texts" in below.partition("\n")[0]
    assert "FullOuter" in second


def test_buckets_grow_with_the_first_load(spark, tmp_dir, monkeypatch):
    """A bucket's rows fit a task, however few partitions the session has."""
    data = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(0).alias("v"), F.lit("x" * 40).alias("w"))
    monkeypatch.setattr(ht, "BUCKET_BYTES", 5000)
    size = {}
    for name, source, buckets in (("large", data, None), ("fixed", data, 3), ("small", data.limit(5), None)):
        t = table(f"hist_size_{name}_t", tmp_dir, buckets)
        ht.apply_stored(spark, t, source, DAY[0])
        ht.apply_stored(spark, t, source.withColumn("v", F.lit(1)), DAY[1], key_broadcast="never")
        size[name] = ht.bucket_count(spark, t)
        assert rows(spark.table(t.name).groupBy("is_current").count()) == sorted([(False, source.count()), (True, source.count())])
    assert size == {"large": -(-(2000 * (4 + 40) + 8890) // 5000), "fixed": 3, "small": int(spark.conf.get("spark.sql.shuffle.partitions"))}


def test_shuffle_files_go_with_the_batch(spark, tmp_dir):
    import glob
    import time

    env = spark._jvm.org.apache.spark.SparkEnv.get()
    found = lambda: {f for d in env.blockManager().diskBlockManager().localDirs() for f in glob.glob(f"{d}/*/shuffle_*.data")}
    t, before = table("hist_clean_t", tmp_dir), found()
    batch = spark.createDataFrame([(f"k{i}", i, "x") for i in range(50)], BATCH)
    ht.apply_stored(spark, t, batch, DAY[0])
    first = found() - before
    ht.apply_stored(spark, t, batch, DAY[1])
    until = time.time() + 20
    while first & found() and time.time() < until:
        time.sleep(0.1)
    assert not first & found()
