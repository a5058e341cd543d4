"""SCD2 (D1-D6), the registry upsert (D4), anti-join (C4): the cases of FIXTURES.md."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimlake.operators.history import (
    scd2_apply,
    scd2_expire,
    scd2_initial,
    scd2_insert,
    snapshot,
    unmatched,
    upsert_flagged,
    versions_per_key,
    rows_per_source_key,
)
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 3)
SRC = "k string, a string, b int"
TGT = SRC + ", audit_insertdate timestamp, audit_modifieddate timestamp, is_current boolean"


def target(spark, data):
    return spark.createDataFrame(data, TGT)


def source(spark, data):
    return spark.createDataFrame(data, SRC)


def base_target(spark):
    return target(spark, [
        ("same", "x", 1, T0, T0, True),
        ("chg", "x", 1, T0, T0, True),
        ("to_null", "x", 1, T0, T0, True),
        ("from_null", None, 1, T0, T0, True),
        ("missing", "x", 1, T0, T0, True),
        ("old_only", "x", 1, T0, T0, False),
        (None, "n", 1, T0, T0, True),
        ("hist_null_flag", "x", 1, T0, T0, None),
    ])


def base_source(spark):
    return source(spark, [
        ("same", "x", 1),
        ("chg", "y", 1),
        ("to_null", None, 1),
        ("from_null", "x", 1),
        ("old_only", "z", 1),
        ("new", "n", 2),
        (None, "n", 1),
    ])


def test_scd2_apply_cases(spark):
    out = scd2_apply(base_target(spark), base_source(spark), "k", ts=T1)
    got = rows(out)
    expect = sorted([
        ("same", "x", 1, T0, T0, True),
        ("chg", "x", 1, T0, T1, False),          # expired
        ("chg", "y", 1, T1, T1, True),           # new version
        ("to_null", "x", 1, T0, T0, True),       # NULL-unsafe: not a change (S1)
        ("from_null", None, 1, T0, T0, True),    # NULL-unsafe: not a change (S1)
        ("missing", "x", 1, T0, T0, True),       # absent from batch stays current (S7)
        ("old_only", "x", 1, T0, T0, False),     # history untouched
        ("old_only", "z", 1, T1, T1, True),      # key with only history: inserted
        (None, "n", 1, T0, T0, True),            # NULL-key current row kept
        (None, "n", 1, T1, T1, True),            # NULL key inserted again (S2)
        ("new", "n", 2, T1, T1, True),
        ("hist_null_flag", "x", 1, T0, T0, None),  # NULL current flag = history (S18)
    ], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got == expect


def test_scd2_null_safe_option(spark):
    out = scd2_apply(base_target(spark), base_source(spark), "k", ts=T1, null_safe=True)
    cur = {r["k"]: r["a"] for r in snapshot(out).collect() if r["k"] in ("to_null", "from_null")}
    assert cur == {"to_null": None, "from_null": "x"}
    assert out.filter((F.col("k") == "to_null") & ~F.col("is_current")).count() == 1


def test_scd2_apply_equals_two_passes(spark):
    t, s = base_target(spark), base_source(spark)
    one = rows(scd2_apply(t, s, "k", ts=T1))
    two = rows(scd2_insert(scd2_expire(t, s, "k", ts=T1), s, "k", ts=T1))
    assert one == two


def test_scd2_rerun_changes_nothing_without_null_keys(spark):
    s = base_source(spark).filter(F.col("k").isNotNull())
    once = scd2_apply(base_target(spark), s, "k", ts=T1)
    once_rows = rows(once)
    twice = scd2_apply(spark.createDataFrame(once_rows, TGT), s, "k", ts=T2)
    assert rows(twice) == once_rows


def test_scd2_duplicate_source_key_raises(spark):
    s = source(spark, [("chg", "y", 1), ("chg", "z", 1)])
    with pytest.raises(Exception, match="several source rows"):
        scd2_apply(base_target(spark), s, "k", ts=T1).collect()


def test_scd2_duplicate_null_keys_are_fine(spark):
    s = source(spark, [(None, "y", 1), (None, "y", 1)])
    out = scd2_apply(base_target(spark), s, "k", ts=T1)
    assert out.filter(F.col("k").isNull()).count() == 3


def test_scd2_casts_source_to_target_types(spark):
    t = spark.createDataFrame([], "k string, d timestamp, audit_insertdate timestamp, "
                                  "audit_modifieddate timestamp, is_current boolean")
    s = spark.createDataFrame([("1", dt.date(2024, 5, 1))], "k string, d date")
    out = scd2_apply(t, s, "k", ts=T1)
    assert dict(out.dtypes)["d"] == "timestamp"
    assert out.first()["d"] == dt.datetime(2024, 5, 1)


def test_scd2_integral_keys(spark):
    t = spark.createDataFrame([(1, "a", T0, T0, True), (None, "z", T0, T0, True)],
                              "k long, v string, audit_insertdate timestamp, audit_modifieddate timestamp, "
                              "is_current boolean")
    s = spark.createDataFrame([(1, "b"), (2, "c"), (None, "z")], "k long, v string")
    out = scd2_apply(t, s, "k", ts=T1)
    assert out.count() == 5  # expired + new version, NULL row kept, new key, NULL row again
    assert snapshot(out).filter(F.col("k") == 1).first()["v"] == "b"


def _random_batch(rng, keys, n):
    vals = ["p", "q", None]
    return [(rng.choice(keys), rng.choice(vals), rng.choice([1, 2])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scd2_properties(spark, seed):
    """At most one current row per key; history never changes; equals two passes."""
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(12)]
    state = spark.createDataFrame([], TGT)
    history_before: list = []
    for step in range(3):
        batch = _random_batch(rng, keys, 10)
        seen, dedup = set(), []
        for r in batch:  # one row per key (S6)
            if r[0] not in seen:
                seen.add(r[0])
                dedup.append(r)
        s = source(spark, dedup)
        ts = dt.datetime(2024, 1, 1 + step)
        new = scd2_apply(state, s, "k", ts=ts)
        two = scd2_insert(scd2_expire(state, s, "k", ts=ts), s, "k", ts=ts)
        new_rows = rows(new)
        assert new_rows == rows(two)
        cur = [r for r in new_rows if r[-1] is True]
        assert len(cur) == len({r[0] for r in cur})
        hist_now = [r for r in new_rows if r[-1] is not True]
        for h in history_before:
            assert h in hist_now
        history_before = hist_now
        state = spark.createDataFrame(new_rows, TGT)


def test_unmatched_anti_join(spark):
    t = base_target(spark)
    s = base_source(spark)
    got = sorted(r["k"] or "<null>" for r in unmatched(s, t, "k").collect())
    assert got == ["<null>", "new", "old_only"]


def test_versions_and_rows_per_key(spark):
    out = scd2_apply(base_target(spark), base_source(spark), "k", ts=T1)
    v = {r["k"]: r["n_versions"] for r in versions_per_key(out, "k").collect()}
    assert v["chg"] == 2 and v["old_only"] == 2 and v[None] == 2 and v["same"] == 1
    first = versions_per_key(out, "k").first()
    assert first["n_versions"] == 2
    r = {r["k"]: r["n_rows"] for r in rows_per_source_key(out, ["k"], "a").collect()}
    assert r["from_null"] == 0 and r["chg"] == 2


ICD = "icd_code string, icd_code_type string, code_description string, inserted_date date, " \
      "updated_date date, is_current_flag boolean"
D0, D1 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_upsert_flagged_semantics(spark):
    t = spark.createDataFrame([
        ("A00", "ICD-10", "cholera", D0, D0, True),
        ("A01", "ICD-10", "typhoid", D0, D0, True),
        ("A02", "ICD-10", "other", D0, D0, False),
    ], ICD)
    s = spark.createDataFrame([
        ("A00", "ICD-10", "cholera, revised", D1, D1, True),
        ("A01", "ICD-10", "typhoid", D1, D1, True),
        ("A09", "ICD-10", "new", D1, D1, True),
    ], ICD)
    out = {r["icd_code"]: tuple(r) for r in upsert_flagged(t, s, "icd_code").collect()}
    # changed description: overwritten in place, updated_date from source, flag FALSE (S3)
    assert out["A00"] == ("A00", "ICD-10", "cholera, revised", D0, D1, False)
    assert out["A01"] == ("A01", "ICD-10", "typhoid", D0, D0, True)       # unchanged
    assert out["A02"] == ("A02", "ICD-10", "other", D0, D0, False)        # not in batch
    assert out["A09"] == ("A09", "ICD-10", "new", D1, D1, True)           # inserted
    # the same batch again changes nothing more
    again = {r["icd_code"]: tuple(r) for r in upsert_flagged(
        spark.createDataFrame(list(out.values()), ICD), s, "icd_code").collect()}
    assert again == out


def test_upsert_duplicate_raises(spark):
    t = spark.createDataFrame([("A00", "ICD-10", "c", D0, D0, True)], ICD)
    s = spark.createDataFrame([("A00", "ICD-10", "x", D1, D1, True), ("A00", "ICD-10", "y", D1, D1, True)], ICD)
    with pytest.raises(Exception, match="several source rows"):
        upsert_flagged(t, s, "icd_code").collect()


def test_scd2_skip_null_keys(spark):
    out = scd2_apply(base_target(spark), base_source(spark), "k", ts=T1, null_keys="skip")
    assert out.filter(F.col("k").isNull()).count() == 1  # only the existing NULL-key row


def test_scd2_key_broadcast_paths_agree(spark):
    t, s = base_target(spark), base_source(spark)
    split = rows(scd2_apply(t, s, "k", ts=T1, key_broadcast="auto"))
    full = rows(scd2_apply(t, s, "k", ts=T1, key_broadcast="never"))
    tiny = rows(scd2_apply(t, s, "k", ts=T1, max_key_rows=1))  # over the bound: full join
    assert split == full == tiny
    # whole rows over the bound, keys within it: 6 keys of 21 bytes against 7 rows of three columns
    keys_only = rows(scd2_apply(t, s, "k", ts=T1, max_key_bytes=6 * (96 + 8) + 100))
    assert keys_only == split
    for size in (None, 6 * (96 + 8) + 100, 1):
        bound = {} if size is None else {"max_key_bytes": size}
        assert rows(scd2_apply(t, s, "k", ts=T1, on_duplicate="merge", **bound)) == split
        assert rows(scd2_insert(scd2_expire(t, s, "k", ts=T1, **bound), s, "k", ts=T1)) == split
        assert rows(unmatched(s, t, "k", **bound)) == rows(unmatched(s, t, "k", key_broadcast="never"))


def test_scd2_target_with_two_current_rows_per_key(spark):
    """A table from the original two-pass loads may hold two current rows for a key."""
    t = target(spark, [("dup", "x", 1, T0, T0, True), ("dup", "x", 1, T0, T0, True)])
    s = source(spark, [("dup", "y", 1)])
    got = rows(scd2_apply(t, s, "k", ts=T1))
    assert got == [("dup", "x", 1, T0, T1, False), ("dup", "x", 1, T0, T1, False), ("dup", "y", 1, T1, T1, True)]
    # and it matches the two MERGE passes
    assert got == rows(scd2_insert(scd2_expire(t, s, "k", ts=T1), s, "k", ts=T1))


def test_scd2_plan_splits_current_rows_map_side(spark, tmp_dir):
    path = f"{tmp_dir}/tgt"
    base_target(spark).write.parquet(path)
    plan = scd2_apply(spark.read.parquet(path), base_source(spark), "k", ts=T1)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "BroadcastExchange" in plan
    assert "LeftOuter" in plan  # pass 1 from the current rows; pass 2 is the anti-join


def test_merge_mode_duplicates_like_two_passes(spark):
    t = base_target(spark)
    dup_new = source(spark, [("fresh", "a", 1), ("fresh", "b", 1), ("same", "x", 1)])
    got = rows(scd2_apply(t, dup_new, "k", ts=T1, on_duplicate="merge"))
    assert got == rows(scd2_insert(scd2_expire(t, dup_new, "k", ts=T1), dup_new, "k", ts=T1))
    assert sum(1 for r in got if r[0] == "fresh") == 2  # both copies inserted, as the insert pass does
    dup_matched = source(spark, [("chg", "y", 1), ("chg", "z", 1)])
    with pytest.raises(Exception, match="several source rows"):
        scd2_apply(t, dup_matched, "k", ts=T1, on_duplicate="merge").collect()
    with pytest.raises(Exception, match="several source rows"):
        scd2_expire(t, dup_matched, "k", ts=T1).collect()


def test_scd2_duplicate_current_rows_one_unchanged(spark):
    """One of two current rows still equals the batch: it stays current and
    nothing is inserted (the insert pass finds a current row)."""
    t = target(spark, [("dup", "x", 1, T0, T0, True), ("dup", "y", 1, T0, T0, True)])
    s = source(spark, [("dup", "y", 1)])
    got = rows(scd2_apply(t, s, "k", ts=T1))
    assert got == [("dup", "x", 1, T0, T1, False), ("dup", "y", 1, T0, T0, True)]
    assert got == rows(scd2_insert(scd2_expire(t, s, "k", ts=T1), s, "k", ts=T1))


def test_upsert_null_keys_and_unmatched_without_flag(spark):
    t = spark.createDataFrame([(None, "ICD-10", "x", D0, D0, True), ("A00", "ICD-10", "c", D0, D0, True)], ICD)
    s = spark.createDataFrame([(None, "ICD-10", "y", D1, D1, True)], ICD)
    out = upsert_flagged(t, s, "icd_code")
    assert out.count() == 3  # NULL keys never match: the target one stays, the source one is inserted
    assert sorted(r["code_description"] for r in out.filter(F.col("icd_code").isNull()).collect()) == ["x", "y"]
    assert unmatched(s, t, "icd_code", current=None).count() == 1


def test_scd2_new_key_twice_raises(spark):
    s = source(spark, [("brand_new", "a", 1), ("brand_new", "b", 1)])
    with pytest.raises(Exception, match="several source rows"):
        scd2_apply(base_target(spark), s, "k", ts=T1).collect()
    with pytest.raises(Exception, match="several source rows"):
        scd2_apply(base_target(spark), s, "k", ts=T1, key_broadcast="never").collect()


def test_upsert_new_key_twice_raises(spark):
    t = spark.createDataFrame([("A00", "ICD-10", "c", D0, D0, True)], ICD)
    s = spark.createDataFrame([("B00", "ICD-10", "x", D1, D1, True), ("B00", "ICD-10", "y", D1, D1, True)], ICD)
    with pytest.raises(Exception, match="several source rows"):
        upsert_flagged(t, s, "icd_code").collect()
    assert upsert_flagged(t, s, "icd_code", on_duplicate="unchecked").count() == 3


def test_merge_refuses_only_several_changes(spark):
    """A copy that equals the current row updates nothing, so one changed copy beside it is legal."""
    t = target(spark, [("k", "x", 1, T0, T0, True)])
    s = source(spark, [("k", "x", 1), ("k", "y", 1)])
    got = rows(scd2_apply(t, s, "k", ts=T1, on_duplicate="merge"))
    assert got == rows(scd2_insert(scd2_expire(t, s, "k", ts=T1), s, "k", ts=T1))
    assert got == sorted([("k", "x", 1, T0, T1, False), ("k", "x", 1, T1, T1, True), ("k", "y", 1, T1, T1, True)],
                         key=lambda r: tuple((x is None, str(x)) for x in r))
    same = source(spark, [("k", "x", 1), ("k", "x", 1)])
    assert rows(scd2_apply(t, same, "k", ts=T1, on_duplicate="merge")) == [("k", "x", 1, T0, T0, True)]


def test_one_key_in_a_third_of_the_batch(spark):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("junk")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("a").alias("a"), F.lit(1).alias("b"))
    for mode in ("auto", "never"):
        out = scd2_apply(base_target(spark), many, "k", ts=T1, on_duplicate="merge", key_broadcast=mode)
        assert out.filter(F.col("k") == "junk").count() == 1000
        with pytest.raises(Exception, match="several source rows"):
            scd2_apply(base_target(spark), many, "k", ts=T1, key_broadcast=mode).collect()


def test_first_load_checks_keys(spark):
    shape = target(spark, []).schema
    ok = source(spark, [("a", "x", 1), (None, "x", 1), (None, "x", 1)])
    assert scd2_initial(ok, shape, T1, key="k").count() == 3
    with pytest.raises(Exception, match="several source rows"):
        scd2_initial(source(spark, [("a", "x", 1), ("a", "y", 1)]), shape, T1, key="k").collect()


def test_small_batch_plan_reads_the_table_twice(spark, tmp_dir):
    path, new = f"{tmp_dir}/tgt2", f"{tmp_dir}/new2"
    base_target(spark).write.parquet(path)
    base_source(spark).write.parquet(new)
    out = scd2_apply(spark.read.parquet(path), spark.read.parquet(new), "k", ts=T1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("tgt2") == 2 and "Window" not in plan and "SortMergeJoin" not in plan
