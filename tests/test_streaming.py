import datetime as dt

from claimlake.plans import jobs
from claimlake.sources.schemas import silver
from claimlake.streaming.incremental import committed_epoch, run_once
from tests.conftest import rows

ENC = ("EncounterID string, PatientID string, EncounterDate date, EncounterType string, ProviderID string, "
       "DepartmentID string, ProcedureCode int, InsertedDate date, ModifiedDate date, datasource string")


def _enc(spark, data):
    return spark.createDataFrame(data, ENC)


def test_stream_applies_new_files_once(spark, tmp_dir):
    d = dt.date(2024, 1, 1)
    day1 = _enc(spark, [("E1", "P1", d, "Inpatient", "PR", "D1", 1, d, d, "hos-a"),
                        (None, "P9", d, "Inpatient", "PR", "D1", 1, d, d, "hos-a")])
    day2 = _enc(spark, [("E1", "P1", d, "Emergency", "PR", "D1", 1, d, dt.date(2024, 1, 2), "hos-a"),
                        ("E2", "P2", d, "Inpatient", "PR", "D1", 1, d, d, "hos-a")])
    clock = {0: dt.datetime(2024, 1, 1), 1: dt.datetime(2024, 1, 2), 2: dt.datetime(2024, 1, 3)}
    kw = dict(landing=f"{tmp_dir}/landing", bronze_schema=day1.schema, table="enc_stream_t",
              table_root=f"{tmp_dir}/silver", target_schema=silver("encounters"), key="EncounterID",
              quality=jobs.encounters_quality, batch_time=clock.__getitem__, checkpoint=f"{tmp_dir}/ckpt")
    day1.write.mode("append").parquet(kw["landing"])
    run_once(spark, **kw)
    assert committed_epoch(spark, "enc_stream_t", kw["checkpoint"]) == 0
    assert spark.table("enc_stream_t").count() == 2
    day2.write.mode("append").parquet(kw["landing"])
    run_once(spark, **kw)
    assert committed_epoch(spark, "enc_stream_t", kw["checkpoint"]) == 1
    after = rows(spark.table("enc_stream_t"), "EncounterID", "EncounterType", "is_current")
    assert after == [("E1-hos-a", "Emergency", True), ("E1-hos-a", "Inpatient", False),
                     ("E2-hos-a", "Inpatient", True), (None, "Inpatient", True)]
    run_once(spark, **kw)  # nothing new landed: no batch, no change
    assert rows(spark.table("enc_stream_t"), "EncounterID", "EncounterType", "is_current") == after


def test_stream_keeps_newest_version_within_a_batch(spark, tmp_dir):
    d = dt.date(2024, 1, 1)
    both = _enc(spark, [("E1", "P1", d, "Inpatient", "PR", "D1", 1, d, d, "hos-a"),
                        ("E1", "P1", d, "Emergency", "PR", "D1", 1, d, dt.date(2024, 1, 5), "hos-a")])
    kw = dict(landing=f"{tmp_dir}/landing", bronze_schema=both.schema, table="enc_stream_newest_t",
              table_root=f"{tmp_dir}/silver", target_schema=silver("encounters"), key="EncounterID",
              quality=jobs.encounters_quality, batch_time=lambda e: dt.datetime(2024, 1, 6),
              checkpoint=f"{tmp_dir}/ckpt", newest_by=["SRC_ModifiedDate"])
    both.write.mode("append").parquet(kw["landing"])
    run_once(spark, **kw)
    assert rows(spark.table("enc_stream_newest_t"), "EncounterID", "EncounterType", "is_current") == [
        ("E1-hos-a", "Emergency", True)]


def test_second_checkpoint_loses_nothing(spark, tmp_dir):
    d = dt.date(2024, 1, 1)
    for n, key in enumerate(("E1", "E2")):  # epoch 0 of either stream
        batch = _enc(spark, [(key, "P1", d, "Inpatient", "PR", "D1", 1, d, d, "hos-a")])
        batch.write.mode("append").parquet(f"{tmp_dir}/landing{n}")
        run_once(spark, landing=f"{tmp_dir}/landing{n}", bronze_schema=batch.schema, table="enc_two_streams_t",
                 table_root=f"{tmp_dir}/silver", target_schema=silver("encounters"), key="EncounterID",
                 quality=jobs.encounters_quality, batch_time=lambda e: dt.datetime(2024, 1, 6), checkpoint=f"{tmp_dir}/ckpt{n}")
    assert rows(spark.table("enc_two_streams_t"), "EncounterID") == [("E1-hos-a",), ("E2-hos-a",)]
