import datetime as dt

from pyspark.sql import functions as F

from claimlake.sources import ingest, tables
from claimlake.sources.schemas import gold, schema
from tests.conftest import rows


def test_write_bronze_append_and_skip_empty(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    p = f"{tmp_dir}/b"
    tables.write_bronze(df, p, "append")
    tables.write_bronze(df, p, "append")
    assert spark.read.parquet(p).count() == 2
    assert tables.write_bronze(df.where(F.lit(False)), p, "overwrite", skip_empty=True) is False
    assert spark.read.parquet(p).count() == 2  # old data kept
    tables.write_bronze(df, p, "overwrite", skip_empty=True)
    assert spark.read.parquet(p).count() == 1


def test_read_bronze_and_path_view(spark, tmp_dir):
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_dir}/hosa/encounters")
    assert tables.read_bronze(spark, tmp_dir, "hosa", "encounters").count() == 1
    v = tables.path_view(spark, "enc_view_t", f"{tmp_dir}/hosa/encounters")
    assert spark.sql("select count(*) from enc_view_t").first()[0] == 1 and v.count() == 1


def test_ensure_and_full_refresh_positional(spark, tmp_dir):
    name = "dim_department_t"
    tables.ensure_table(spark, name, gold("dim_department"), location=f"{tmp_dir}/dd")
    tables.ensure_table(spark, name, gold("dim_department"), location=f"{tmp_dir}/dd")  # idempotent
    src = spark.createDataFrame([("D1-hos-a", "D1", "Cardio", "hos-a")], "a string, b string, c string, d string")
    tables.full_refresh(src, name)
    tables.full_refresh(src, name)
    assert rows(spark.table(name)) == [("D1-hos-a", "D1", "Cardio", "hos-a")]


def test_replace_table_can_read_itself(spark, tmp_dir):
    name = "replace_t"
    df = spark.createDataFrame([(1,), (2,)], "x int")
    tables.replace_table(df, name, tmp_dir)
    # the new content is computed from the table being replaced
    tables.replace_table(spark.table(name).select((F.col("x") * 10).alias("x")), name, tmp_dir)
    assert rows(spark.table(name)) == [(10,), (20,)]


def test_plan_loads_and_extracts(spark):
    plan = ingest.plan_loads(ingest.load_config(spark)).collect()
    assert [(r["datasource"], r["tablename"], r["mode"], r["watermark"]) for r in plan] == [
        ("hos-b", "dbo.patients", "incremental", "Updated_Date")]
    src = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 3))],
                                "id int, Updated_Date date")
    inc = ingest.extract_incremental(src, "Updated_Date", dt.date(2024, 1, 2), "hos-b")
    assert rows(inc, "id") == [(2,), (3,)]  # the boundary day is read again (>=)
    assert ingest.extract_incremental(src, "Updated_Date", None, "hos-b").count() == 3
    assert ingest.extract_full(src, "hos-a").select("datasource").distinct().first()[0] == "hos-a"


def test_run_loads_writes_and_logs(spark, tmp_dir):
    key, log = ("hos-b", "dbo.patients"), "load_logs_t"
    source = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))]

    def load(rows_, at, config=None):
        src = {key: spark.createDataFrame(rows_, "id int, Updated_Date date")}
        return ingest.run_loads(spark, config or ingest.load_config(spark), src, tmp_dir, log, at)

    first = load(source, dt.datetime(2024, 1, 3))  # the loader's clock is ahead of the source's day
    assert first.paths == {key: f"{tmp_dir}/hosb/patients"}  # active rows of the config only
    source.append((3, dt.date(2024, 1, 2)))  # stamped later on the source's own day
    load(source, dt.datetime(2024, 1, 4))
    assert rows(spark.read.parquet(first.paths[key]).select("id")) == [(1,), (2,), (2,), (3,)]
    load([], dt.datetime(2024, 1, 5))  # nothing found: the bound stays
    load(source, dt.datetime(2024, 1, 6))
    got = [(r["numberofrowscopied"], r["watermarkvalue"]) for r in spark.table(log).orderBy("loaddate").collect()]
    assert got == [(2, "2024-01-02"), (2, "2024-01-02"), (0, None), (2, "2024-01-02")]
    assert ingest.latest_watermark(spark.table(log)).first()["last_loaddate"] == dt.datetime(2024, 1, 6)
    full = ingest.load_config(spark).withColumn("loadtype", F.lit("Full"))
    load(source, dt.datetime(2024, 1, 7), full)
    assert spark.read.parquet(first.paths[key]).count() == 3


def test_load_mapped_files(spark, tmp_dir):
    spark.createDataFrame([("D1", "Cardio")], "DeptID string, Name string").write.option("header", True).csv(
        f"{tmp_dir}/raw/HospitalA/departments.csv")
    m = [{"Container": "raw", "FilePath": "HospitalA", "FileName": "departments.csv",
          "DatabaseName": "rcmhospital_a", "TableName": "Departments"}]
    out = ingest.load_mapped_files(spark, m, tmp_dir, {"departments": schema("DeptID string, Name string")})
    assert rows(out["rcmhospital_a.Departments"]) == [("D1", "Cardio")]


def test_overwrite_table_and_quoted_view_path(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x int")
    tables.overwrite_table(df, "ow_t")
    tables.overwrite_table(df.union(df), "ow_t")
    assert spark.table("ow_t").count() == 2
    odd = f"{tmp_dir}/it's here"
    df.write.parquet(odd)
    assert tables.path_view(spark, "odd_view_t", odd).count() == 1


def test_full_refresh_staged(spark, tmp_dir):
    name = "dim_department_staged_t"
    src = spark.createDataFrame([("D1-hos-a", "D1", "Cardio", "hos-a")], "a string, b string, c string, d string")
    tables.replace_table(tables.empty_table(spark, gold("dim_department")), name, tmp_dir)
    tables.full_refresh(src, name, root=tmp_dir)
    # the next refresh reads the table it replaces
    tables.full_refresh(spark.table(name).union(spark.table(name)), name, root=tmp_dir)
    assert spark.table(name).count() == 2


def test_replace_table_refuses_another_shape(spark, tmp_dir):
    import pytest

    tables.replace_table(spark.createDataFrame([(1, "a")], "id int, name string"), "shape_t", tmp_dir)
    with pytest.raises(ValueError, match="differ"):
        tables.replace_table(spark.createDataFrame([(1, "a")], "id int, title string"), "shape_t", tmp_dir)
    assert [tuple(r) for r in spark.table("shape_t").collect()] == [(1, "a")]


def _mapping(name):
    return [{"Container": "raw", "FilePath": "H", "FileName": name, "DatabaseName": "db", "TableName": "T"}]


def _file(root, name, text):
    import os

    os.makedirs(f"{root}/raw/H", exist_ok=True)
    with open(f"{root}/raw/H/{name}", "w") as f:
        f.write(text)


def test_csv_is_bound_by_header_name(spark, tmp_dir):
    import pytest

    shape = {"t": schema("a int, b string")}
    _file(tmp_dir, "swapped.csv", "B,x,a\nfoo,9,1\nbar,8,2\n")
    assert rows(ingest.load_mapped_files(spark, _mapping("swapped.csv"), tmp_dir, shape)["db.T"]) == [(1, "foo"), (2, "bar")]
    _file(tmp_dir, "short.csv", "a,c\n1,x\n")
    with pytest.raises(ValueError, match="lacks"):
        ingest.load_mapped_files(spark, _mapping("short.csv"), tmp_dir, shape)
    _file(tmp_dir, "bad.csv", "b,a\nfoo,1\nbar,two\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest.load_mapped_files(spark, _mapping("bad.csv"), tmp_dir, shape)["db.T"].collect()


def test_csv_rejects_are_an_output(spark, tmp_dir):
    _file(tmp_dir, "t.csv", "b,a\nfoo,1\nbar,two\nonly\nx,1,2\n,3\n")
    got = ingest.land_mapped_files(spark, _mapping("t.csv"), tmp_dir, {"T": schema("a int, b string")}, f"{tmp_dir}/landed")["db.T"]
    assert rows(got.rows) == [(1, "foo"), (3, None)] and got.rows.columns == ["a", "b"]
    assert rows(got.rejects) == [("bar,two",), ("only",), ("x,1,2",)]
    assert (got.n_rows, got.n_rejects) == (2, 3)
    _file(tmp_dir, "clean.csv", "a,b\n1,x\n")
    clean = ingest.land_mapped_files(spark, _mapping("clean.csv"), tmp_dir, {"T": schema("a int, b string")}, f"{tmp_dir}/clean")["db.T"]
    assert rows(clean.rows) == [(1, "x")] and clean.rejects.count() == 0 and clean.n_rejects == 0


def test_csv_folder_with_another_header_fails(spark, tmp_dir):
    import pytest

    import os

    os.makedirs(f"{tmp_dir}/raw/H/many")
    for name, text in (("1.csv", "a,b\n1,x\n"), ("2.csv", "b,a\ny,2\n")):
        with open(f"{tmp_dir}/raw/H/many/{name}", "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        ingest.load_mapped_files(spark, _mapping("many"), tmp_dir, {"T": schema("a int, b string")})["db.T"].collect()


def _counted(spark, df):
    """``df`` and an accumulator of the rows that were computed for it."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return df.mapInPandas(touch, df.schema), seen


def test_guarded_overwrite_computes_its_input_once(spark, tmp_dir):
    df = spark.createDataFrame([(i,) for i in range(100)], "x int")
    counted, seen = _counted(spark, df)
    assert tables.write_bronze(counted, f"{tmp_dir}/p", "overwrite", skip_empty=True)
    assert seen.value == 100 and spark.read.parquet(f"{tmp_dir}/p").count() == 100
    counted, seen = _counted(spark, df)
    path = tables.replace_table(counted, "guarded_t", tmp_dir, skip_empty=True)
    assert seen.value == 100 and tables.table_location(spark, "guarded_t").endswith(path.rpartition("/")[2])
    assert tables.replace_table(df.where("x < 0"), "guarded_t", tmp_dir, skip_empty=True) is None
    assert spark.table("guarded_t").count() == 100
    tables.replace_table(df.where("x < 0"), "guarded_t", tmp_dir)
    assert spark.table("guarded_t").count() == 0


def test_refresh_that_fails_leaves_the_table(spark, tmp_dir):
    """The default refresh and overwrite stage their rows: a failed one changes nothing."""
    import pytest

    name = "dim_department_fail_t"
    tables.ensure_table(spark, name, gold("dim_department"), location=f"{tmp_dir}/dd")
    src = spark.createDataFrame([("D1-hos-a", "D1", "Cardio", "hos-a")], "a string, b string, c string, d string")
    tables.full_refresh(src, name)
    broken = src.withColumn("c", F.raise_error(F.lit("gone")).cast("string"))
    for write in (lambda: tables.full_refresh(broken, name), lambda: tables.overwrite_table(broken.toDF(*spark.table(name).columns), name)):
        with pytest.raises(Exception, match="gone"):
            write()
        assert rows(spark.table(name)) == [("D1-hos-a", "D1", "Cardio", "hos-a")]


def test_overwrite_with_other_columns(spark, tmp_dir):
    tables.overwrite_table(spark.createDataFrame([(1,)], "x int"), "ow_shape_t", tmp_dir)
    tables.overwrite_table(spark.createDataFrame([("a", 2)], "y string, z int"), "ow_shape_t")
    tables.overwrite_table(spark.createDataFrame([("b", 3)], "y string, z int"), "ow_shape_t")
    assert rows(spark.table("ow_shape_t")) == [("b", 3)] and spark.table("ow_shape_t").columns == ["y", "z"]
