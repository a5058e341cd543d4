"""The driver contract, and the DuckDB gate on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from claimlake.plans.registry import QUERIES
from tools.check_oracles import digest, duck

SF = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["Provider_Name", "Dept_Name", "YYYYMM", "Total_Charge_Amt", "Total_Paid_Amt"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    con = duck(SF)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in dcols)
    assert digest(df.columns, srows) == digest(dcols, cur.fetchall())
