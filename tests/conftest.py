import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("claimlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="claimlake-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from claimlake.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)  # keeps a configured folder; sets a scratch one only if unset
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="claimlake-test-")


def rows(df, *cols):
    """Sorted plain tuples of ``df`` (optionally of some columns) for comparisons."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
