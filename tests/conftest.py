from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("aerolens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests may set their own checkpoint folder, but only when none is set.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get(
        "spark.checkpoint.dir", None
    ):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerolens-ckpt-"))
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="aerolens-test-")


def rows(df, *cols):
    """Collected rows as plain tuples (selected columns, or all)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
