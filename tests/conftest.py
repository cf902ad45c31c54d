from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from notice_lake.sources import scratch  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("notice-lake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        # Small inputs over several cores: a matter of the session, not of the queries.
        .config("spark.sql.files.minPartitionNum", "2")
        # Many short queries: compile fast rather than well.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.release(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def session_conf(spark):
    """Set session options for one test."""
    saved = {}

    def set_conf(name, value):
        saved.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_conf
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
