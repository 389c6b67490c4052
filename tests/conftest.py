from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cargolens.session import tune  # noqa: E402


def new_session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="cargolens-session-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("cargolens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.01"
