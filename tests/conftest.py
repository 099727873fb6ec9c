import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lodestar.sources.files import ensure_checkpoint_dir

    session = (
        SparkSession.builder.master("local[*]").appName("lodestar-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    """A fresh folder for files a test writes (tests only; jobs use the checkpoint folder)."""
    return tempfile.mkdtemp(prefix="lodestar-test-", dir="/tmp")
