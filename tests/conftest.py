import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    ckpt = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
    s = build_session(
        "local[*]",
        app_name="tessera-tests",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": ckpt,
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tessera-test-wh-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def events(spark):
    from tessera.sources.fixtures import load_table

    return load_table(spark, SF_SMALL, "events")


@pytest.fixture(scope="session")
def silver(events):
    from tessera.sources.fixtures import fx_silver

    return fx_silver(events).cache()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tessera-test-")
