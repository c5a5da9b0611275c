import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bibliospark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="bibliospark-test-ckpt-")
    s = get_session(
        "local[4]",
        app="bibliospark-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": ckpt,
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bibliospark-test-warehouse-"),
            "spark.driver.memory": "4g",
        },
    )
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def checkpoint_dir(spark):
    """A folder per module: tests that list intermediates see no other module's."""
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bibliospark-test-ckpt-"))


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="bibliospark-test-")
