import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="basketry-test-")
    session = spark_session("tests", cores="8", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": f"{folder}/warehouse",
        "spark.checkpoint.dir": f"{folder}/checkpoints",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
