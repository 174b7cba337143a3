import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from admesh.session import local_session  # noqa: E402
from admesh.storage import RunFolder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "admesh-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def run(spark):
    return RunFolder(spark)


@pytest.fixture
def table(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make
