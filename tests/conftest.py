import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tamiz.session import local_session  # noqa: E402
from tamiz.workload.messy import messy as messy_view  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def messy(spark):
    return messy_view(spark, SMALL).cache()


@pytest.fixture()
def rows_of(spark):
    """Rows from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
