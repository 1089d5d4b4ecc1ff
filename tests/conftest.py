import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from hirelens import schemas  # noqa: E402
from hirelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from hirelens.session import fresh_folder

    return lambda name="test": fresh_folder(spark, name)


@pytest.fixture
def events(spark):
    """Typed event rows from keyword dictionaries; fields left out are null."""

    def build(*rows):
        names = schemas.EVENT.fieldNames()
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schemas.EVENT)

    return build


@pytest.fixture
def text_rows(spark):
    def build(*rows):
        names = schemas.CSV.fieldNames()
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schemas.CSV)

    return build
