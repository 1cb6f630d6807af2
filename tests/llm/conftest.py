import pytest


@pytest.fixture()
def empty(spark):
    from tests.llm.helpers import SCHEMA

    return spark.createDataFrame([], SCHEMA)
