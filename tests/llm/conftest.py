import pytest


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
