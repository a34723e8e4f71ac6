import pytest

from odd_rows import _FILL, SCHEMA, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(*r, *_FILL) for r in odd_rows()], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
