from __future__ import annotations

import pytest
from odd_rows import ODD, SCHEMA, SF_DIR, extra


@pytest.fixture(scope="session")
def odd(spark):
    return extra(spark.createDataFrame(ODD, SCHEMA)).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return extra(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
