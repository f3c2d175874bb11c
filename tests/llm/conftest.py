import pytest
from llm_cases import ODD, documents


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
