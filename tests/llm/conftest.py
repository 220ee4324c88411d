import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import EDGE_TEXTS, ROUGH_TEXTS, SF, make_docs  # noqa: E402

from martlens.llm.store import ship_package  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge_docs(spark):
    return make_docs(spark, EDGE_TEXTS).repartition(3).cache()


@pytest.fixture(scope="session")
def rough_docs(spark):
    return make_docs(spark, ROUGH_TEXTS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
