import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def sf_documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
