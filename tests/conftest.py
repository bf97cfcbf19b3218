from __future__ import annotations

import os

import pytest

from gradewise.session import build_session

DATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__default__parallelism="4",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__log__level="ERROR",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def loans(spark, sf):
    """The loan fixture, computed once."""
    from gradewise import fixtures

    return fixtures.loans(spark, sf).cache()


@pytest.fixture(scope="session")
def raw(loans):
    from pyspark.sql import functions as F

    from gradewise.plans.ingest import to_raw_schema

    return to_raw_schema(loans, ingest_ts=F.col("ingest_ts")).cache()


@pytest.fixture
def plan():
    """Text of a frame's physical plan."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
