import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from accesslake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "line string")

    return make


def bucket_line(
    op="REST.GET.OBJECT", status="200", key="corpora/a.E01", sent="10", size="100", ip="10.0.0.1",
    agent='"agent x"', time="07/Aug/2022:11:35:52 +0000", request="R1",
):
    return (
        f'own bkt [{time}] {ip} - {request} {op} {key} "GET /x HTTP/1.1" {status} - {sent} {size} 160 64 '
        f'"-" {agent} - H= - C - h.example TLSv1.2'
    )


@pytest.fixture
def bucket():
    return bucket_line


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_of
