"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import pytest

from compare import compare, oracle
from tidemark.plans.workload import QUERIES
from tidemark.plans.workload_sql import SQL

FOLDER = "/root/testdata/sf0.001"
COMPILED = {
    "spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY", "spark.sql.adaptive.enabled": "true",
}


@pytest.fixture(scope="module")
def compiled(spark):
    before = {key: spark.conf.get(key) for key in COMPILED}
    for key, value in COMPILED.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(compiled, connection, name):
    frames = []

    def kept(spark, folder):
        frames.append(QUERIES[name](spark, folder))
        return frames[0]

    assert compare(compiled, connection, kept, SQL[name], FOLDER) is None
    plan = frames[0]._jdf.queryExecution().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "Python"):
        assert operator not in plan


def test_entry(compiled):
    import __spark_entry__ as driver

    assert driver.entry(compiled).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
