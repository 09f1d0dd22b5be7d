"""Every registered query against its SQL on the smallest test tables."""

import importlib.util
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, normal
from dimspark.checks.oracles import ORACLES
from dimspark.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql_and_is_registered():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= spark_entry.queries().keys() and ORACLES.keys() <= spark_entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    rows = normal(pd.DataFrame([tuple(r) for r in found.collect()], columns=found.columns, dtype=object))
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows == normal(pd.DataFrame(expected.fetchall(), columns=expected.columns, dtype=object))
    assert rows


def test_order_facts_choose_between_versions_of_one_person(spark):
    from pyspark.sql import functions as F

    from dimspark.checks.queries import _dimension_plans

    people = _dimension_plans(spark, SF_DIR)["employee"]()
    orders = QUERIES["q_fct_order"](spark, SF_DIR)
    for role in ("salesperson_key", "picker_key"):
        found = orders.join(people, F.col(role) == F.col("employee_key")).groupBy("wwi_employee_id")
        assert found.agg(F.countDistinct("employee_key").alias("n")).agg(F.max("n")).first()[0] > 1


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_bench_is_importable():
    assert importlib.util.find_spec("bench")
