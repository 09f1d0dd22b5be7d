import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
LLM = [name for name in entry.queries() if name.startswith("op") or name == "pipeline"]


def test_all_are_registered():
    assert [n.split("_")[0] for n in LLM] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


@pytest.mark.parametrize("name", [n for n in LLM if n in entry.oracle_sql()])
def test_query_equals_its_sql(spark, name):
    import pandas as pd

    duck = duckdb.connect()
    for table in check.TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = entry.queries()[name](spark, SF)
    found = check.normal(pd.DataFrame([tuple(r) for r in result.collect()], columns=result.columns, dtype=object))
    sql = duck.sql(entry.oracle_sql()[name])
    assert sorted(result.columns) == sorted(sql.columns)
    assert found == check.normal(pd.DataFrame(sql.fetchall(), columns=sql.columns, dtype=object))
