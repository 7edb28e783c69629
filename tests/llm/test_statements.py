import pytest

import __spark_entry__ as entry
from checks import compare
from plaudit.llm.registry import QUERIES, STATEMENTS
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_duckdb(spark, name):
    df = QUERIES[name](spark, SMALL)
    result = compare.connect(SMALL).execute(STATEMENTS[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert compare.normal(df.collect(), df.columns) == compare.normal(result.fetchall(), columns)


def test_all_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(STATEMENTS) <= set(entry.oracle_sql())
