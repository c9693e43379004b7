"""The registered text queries against their DuckDB SQL."""

import pytest

from aerolens.llm import oracle, queries
from oracle_compare import compare, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_matches_oracle(spark, duck, name):
    ok, message = compare(queries.queries()[name](spark, SF), duck, oracle.oracle_sql()[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(oracle.oracle_sql())))
def test_query_gives_a_row_for_each_row(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op13") else ("documents", "doc_id")
    rows = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    got = queries.queries()[name](spark, SF)
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in rows.collect())
