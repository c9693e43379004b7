"""Every relational query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the registry contract."""

import os

import pytest

import __spark_entry__ as entry_module
from aerolens.plans import catalog
from aerolens.plans.oracle import oracle_sql
from conftest import SF_ORACLE, SF_SMALL
from oracle_compare import compare, duck_connection

FITTED = {"model_comparison", "perceptron_scores"}
QUERIES = catalog.queries()
ORACLE = oracle_sql()


def test_registry_contract():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == FITTED
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), duck, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["Year", "DestinationState", "Number"]
    got = df.collect()
    assert len(got) > 0
    ok, msg = compare(df, duck_connection(SF_SMALL), ORACLE["top_states_per_year"])
    assert ok, msg


def test_fixture_facts_at_sf001(spark):
    """Facts recorded for the derived view (FIXTURES.md)."""
    flights = QUERIES["drop_trailing_columns"](spark, SF_ORACLE)
    facts = flights.selectExpr(
        "count(*)", "count(DISTINCT OP_CARRIER)", "sum(CASE WHEN CANCELLED = 1 THEN 1 ELSE 0 END)",
        "count(DEP_TIME)", "count(ARR_DELAY)", "sum(CASE WHEN CRS_DEP_TIME = 2400 THEN 1 ELSE 0 END)",
    ).first()
    assert tuple(facts) == (60000, 18, 1114, 58886, 58214, 630)
    labels = dict(QUERIES["label_counts"](spark, SF_ORACLE).collect())
    assert labels == {"Early": 12313, "OnTime": 19706, "Delay": 25632}


@pytest.mark.parametrize("absent", ["aerolens.llm", "corpus_pipeline", "xxhash", "tokenizers", "public_tokenizers"])
def test_entry_survives_without_the_text_operators(absent):
    """The relational queries stay when a module of the text operators is missing."""
    import subprocess
    import sys

    code = f"""
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {absent!r} or name.startswith({absent + "."!r}):
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(q.startswith("op") for q in entry.queries()))
"""
    root = os.path.dirname(entry_module.__file__)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=100)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLE)), "False"], done.stderr
