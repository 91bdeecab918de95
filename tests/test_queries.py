import pytest
from compare import DATA, check

from frond.plans import curation_queries, function_queries, io_queries, pipeline_queries, training_queries

MODULES = (training_queries, curation_queries, pipeline_queries, function_queries, io_queries)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        check(spark, name, QUERIES[name], ORACLES[name])
    else:
        assert QUERIES[name](spark, str(DATA)).count() > 0


def test_no_name_is_given_twice():
    assert len(QUERIES) == sum(len(m.QUERIES) for m in MODULES) and len(ORACLES) == sum(len(m.ORACLES) for m in MODULES)


def test_entry_adds_what_is_there():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
