"""The driver contract: entry() smoke, and every registered query against its
DuckDB oracle on the small tables (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.check_oracles import compare, open_duckdb

# The reference's own operators all have an oracle; of the others those that SQL can express.
CORE = set(E.QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "type", "count"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert CORE <= set(E.queries())
    assert CORE <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF001)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    assert compare(df, con, E.oracle_sql()[name]) == []
