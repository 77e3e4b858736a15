"""Every query of the catalogue against its DuckDB oracle on sf0.001 (rows-only where no SQL).

The document operators' queries have tests of their own.
"""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from cohortlens.plans.catalog import REGISTRY
from conftest import SF_SMALL

KEYS = sorted(REGISTRY)
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    # pivot columns are discovered from data: regenerate those statements for this scale
    from cohortlens.plans.oracle_sql import discovered_pivot_sqls
    SQL.update(discovered_pivot_sqls(c))
    return c


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(E.queries()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    if key in SQL:
        problems, _, _ = compare(df, con, SQL[key])
        assert not problems, problems
    else:
        assert df.count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["partner", "users"]
