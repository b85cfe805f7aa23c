"""Every registered query with a SQL counterpart equals it, whole, at sf0.001; the others give rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import difference, duck

DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()
CON = duck(DIR)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, name):
    got = queries()[name](spark, DIR).toPandas()
    if name in SQL:
        assert difference(got, CON.sql(SQL[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry(spark).count() == 5
