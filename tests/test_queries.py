"""Every query against its twin in another engine."""

import pytest
from support import as_rows

import __spark_entry__ as entry
from strataflow.plans import queries as core


@pytest.mark.parametrize("name", list(core.QUERIES))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert as_rows(df.columns, df.collect()) == as_rows(names, cursor.fetchall())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_core_query_has_an_oracle():
    assert set(core.QUERIES) == set(core.ORACLE_SQL)
