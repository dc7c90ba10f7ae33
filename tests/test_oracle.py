"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "decimal(5,2)": "DECIMAL(5,2)",
}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    actual = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert actual == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns
    df.collect()


def test_entry_has_rows(spark):
    assert catalog.entry(spark).count() > 0
