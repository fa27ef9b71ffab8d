"""Queries of the subpackage with SQL, against that SQL."""

import pytest

from siftlane.llm import queries


def test_names_match():
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in ("parsed", "sources", "rule_sources", "documents"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = queries.queries()[name](spark, sf)
    want = db.sql(queries.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    text = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert text(got.select(columns).collect()) == text(want.select(*columns).fetchall())
