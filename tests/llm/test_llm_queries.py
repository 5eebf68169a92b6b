"""Registered queries of the operators against their SQL."""

import duckdb
import pytest

from tessera.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages", "documents", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = registry.queries()[name](spark, sf_dir)
    rel = con.sql(registry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    want = sorted([tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall()], key=key)
    assert sorted([tuple(r[c] for c in columns) for r in df.collect()], key=key) == want
