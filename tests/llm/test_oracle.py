"""The queries that SQL expresses against that SQL."""

import duckdb
import pytest

from courtline.llm import catalog
from llm_util import collected

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    rel = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    at = [rel.columns.index(c) for c in df.columns]
    got = sorted(map(repr, (tuple(r.values()) for r in collected(df))))
    want = sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
    assert got == want
