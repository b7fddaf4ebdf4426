"""Queries with an SQL form match DuckDB on the smallest tables."""
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_chat_format", "op2_bm25_top_k", "op3_pq_near_vectors", "op4_minhash_near_dedup",
                                  "op6_temperature_mixing", "op11_stratified_search"])
def test_matches_duckdb(spark, name):
    from collections import Counter

    from tarmac.llm.queries import ORACLE, QUERIES
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(r) for r in df.select(*cols).collect()) == Counter(res.fetchall())
