import duckdb
import pytest

from weftline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(name, spark, data):
    df = queries.QUERIES[name](spark, data)
    rows = df.collect()
    if name in queries.ORACLES:
        con = duckdb.connect()
        for t in ("contract_relationship", "event_embedding", "documents", "eval_item", "container_size"):
            con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
        cols = sorted(df.columns)
        rel = con.execute(queries.ORACLES[name])
        names = [d[0] for d in rel.description]
        assert sorted(names) == cols
        assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(tuple(r[names.index(c)] for c in cols) for r in rel.fetchall())


def test_columns(spark, data):
    want = {
        "p1_found": ["security_id", "group_id"],
        "p3_found": ["event_id_a", "event_id_b"],
        "p5_found": ["exchange_security_id_a", "exchange_security_id_b"],
        "p9_found": ["doc_id", "item_id"],
        "p10_found": ["doc_id", "sent_start", "sent_end"],
    }
    for name, cols in want.items():
        assert queries.QUERIES[name](spark, data).columns == cols
