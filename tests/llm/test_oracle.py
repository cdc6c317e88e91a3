import duckdb

from ragloom.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


def duck_rows(name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.execute(queries.SQL[name])
    cols = [d[0] for d in rel.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(r[i] for i in order) for r in rel.fetchall())


def test_every_operator_is_registered():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1
    assert set(queries.SQL) <= set(queries.QUERIES)
