import math

import duckdb
import pytest

from uttera.plans.queries import oracle_sql, queries

TABLES = "orders events documents embeddings pages conversations".split()


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    rows = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    if name not in oracle_sql():
        assert len(set(df.columns)) == len(df.columns)
        return
    cur = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = [tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_entry_without_llm(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and set(oracle_sql()) <= set(__spark_entry__.queries())
