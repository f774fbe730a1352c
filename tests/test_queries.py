import math

import duckdb
import pytest

from loamline.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return None if math.isnan(v) else round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, db, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=str)
    result = db.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall()), key=str)
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
