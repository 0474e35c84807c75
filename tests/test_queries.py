"""Every query against its SQL, on the smallest tables."""

import decimal

import duckdb
import pytest
from conftest import DATA
from tidewell.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/sf0.001/{t}.parquet')")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = lambda v: round(float(v), 6) if isinstance(v, float | decimal.Decimal) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


def pytest_generate_tests(metafunc):
    if "name" in metafunc.fixturenames:
        metafunc.parametrize("name", sorted(registry.queries()))


def test_query(spark, duck, name):
    df = registry.queries()[name](spark, f"{DATA}/sf0.001")
    got = rows(df.columns, df.collect())
    if name in registry.oracle_sql():
        r = duck.execute(registry.oracle_sql()[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows(names, r.fetchall())
