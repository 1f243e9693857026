import datetime as dt
import functools
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidewater.plans import registry

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture(scope="module", autouse=True)
def one_base():
    """The queries over the snapshot share the rows of one unranked snapshot, which the first of them makes."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(registry, "base", functools.cache(registry.base))
        yield


def plain(v):
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    mine = [tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    theirs = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in names)} FROM ({registry.ORACLE[name]}) q").fetchall()
    key = lambda r: [(v is None, str(v)) for v in r]
    mine, theirs = sorted(mine, key=key), sorted((tuple(plain(v) for v in r) for r in theirs), key=key)
    assert len(mine) == len(theirs)
    assert all(same(a, b) for r, s in zip(mine, theirs, strict=True) for a, b in zip(r, s, strict=True))


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
