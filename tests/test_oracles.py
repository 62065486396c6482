"""Every registered query of the engine against its SQL on the smallest tables."""

import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from pelagia.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in registry.ORACLE_SQL:
        result = duck.execute(registry.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns)
        theirs = sorted((tuple(plain(v) for _, v in sorted(zip(names, r, strict=True))) for r in result.fetchall()), key=place)
        ours = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in rows), key=place)
        assert len(ours) == len(theirs)
        for mine, other in zip(ours, theirs, strict=True):
            assert all(same(a, b) for a, b in zip(mine, other, strict=True)), (mine, other)


def place(row):
    """Rows in order by all but their numbers' last digits."""
    return repr([float(f"{v:.4g}") if isinstance(v, float) else v for v in row])


def same(a, b):
    """Equal, or numbers that differ by no more than the order of a sum and one unit of the sixth decimal."""
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1.01e-6))


def test_contract(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(registry.QUERIES) <= set(queries) and set(sql) <= set(queries)
    assert __spark_entry__.entry(spark).columns == ["label", "iy", "ix", "value", "levels"]
