"""Every catalogue query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from lumenset.plans import catalogue, pixels, roundtrips  # noqa: F401  the latter two add to the catalogue

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no generated tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    def value(v):
        if v is None or v != v:
            return None
        if isinstance(v, float):
            return round(v, 6) + 0.0
        return int(v) if hasattr(v, "dtype") and v.dtype.kind in "iu" else str(v)

    return sorted(map(str, (tuple(map(value, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, str(DATA)).toPandas()
    want = duck.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_names_match():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert math.isfinite(len(catalogue.QUERIES))
