"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check_oracle import TABLES, rows
from rasterloom.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.load()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, cur.fetchall())
