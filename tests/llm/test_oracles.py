"""Corpus queries against their SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_oracle import TABLES, rows
from rasterloom.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    cur = con.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cur.fetchall())


def test_all_thirteen_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
