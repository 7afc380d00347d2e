"""Every query of the package on the smallest tables, against its SQL where there is any."""

import os
from collections import Counter

import duckdb
import pytest

from plotmill.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    rows = Counter(tuple(map(str, (r[c] for c in sorted(df.columns)))) for r in df.collect())
    if name.endswith("_found"):
        assert max(rows.values()) == 1
    if name in ORACLES:
        got = con.execute(ORACLES[name])
        columns = [c[0] for c in got.description]
        order = sorted(range(len(columns)), key=lambda k: columns[k])
        assert sorted(columns) == sorted(df.columns)
        assert rows == Counter(tuple(str(r[k]) for k in order) for r in got.fetchall())
