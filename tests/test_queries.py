"""Every query with SQL gives the rows that DuckDB gives."""

import math
from pathlib import Path

import duckdb
import pytest

from recordflow.plans import load

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str([plain(v) for v in r]) for r in df.select(*columns).collect())
    rel = duck.execute(ORACLES[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == columns
    want = sorted(str([plain(r[names.index(c)]) for c in columns]) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count()
