import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else "") for x in row)


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 25


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:5] == ["zipcode", "date", "year", "month", "day"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    exp = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in rel.fetchall()), key=_key)
    assert got == exp
