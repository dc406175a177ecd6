"""Property checks of the text rules against DuckDB on random strings."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from geoweather.functions import damage_to_dollars, text_to_double, text_to_long
from geoweather.oracle import dollars, tlong

ALPHABET = "0123456789..eEkKmMbBhH+- "
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=7)), min_size=150, max_size=150)


def _duck(sql_expr: str, values):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"SELECT {sql_expr} FROM t ORDER BY i").fetchall()]


@settings(max_examples=4, deadline=None)
@given(texts)
def test_text_rules_match_duckdb(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").orderBy("i")
    out = df.select(
        damage_to_dollars("v").alias("d"), text_to_double("v").alias("x"), text_to_long("v").alias("l")
    ).collect()
    assert [r.d for r in out] == _duck(dollars("v"), values)
    assert [r.x for r in out] == _duck("TRY_CAST(v AS DOUBLE)", values)
    assert [r.l for r in out] == _duck(tlong("v"), values)
