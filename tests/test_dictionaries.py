from collections import Counter

from conftest import plan_text

from geoweather import derived
from geoweather.operators.dictionaries import (
    M_FLAGS,
    Q_FLAGS,
    decode_flags,
    element_names,
    flag_summary,
)

SF = "/root/testdata/sf0.001"


def test_dictionaries_have_unique_codes():
    for rows in (element_names(), M_FLAGS, Q_FLAGS):
        codes = [c for c, _ in rows]
        assert len(codes) == len(set(codes))
    assert dict(element_names())["WT01"].startswith("Weather type: Fog")
    assert len(M_FLAGS) == 10 and len(Q_FLAGS) == 15


def test_decode_keeps_rows_and_broadcasts(spark):
    obs = derived.observations(spark, SF)
    decoded = decode_flags(obs)
    plan = plan_text(decoded)
    assert plan.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in plan
    rows = decoded.collect()
    assert len(rows) == obs.count()
    q = dict(Q_FLAGS)
    for r in rows:
        assert r["q_flag_meaning"] == q[r["q_flag"] or ""]
        assert r["element_name"] == dict(element_names())[r["element"]]


def test_flag_summary_matches_brute_force(spark):
    obs = derived.observations(spark, SF).collect()
    want = Counter((r["element"], r["m_flag"], r["q_flag"]) for r in obs)
    with_value = Counter((r["element"], r["m_flag"], r["q_flag"]) for r in obs if r["data_value"] is not None)
    got = flag_summary(derived.observations(spark, SF)).collect()
    assert {(r["element"], r["m_flag"], r["q_flag"]): r["readings"] for r in got} == dict(want)
    assert {(r["element"], r["m_flag"], r["q_flag"]): r["with_value"] for r in got} == {k: with_value.get(k, 0) for k in want}
    m = dict(M_FLAGS)
    assert all(r["m_flag_meaning"] == m[r["m_flag"] or ""] for r in got)


def test_flag_summary_aggregates_before_decoding(spark):
    plan = plan_text(flag_summary(derived.observations(spark, SF)))
    assert "partial_count" in plan
    assert "SortMergeJoin" not in plan
    # the dictionary joins sit above the aggregate: the readings are not joined row by row
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")
