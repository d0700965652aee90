"""Property checks on random small inputs (few examples: every example runs Spark jobs)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from contrail.operators.bridge import union_dedup
from contrail.operators.ranking import argmax_by_group
from contrail.plans.indicators import airport_flows
from contrail.schemas import FLIGHTS

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

groups = st.sampled_from(["a", "b", "c", None])
values = st.one_of(st.none(), st.integers(min_value=0, max_value=5))


@SETTINGS
@given(st.lists(st.tuples(groups, values), min_size=1, max_size=40))
def test_argmax_by_group_is_exact(spark, data):
    rows = [(g, i, v) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    best = {}
    for g, _, v in rows:
        if v is not None:
            best[g] = max(best.get(g, v), v)
    key = lambda r: (r[0] is None, str(r[0]), r[1])
    expected = sorted(((g, k, v) for g, k, v in rows if v is not None and v == best[g]), key=key)
    for method in ("join", "window"):
        got = sorted((tuple(r) for r in argmax_by_group(df, "v", "g", method=method).collect()), key=key)
        assert got == expected, method


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=20), max_size=30),
       st.lists(st.integers(min_value=0, max_value=20), max_size=30))
def test_union_dedup_keeps_one_row_per_key(spark, left, right):
    a = spark.createDataFrame([(k, 0, f"l{k}") for k in left], "id long, pref int, name string")
    b = spark.createDataFrame([(k, 1, f"r{k}") for k in right], "id long, pref int, name string")
    got = {r.id: (r.pref, r.name) for r in union_dedup([a, b], ["id"], ["pref", "name"]).collect()}
    assert set(got) == set(left) | set(right)
    assert all(v == ((0, f"l{k}") if k in left else (1, f"r{k}")) for k, v in got.items())


codes = st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D"]))


@SETTINGS
@given(st.lists(st.tuples(codes, codes), min_size=1, max_size=40))
def test_flows_conserve_ends(spark, ends):
    rows = [(i, "X", "K", "C", 0, o, d, None, None) for i, (o, d) in enumerate(ends)]
    got = {r.iata_code: (r.departures, r.arrivals) for r in airport_flows(spark.createDataFrame(rows, FLIGHTS)).collect()}
    dep = Counter(o for o, _ in ends if o is not None)
    arr = Counter(d for _, d in ends if d is not None)
    assert got == {c: (dep.get(c, 0), arr.get(c, 0)) for c in set(dep) | set(arr)}
    assert sum(v[0] for v in got.values()) - sum(v[1] for v in got.values()) == sum(dep.values()) - sum(arr.values())
