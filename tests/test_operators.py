"""Edge cases of the building blocks on small inline frames."""

import math

from pyspark.sql import functions as F

from contrail.operators import bridge as B
from contrail.operators import clean as C
from contrail.operators import groups as G
from contrail.operators import ranking as R
from contrail.schemas import AIRLINES, CORRUPT_COL, EVENTS
from tests.conftest import rows

FL = "id long, callsign string, airline_icao string, on_ground int"


def test_argmax_global_keeps_ties_and_ignores_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, None)], "k long, v double")
    assert rows(R.argmax_global(df, "v")) == [(2, 7.0), (3, 7.0)]


def test_argmax_global_all_null_is_empty(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k long, v double")
    assert R.argmax_global(df, "v").count() == 0


def test_argmax_by_group_ties_and_null_group(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 3), ("a", 3, 1), ("b", 4, 9), (None, 5, 2), (None, 6, 1)],
                               "g string, k long, v long")
    assert rows(R.argmax_by_group(df, "v", "g")) == [("a", 1, 3), ("a", 2, 3), ("b", 4, 9), (None, 5, 2)]


def test_argmax_by_group_hot_group(spark):
    # one group holds most rows; the result is still exact
    hot = spark.range(0, 20000).select(F.lit("hot").alias("g"), F.col("id").alias("k"), (F.col("id") % 97).alias("v"))
    cold = spark.createDataFrame([("cold", 1, 5)], "g string, k long, v long")
    out = R.argmax_by_group(hot.unionByName(cold), "v", "g")
    assert out.where("g = 'hot'").count() == len([i for i in range(20000) if i % 97 == 96])
    assert rows(out.where("g = 'cold'")) == [("cold", 1, 5)]


def test_top_n_per_group_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("x", "m2", 5), ("x", "m1", 5), ("x", "m3", 5), ("x", "m4", 9), ("y", "m1", 1)],
                               "c string, m string, n long")
    out = R.top_n_per_group(df, "c", ["-n", "m"], 3)
    assert rows(out) == [("x", "m1", 5, 2), ("x", "m2", 5, 3), ("x", "m4", 9, 1), ("y", "m1", 1, 1)]


def test_top1_total_order(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "k string, n long")
    assert rows(R.top1(df, ["-n", "k"])) == [("a", 3)]


def test_exclude_flagged_groups_null_callsigns_form_one_group(spark):
    df = spark.createDataFrame([
        (1, "A", "K1", 0), (2, "A", "K1", 1),      # seen on the ground -> whole callsign dropped
        (3, "B", "K1", 0), (4, "B", "K2", 0),      # kept
        (5, None, "K1", 0), (6, None, "K2", 1),    # NULL callsigns: one grounded -> all dropped
    ], FL)
    assert rows(G.exclude_flagged_groups(df, "callsign").select("id")) == [(3,), (4,)]


def test_anti_join_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "B")], "id long, callsign string")
    other = spark.createDataFrame([("A",), (None,)], "callsign string")
    assert rows(G.anti_join(df, other, ["callsign"]).select("id")) == [(2,), (3,)]


def test_distinct_and_approx_counts(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 1000).alias("x"))
    exact = dict(G.distinct_count_by(df, "g", "x", "n").collect())
    approx = dict(G.approx_distinct_count_by(df, "g", "x", "n", rsd=0.02).collect())
    assert exact == {"0": 1000, "1": 1000, "2": 1000}
    assert all(abs(approx[k] - exact[k]) / exact[k] < 0.06 for k in exact)


def test_unique_by_key_prefers_smallest_order(spark):
    df = spark.createDataFrame([("AP1", "b", 1.0), ("AP1", "a", 2.0), ("AP2", "z", 3.0), (None, "n", 0.0)],
                               "code string, name string, lat double")
    assert rows(C.unique_by_key(df, ["code"], ["name"])) == [("AP1", "a", 2.0), ("AP2", "z", 3.0), (None, "n", 0.0)]
    assert rows(C.unique_by_key(df, ["code"], ["name"], descending=True))[0] == ("AP1", "b", 1.0)


def test_sentinels_nan_and_nulls(spark):
    df = spark.createDataFrame([(1, "N/A", 1.0), (2, "NaN", 2.0), (3, "K1", float("nan")), (4, None, 3.0),
                                (5, " None ", 4.0), (6, "K2", 5.0)], "id long, icao string, r double")
    norm = C.normalise_sentinels(df, ["icao", "r"])
    got = {r.id: (r.icao, r.r) for r in norm.collect()}
    assert got[1] == (None, 1.0) and got[2] == (None, 2.0) and got[3] == ("K1", None) and got[5][0] is None
    assert rows(C.drop_nullish(df, ["icao", "r"]).select("id")) == [(6,)]
    assert not any(isinstance(v, float) and math.isnan(v) for v in [r.r for r in norm.collect()])


def test_quarantine_routes_malformed_and_mistyped(spark, tmp_dir):
    lines = ['{"event_id": 1, "ts": "2024-01-01T00:00:00.000000", "user_id": 1, "event_type": "a", "value": 1.5}',
             '{"event_id": 2, "ts": "2024-01-01T00:00:0',                               # truncated
             '{"event_id": 3, "user_id": 1, "event_type": "a", "value": "oops"}',         # wrong type
             '{"user_id": 4, "event_type": "b", "value": 2.0}',                           # missing key
             '{}']                                                                        # empty record
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmp_dir)
    from contrail.sources.snapshots import read_snapshots
    raw = read_snapshots(spark, tmp_dir, EVENTS)
    good, bad = C.quarantine(raw, required=["event_id"])
    assert [r.event_id for r in good.collect()] == [1]
    assert bad.count() == 4 and CORRUPT_COL in bad.columns
    counts = dict(C.quarantine_status(raw, ["event_id"]).groupBy("status").count().collect())
    assert counts == {"accepted": 1, "quarantined": 4}


def test_bridge_prefers_icao_then_name_and_skips_unmatched(spark):
    airlines = spark.createDataFrame([("AA", "AAL", "American"), ("BA", "BAW", "British"),
                                      ("BA", "BAX", "Another BA"), ("ZZ", "AAL", "Zeta")], AIRLINES)
    flights = spark.createDataFrame([
        (1, "BA", "AAL", 0),   # IATA says BA, ICAO says AAL -> ICAO wins; two AAL airlines -> name asc
        (2, "BA", "N/A", 0),   # only IATA -> two BA airlines -> 'Another BA'
        (3, "XX", "XXX", 0),   # no match -> no row
        (4, "AA", "AAL", 1),   # grounded -> not in the bridge
    ], "id long, airline_iata string, airline_icao string, on_ground int")
    got = rows(B.airline_bridge(flights, airlines))
    assert got == [(1, "AA", "AAL", "American"), (2, "BA", "BAX", "Another BA")]
    assert rows(B.airline_bridge_by_union(flights, airlines)) == got
