"""What runs are compared by (fields, profiles, sketches) and the ledger of the polling stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from contrail import schemas as SCH
from contrail.operators.groups import distinct_sketch_by, merged_distinct_by
from contrail.operators.profile import profile_change, profiled_write
from contrail.plans.job import Inputs
from contrail.session import fresh_path
from contrail.sources.drift import note_fields, read_rescued, schema_drift
from contrail.sources.fixtures import Tables
from contrail.sources.layers import layer_path, names_in, read_run, run_id, run_time
from contrail.sources.snapshots import JSON_OPTIONS
from tests.conftest import SF_SMALL

HOURS = [dt.datetime(2024, 1, 1, h) for h in range(3)]


def _land(spark, name, lines):
    path = fresh_path(spark, name)
    spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_run_ids_name_their_time():
    for ts in (dt.datetime(2024, 5, 1, 8, 0, 10), dt.datetime(2024, 5, 1, 8, 0, 10, 250)):
        assert run_time(run_id(ts)) == ts


def test_sketches_of_overlapping_runs_merge(spark):
    n = 40_000
    facts = spark.range(n).select((F.col("id") % 4).alias("run"), (F.col("id") % 1000 == 0).cast("string").alias("g"),
                                  F.when(F.col("id") % 7 != 0, (F.col("id") % 9001).cast("string")).alias("v"))
    by_run = distinct_sketch_by(facts, ["run", "g"], "v")
    got = {r.g: r.n for r in merged_distinct_by(by_run, "g", "n").collect()}
    want = {r.g: r.n for r in facts.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    assert set(got) == set(want)
    for g in want:
        assert abs(got[g] - want[g]) <= max(1, 0.025 * want[g])


def test_drift_between_runs(spark):
    path = fresh_path(spark, "fields")
    runs = [[{"a": 1, "b": "x", "c": None, "d": {"e": 1}, "f": [1]}, {"a": 2.5}, "{broken", "[1]", ""],
            [{"a": "one", "c": 3, "d": [1], "f": [2, "x"], "g": True}, {"a": 7}],
            [{"a": "one", "c": 3, "d": [1], "f": [2], "g": False}, {"a": 7}]]
    for ts, lines in zip(HOURS, runs):
        note_fields(spark, _land(spark, "landing", lines), path, ts)
    drift = lambda ts: {tuple(r) for r in schema_drift(spark, path, ts).collect()}
    assert drift(HOURS[0]) == set()  # no earlier run
    assert drift(HOURS[1]) == {("a", "retyped", "number", "mixed", 2), ("b", "vanished", "string", None, 1),
                               ("d", "retyped", "object", "array", 1), ("g", "new", None, "boolean", 1)}
    assert drift(HOURS[2]) == set()


def test_unknown_fields_are_kept(spark):
    land = _land(spark, "landing", [{"airline_icao": "K1", "alliance": {"name": "x", "since": 1997}}, {"airline_icao": "K2"}, "{broken"])
    rows = {r.airline_icao: r for r in read_rescued(spark, land, SCH.AIRLINES).withColumn(
        "since", F.variant_get("_rescued", "$.alliance.since", "int")).select("airline_icao", "since", SCH.CORRUPT_COL, F.col("_rescued").isNull().alias("none")).collect()}
    assert (rows["K1"].since, rows["K1"].none) == (1997, False)
    assert rows["K2"].none and rows["K2"][SCH.CORRUPT_COL] is None
    assert rows[None][SCH.CORRUPT_COL] == "{broken" and rows[None].none


def test_profile_of_a_write(spark):
    base = fresh_path(spark, "profiled")
    nan = float("nan")
    rows = [(float(i), "x") for i in range(101)] + [(None, "N/A"), (nan, None), (1e9, " ")]
    df = spark.createDataFrame(rows, "v double, s string")
    assert profiled_write(df, f"{base}/a", f"{base}/p", HOURS[0], {"v": (1, 1000)}) == 104
    assert profiled_write(df.where("false"), f"{base}/a", f"{base}/p", HOURS[1], {"v": (1, 1000)}) == 0
    first = {(r.column, r.metric): r.now for r in profile_change(spark, f"{base}/p", HOURS[0]).collect()}
    assert first[("v", "nulls")] == 1 and first[("v", "nans")] == 1
    assert first[("v", "out_of_range")] == 3  # 0, 1e9, and NaN, which is above every number
    assert first[("s", "nulls")] == 1 and first[("s", "sentinels")] == 2
    assert [first[("v", p)] for p in ("p25", "p50", "p75")] == [25.0, 50.0, 76.0]
    second = {(r.column, r.metric): (r.before, r.now) for r in profile_change(spark, f"{base}/p", HOURS[1]).collect()}
    assert second[("*", "rows")] == (104.0, 0.0) and second[("v", "p50")] == (50.0, None)


@pytest.fixture()
def polls(spark):
    t = Tables(spark, SF_SMALL)
    land, base, ck = (fresh_path(spark, n) for n in ("polls", "stream_runs", "ck"))
    flights = t.flights.limit(60).cache()

    def poll(second):
        flights.withColumn("snapshot_ts", F.lit(f"2024-05-01 08:00:{second:02d}").cast("timestamp_ntz")).coalesce(1) \
            .write.mode("append").options(**JSON_OPTIONS).json(land)

    def drain(zones=t.zones, checkpoint=ck, **more):
        from contrail.streaming.runs import stream_runs
        out = stream_runs(spark, land, Inputs(None, t.airlines, t.airports, zones, t.models), base, checkpoint,
                          datasets=more.pop("datasets", ["most_airlines"]), gold_formats=(), **more)
        return [tuple(r) for r in out.collect() if r.layer != "bronze"]

    yield poll, drain, base, flights.count()
    flights.unpersist()


def test_polls_close_by_later_polls_and_late_rows_open_them(spark, polls):
    poll, drain, base, n = polls
    poll(0)
    assert drain(flush=False) == []  # nothing later has landed
    poll(0)
    poll(10)
    assert [r[0] for r in drain(flush=False)] == ["20240501T080000"]  # both files, one run
    poll(0)
    got = drain()
    assert ("20240501T080000", "late", "flights", n, "ok") in got
    assert sorted(r[0] for r in got if r[1] == "silver") == ["20240501T080000", "20240501T080010"]
    flights = layer_path(base, "bronze", "flights")
    assert read_run(spark, flights, dt.datetime(2024, 5, 1, 8), SCH.FLIGHTS, parts=True).count() == 3 * n
    assert drain() == []
    # a new checkpoint reads every file again: each replaces its own rows
    drain(checkpoint=fresh_path(spark, "ck"))
    assert read_run(spark, flights, dt.datetime(2024, 5, 1, 8), SCH.FLIGHTS, parts=True).count() == 3 * n


def test_failed_datasets_of_a_poll_are_tried_again(spark, polls):
    poll, drain, base, _ = polls
    t = Tables(spark, SF_SMALL)
    broken = t.zones.withColumn("tl_y", F.raise_error(F.lit("broken feed")).cast("double"))
    wanted = ["most_airlines", "top_regional"]
    poll(0)
    assert {r[2]: r[4].split(":")[0] for r in drain(zones=broken, datasets=wanted)} == {"most_airlines": "ok", "top_regional": "failed"}
    assert names_in(spark, f"{base}/_polls/failed") == ["20240501T080000.top_regional"]
    assert [(r[2], r[4]) for r in drain(datasets=wanted)] == [("top_regional", "ok")]
    assert [n for n in names_in(spark, f"{base}/_polls/failed") if not n.startswith(".")] == []
    assert drain(datasets=wanted) == []
