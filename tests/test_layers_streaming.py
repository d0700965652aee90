"""Round trips, restarts and streaming-vs-batch equivalence."""

import datetime as dt
import os

from pyspark.sql import functions as F

from contrail import schemas as SCH
from contrail.plans.job import Inputs, run
from contrail.session import fresh_path
from contrail.sources.fixtures import Tables
from contrail.sources.layers import lookup, read_layer, stamp_run, write_layer
from contrail.streaming.ingest import latest_per_key, stream_snapshots
from tests.conftest import SF_SMALL, rows

RUN_A = dt.datetime(2024, 5, 1, 8, 0)
RUN_B = dt.datetime(2024, 5, 1, 10, 0)


def test_dynamic_overwrite_keeps_other_runs_and_rerun_is_idempotent(spark, tmp_dir):
    f = Tables(spark, SF_SMALL).flights
    write_layer(stamp_run(f, RUN_A), tmp_dir)
    write_layer(stamp_run(f.where("on_ground = 0"), RUN_B), tmp_dir)
    write_layer(stamp_run(f.where("on_ground = 0"), RUN_B), tmp_dir)  # same run again
    back = read_layer(spark, tmp_dir, SCH.FLIGHTS)
    n = f.count()
    assert back.where(F.col("tech_hour") == 8).count() == n
    assert back.where(F.col("tech_hour") == 10).count() == f.where("on_ground = 0").count()
    assert dict((r[0], r[1]) for r in back.select("tech_month", "tech_day").distinct().collect()) == \
        {"2024-05": dt.date(2024, 5, 1)}


def test_lookup_prunes_partitions(spark, tmp_dir):
    f = Tables(spark, SF_SMALL).flights
    write_layer(stamp_run(f, RUN_A), tmp_dir)
    write_layer(stamp_run(f, RUN_B), tmp_dir)
    q = lookup(spark, tmp_dir, SCH.FLIGHTS, "2024-05-01", 10)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tech_day" in plan and "tech_hour" in plan
    assert q.count() == f.count()


def test_csv_and_json_gold_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("France", "A320", 3, 1), ("Japan", None, 1, 2)],
                               "country_origin string, aircraft_code string, count_model long, rank int")
    for fmt in ("csv", "json"):
        path = f"{tmp_dir}/{fmt}"
        write_layer(stamp_run(df, RUN_A), path, fmt)
        back = read_layer(spark, path, df.schema, fmt).select(*df.columns)
        assert rows(back) == rows(df)
        assert any(d.startswith("tech_year=2024") for d in os.listdir(path))


def _land(df, path, mode="overwrite"):
    from contrail.sources.snapshots import JSON_OPTIONS
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)


def test_stream_equals_batch_and_restart_is_exactly_once(spark):
    ev = Tables(spark, SF_SMALL).events
    land, sink, ck = (fresh_path(spark, n) for n in ("land", "sink", "ck"))
    _land(ev.where("event_id % 2 = 0"), land)
    stream_snapshots(spark, land, SCH.EVENTS, sink, ck, required=["event_id"], max_files_per_trigger=1)
    assert spark.read.parquet(sink).count() == ev.where("event_id % 2 = 0").count()
    # nothing new landed: a second scheduled run adds nothing
    stream_snapshots(spark, land, SCH.EVENTS, sink, ck, required=["event_id"])
    assert spark.read.parquet(sink).count() == ev.where("event_id % 2 = 0").count()
    # new files land: only they are processed
    _land(ev.where("event_id % 2 = 1"), land, mode="append")
    stream_snapshots(spark, land, SCH.EVENTS, sink, ck, required=["event_id"])
    got = spark.read.schema(SCH.EVENTS).parquet(sink)
    assert rows(got) == rows(ev)


def test_stream_dedup_drops_late_repeats(spark):
    ev = Tables(spark, SF_SMALL).events
    land, sink, ck = (fresh_path(spark, n) for n in ("land", "sink", "ck"))
    _land(ev, land)
    _land(ev.where("user_id % 3 = 0"), land, mode="append")
    stream_snapshots(spark, land, SCH.EVENTS, sink, ck, dedup_keys=["event_id", "ts"], ts_col="ts",
                     delay="3650 days", max_files_per_trigger=1)
    assert rows(spark.read.schema(SCH.EVENTS).parquet(sink)) == rows(ev)


def test_latest_per_key_hot_key(spark):
    df = spark.range(0, 30000).select((F.when(F.col("id") < 20000, 1).otherwise(F.col("id") % 5)).alias("k"),
                                      (F.col("id") % 1000).alias("ts"), F.col("id").alias("v"))
    got = dict((r.k, (r.ts, r.v)) for r in latest_per_key(df, "k", "ts", ["v"]).collect())
    assert got[1] == (999, 19999)


def test_run_isolates_failures_and_reruns(spark):
    t = Tables(spark, SF_SMALL)
    broken_models = t.models.select(F.col("aircraft_code").alias("code"), "manufacturer")  # wrong column name
    base = fresh_path(spark, "scheduled_run")
    st = {(r.layer, r.dataset): (r.rows, r.status) for r in
          run(spark, Inputs(t.flights, t.airlines, t.airports, t.zones, broken_models), base, RUN_A).collect()}
    assert st[("silver", "manufacturer_leader")][1].startswith("failed")
    assert st[("silver", "most_airlines")] == (1, "ok")
    assert st[("gold_csv", "country_aircraft_model")][1] == "ok"
    # same run again: same row counts (dynamic overwrite of the run's own partitions)
    st2 = {(r.layer, r.dataset): r.rows for r in
           run(spark, Inputs(t.flights, t.airlines, t.airports, t.zones, t.models), base, RUN_A).collect()}
    assert st2[("bronze", "flights")] == st[("bronze", "flights")][0]
    assert spark.read.parquet(f"{base}/silver/most_airlines").count() == 1
    # same run with nothing airborne: nothing old stays, and an empty result is not a failure
    empty = Inputs(t.flights.limit(0), t.airlines, t.airports, t.zones)
    st3 = {(r.layer, r.dataset): (r.rows, r.status) for r in run(spark, empty, base, RUN_A).collect()}
    assert st3[("silver", "most_airlines")] == (0, "ok") and st3[("gold_csv", "most_airlines")] == (0, "ok")
    assert st3[("silver", "manufacturer_leader")][1] == "skipped"
    assert spark.read.parquet(f"{base}/silver/most_airlines").count() == 0


def test_missing_source_falls_back_and_stops_only_its_datasets(spark):
    t = Tables(spark, SF_SMALL)
    base = fresh_path(spark, "fallback")
    st = {(r.layer, r.dataset): r.status for r in
          run(spark, Inputs(t.flights, t.airlines, t.airports, None), base, RUN_A, gold_formats=()).collect()}
    assert st[("bronze", "zones")] == "missing" and st[("silver", "top_regional")].startswith("failed")
    assert st[("silver", "most_airlines")] == st[("silver", "find_longest_flight")] == "ok"
    run(spark, Inputs(t.flights, t.airlines, t.airports, t.zones), base, RUN_A, gold_formats=())
    st = {(r.layer, r.dataset): r.status for r in
          run(spark, Inputs(t.flights, t.airlines, t.airports, None), base, RUN_B, gold_formats=()).collect()}
    assert st[("bronze", "zones")] == "fallback" and st[("silver", "top_regional")] == "ok"


def test_run_from_landing_end_to_end(spark):
    from contrail.plans.job import run_from_landing
    from contrail.sources.snapshots import JSON_OPTIONS
    t = Tables(spark, SF_SMALL)
    landing = fresh_path(spark, "landing")
    f = t.flights
    line = F.to_json(F.struct(*f.columns), JSON_OPTIONS)
    # every 40th flight lands truncated
    f.select(F.when(F.col("id") % 40 == 0, F.substring(line, 1, 15)).otherwise(line).alias("value")) \
        .write.text(f"{landing}/flights")
    t.airlines.write.options(**JSON_OPTIONS).json(f"{landing}/airlines")
    t.airports.select(*[F.col(c).cast("string") for c in t.airports.columns]).write.json(f"{landing}/airports")
    zones = t.zones.select(F.to_json(F.create_map("zone_name", F.struct("tl_y", "tl_x", "br_y", "br_x"))).alias("value"))
    zones.write.text(f"{landing}/zones")
    base = fresh_path(spark, "job")
    st = {(r.layer, r.dataset): (r.rows, r.status) for r in run_from_landing(spark, landing, base, RUN_A).collect()}
    bad = f.where(F.col("id") % 40 == 0).count()
    assert st[("quarantine", "flights")] == (bad, "ok")
    assert st[("bronze", "flights")] == (f.count() - bad, "ok")
    assert ("quarantine", "aircraft_models") not in st  # optional input absent
    assert st[("silver", "most_airlines")][1] == "ok" and st[("gold_csv", "top_regional")][1] == "ok"


def test_stream_runs_one_run_per_poll_across_restarts(spark):
    from contrail.sources.snapshots import JSON_OPTIONS
    from contrail.streaming.runs import stream_runs
    t = Tables(spark, SF_SMALL)
    f = t.flights
    land, base, ck = (fresh_path(spark, n) for n in ("polls", "stream_runs", "ck"))
    dims = Inputs(None, t.airlines, t.airports, t.zones, t.models)

    def land_poll(ts):  # the collector lands one poll as one file
        f.withColumn("snapshot_ts", F.lit(ts).cast("timestamp_ntz")).coalesce(1) \
            .write.mode("append").options(**JSON_OPTIONS).json(land)

    # two polls of one hour, ten seconds apart, one of them landed in two files over two batches
    land_poll("2024-05-01 08:00:00")
    land_poll("2024-05-01 08:00:10")
    stream_runs(spark, land, dims, base, ck, datasets=["most_airlines"], gold_formats=(), max_files_per_trigger=1)
    land_poll("2024-05-01 08:00:10")
    land_poll(None)
    stream_runs(spark, land, dims, base, ck, datasets=["most_airlines"], gold_formats=())
    bronze = spark.read.option("recursiveFileLookup", "true").schema(SCH.FLIGHTS).parquet(f"{base}/bronze/flights")
    n = f.count()
    per_poll = {str(r[0]): r[1] for r in bronze.groupBy("snapshot_ts").count().collect()}
    assert per_poll == {"2024-05-01 08:00:00": n, "2024-05-01 08:00:10": 2 * n}
    assert spark.read.parquet(f"{base}/quarantine/flights").count() == n  # polls without a time
    silver = spark.read.parquet(f"{base}/silver/most_airlines")
    assert sorted(r[0] for r in silver.select("tech_run").collect()) == ["20240501T080000", "20240501T080010"]
