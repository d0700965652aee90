"""Work that must grow no faster than the tables: airlines that share codes, polls of many rows."""

from pyspark.sql import functions as F

from contrail import schemas as SCH
from contrail.operators import bridge as B
from contrail.plans import registry_io
from contrail.plans.catalog import QUERIES
from contrail.sources.snapshots import JSON_OPTIONS
from contrail.streaming import runs
from tests.conftest import SF_SMALL, rows


def test_a_flight_has_two_candidates_however_many_airlines_share_its_codes(spark, monkeypatch):
    flights = spark.createDataFrame([(i % 90, "I1" if i % 3 else None, "K1" if i % 2 else "K9", None, 0, None, None, None, None)
                                     for i in range(100)] + [(None, "I1", "K1", None, 0, None, None, None, None)], SCH.FLIGHTS)
    airlines = spark.createDataFrame([("I1", "K1", f"name {i:04d}") for i in range(2000)] * 2 + [(None, "K1", None), ("I1", None, "a"), (None, None, "b")], SCH.AIRLINES)
    seen, dedup = [], B.union_dedup
    monkeypatch.setattr(B, "union_dedup", lambda frames, *a: seen.append(sum(f.count() for f in frames)) or dedup(frames, *a))
    got = B.airline_bridge_by_union(flights, airlines)
    assert rows(got) == rows(B.airline_bridge(flights, airlines)) and got.count() > 0
    assert 0 < seen[0] <= 2 * 100


def test_a_large_poll_lands_in_many_files_and_runs_once(spark, monkeypatch):
    lands, sessions, land_batch, fresh = [], [], runs._land_batch, registry_io.fresh_path

    def noted(s, name):
        path = fresh(s, name)
        if name == "landing/polls":
            lands.append(path)
        return path

    monkeypatch.setattr(registry_io, "POLL_FILE_ROWS", 250)
    monkeypatch.setattr(registry_io, "fresh_path", noted)
    monkeypatch.setattr(runs, "_land_batch", lambda *a: sessions.append(a[1].select("part").distinct().count()) or land_batch(*a))
    got = QUERIES["stream_runs"](spark, SF_SMALL)
    assert sorted((r.poll, r.value) for r in got.where("dataset = 'runs'").collect()) == [(0, 1.0), (1, 1.0), (2, 1.0)]
    # 1 500 orders, so two files for the first and last poll and thrice as many, in three micro-batches, for the second
    polls = spark.read.schema(SCH.FLIGHTS).options(**JSON_OPTIONS).json(lands[0])
    files = {str(r[0])[-2:]: r[1] for r in polls.groupBy("snapshot_ts").agg(F.count_distinct(F.col("_metadata.file_path"))).collect()}
    assert files == {"00": 2, "10": 6, "20": 2}
    assert sessions == [2] * 5
    # the setting of the writes is the stream's alone
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
