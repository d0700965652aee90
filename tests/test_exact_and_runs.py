"""Exact geodesics, publication and directory of runs, zone documents, the quadtree, the streamed latest rows."""

import csv
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail import schemas as SCH
from contrail.functions.geodesic import geodesic_km
from contrail.operators.spatial import assign_zone
from contrail.plans import indicators as I
from contrail.plans.job import GOLD_ORDER, Inputs, run
from contrail.session import fresh_path, local_path
from contrail.sources import layers as L
from contrail.sources.snapshots import read_zone_docs, zone_nodes, zone_quarantine, zones_in_order
from contrail.streaming.latest import _deltas, read_latest, stream_latest

T0 = dt.datetime(2024, 5, 1, 8)


def lengths(spark, pairs):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pairs)], "i long, a double, b double, c double, d double")
    return [r[0] for r in df.select("i", geodesic_km("a", "b", "c", "d", digits=9).alias("km")).orderBy("i").select("km").collect()]


def vincenty(lat1, lon1, lat2, lon2):
    """The iterated inverse formula (diverges near the antipode), in metres."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2, l = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2, 0))
    l = lam = math.radians((lon2 - lon1 + 540) % 360 - 180)
    for _ in range(200):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sig, sa = math.atan2(ss, cs), math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2 = 1 - sa * sa
        cm = cs - 2 * math.sin(u1) * math.sin(u2) / c2 if c2 else 0
        k = f / 16 * c2 * (4 + f * (4 - 3 * c2))
        lam = l + (1 - k) * f * sa * (sig + k * ss * (cm + k * cs * (2 * cm * cm - 1)))
    u = c2 * (a * a - b * b) / (b * b)
    big, small = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))), u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    return b * big * (sig - small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))


def test_geodesic_against_published_values(spark):
    """Near-antipodal and antipodal pairs with published lengths; poles, equator, equal points."""
    got = lengths(spark, [(-30, 0, 29.9, 179.8), (0, 0, 0.5, 179.5), (0, 0, 0, 180), (90, 0, -90, 77), (0, 10, 0, 100), (12, 34, 12, 34), (0, -170, 0, 170), (45, 10, -45, -170)])
    want = [19989.83282761, 19936.288578965, 20003.931458625, 20003.931458625, 6378.137 * math.pi / 2, 0.0, 6378.137 * math.radians(20), 20003.931458625]
    assert all(abs(g - w) < 1e-5 for g, w in zip(got, want)), list(zip(got, want))


def test_geodesic_against_iteration(spark):
    rnd = random.Random(3)
    pairs = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(150)]
    pairs += [(x, y, x + rnd.uniform(-.01, .01), y + rnd.uniform(-.01, .01)) for x, y, *_ in pairs[:20]]
    want = [vincenty(*p) / 1000 for p in pairs]
    assert all(abs(g - w) < 1e-5 for g, w in zip(lengths(spark, pairs), want) if w < 19500)


def test_antipodal_winner(spark):
    """Of planted near-antipodal pairs the exact longest wins; the closed form picks another or none."""
    spots = {"A": (-30.0, 0.0), "B": (29.9, 179.8), "C": (30.0, 180.0), "D": (10.0, 20.0), "E": (-9.5, -160.5)}
    airports = spark.createDataFrame([(k, k, k, "x", *v, 0) for k, v in spots.items()], SCH.AIRPORTS)
    routes = [("A", "B"), ("A", "C"), ("D", "E"), ("A", "D")]
    flights = spark.createDataFrame([(i, "I", "K", f"c{i}", 0, o, d, "M", T0) for i, (o, d) in enumerate(routes)], SCH.FLIGHTS)
    got = I.q3_longest_active_route(flights, airports).collect()
    assert [(r.id, r.route_approx) for r in got] == [(1, False)] and abs(got[0].route_length - 20003.931) < 0.001


def test_failed_write_keeps_the_last_good_run(spark):
    path = fresh_path(spark, "runs")
    L.write_run(spark.range(5), path, T0)
    broken = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half way"):
        L.write_run(broken, path, T0)
    assert L.read_run(spark, path, T0).count() == 5
    L.write_run(spark.range(0), path, T0)
    assert L.read_run(spark, path, T0).count() == 0
    assert spark.read.parquet(path).count() == 0  # what was replaced is gone, also for plain readers
    with pytest.raises(FileNotFoundError):
        L.read_run(spark, path, T0 + dt.timedelta(hours=1))


def test_lookup_and_last_run_open_only_their_folders(spark):
    path, schema = fresh_path(spark, "runs"), spark.range(1).schema
    for k in range(6):
        L.write_run(spark.range(k + 1), path, T0 + dt.timedelta(hours=9 * k))
    L.write_run(spark.range(50), path, T0 + dt.timedelta(minutes=1))  # a second run of the first hour
    found = L.lookup(spark, path, schema, "2024-05-02", 11)
    assert found.count() == 4 and all("tech_hour=11" in f for f in found.inputFiles())
    assert L.lookup(spark, path, schema, "2024-05-01", 8).count() == 51 and L.lookup(spark, path, schema, "2023-01-01", 1).count() == 0
    last = lambda ts: L.last_run_before(spark, path, ts, schema)
    assert last(T0) is None and last(T0 + dt.timedelta(seconds=5)).count() == 1 and last(T0 + dt.timedelta(hours=9)).count() == 50
    assert last(T0 + dt.timedelta(days=400)).count() == 6 and len(last(T0 + dt.timedelta(days=400)).inputFiles()) <= 4


def test_zone_documents(spark, tmp_path):
    box = '"tl_y": 2, "tl_x": 1, "br_y": "1.5", "br_x": 3'
    files = {"a.json": '{\n "z": {%s, "subzones": {\n "y": {%s}, "b": {%s, "subzones": 5}}},\n "a": 7}' % (box, box, box), "b.json": '{"l1": {%s}}\n\n{broken\n[1]\n{"l2": {"tl_y": "north"}}\n' % box,
             "c.json": '{"d0": {%s, "subzones": {"d1": {%s, "subzones": {"d2": {%s}}}}}}' % (box, box, box), "d.json": ""}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    nodes = zone_nodes(read_zone_docs(spark, str(tmp_path)), max_depth=2)
    assert [(r.zone_name, r.zone_order) for r in zones_in_order(nodes).orderBy("zone_order").collect()] == [
        ("z", 0), ("y", 1), ("b", 2), ("l1", 3), ("d0", 4), ("d1", 5)]
    bad = zone_quarantine(nodes)
    assert dict(bad.dtypes)["node"] == "variant"
    assert sorted((r.file[-6:], r.path, r.problem) for r in bad.select("file", "path", "problem").collect()) == [
        ("a.json", "$.a", "not an object"), ("a.json", "$.z.subzones.b", "subzones is not an object"), ("b.json", "$", "not JSON"), ("b.json", "$", "not an object"),
        ("b.json", "$.l2", "tl_y is missing or no number"), ("c.json", "$.d0.subzones.d1", "deeper than 2 levels")]


def test_many_nested_boxes(spark):
    rng = np.random.default_rng(4)
    n, m = 100_000, 60
    depth, cx, cy = rng.random(n) ** 3 * 90, rng.choice([-100.0, 0.0, 60.0], n), rng.choice([-30.0, 10.0], n)
    boxes = np.stack([cx - depth, np.minimum(cy + depth / 2, 90), cx + depth, np.maximum(cy - depth / 2, -90)], 1)
    order = rng.permutation(n)
    pts = np.stack([rng.uniform(-180, 180, m), rng.uniform(-90, 90, m)], 1)
    pts[:6] = [(-100, -30), (0, 10), (60, 10), (180, 90), (-180, -90), (60.0001, -30)]
    zones = spark.createDataFrame([(f"z{i}", int(order[i]), *map(float, (b[1], b[0], b[3], b[2]))) for i, b in enumerate(boxes)], SCH.ZONES)
    points = spark.createDataFrame([(str(i), float(y), float(x)) for i, (x, y) in enumerate(pts)], "iata_code string, latitude double, longitude double")
    got = {r.iata_code: r.continent for r in assign_zone(points, zones).collect()}
    for i, (x, y) in enumerate(pts):
        hit = np.flatnonzero((boxes[:, 0] <= x) & (x <= boxes[:, 2]) & (boxes[:, 3] <= y) & (y <= boxes[:, 1]))
        assert got[str(i)] == (f"z{hit[np.argmax(order[hit])]}" if len(hit) else None)


def test_streamed_latest_survives_a_restart(spark):
    schema = "k string, ts timestamp, v long"
    land, table, ck = (fresh_path(spark, n) for n in ("land", "latest", "ck"))
    rows, rnd = [], random.Random(2)
    for lot in range(5):
        own = [(rnd.choice("abcdef"), T0 + dt.timedelta(minutes=rnd.randrange(900)), rnd.randrange(10**6)) for _ in range(40)] + [(None, T0, 1), ("x", None, 2)]
        rows += own
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").json(land)
        if lot in (1, 4):  # drained twice: a stop and a restart with the same checkpoint
            stream_latest(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(land), table, ck, "k", "ts", ["v"], compact_every=3)
    want = {k: max((t, v) for x, t, v in rows if x == k and t) for k in "abcdef"}
    got = {r.k: (r.ts, r.v) for r in read_latest(spark, table, spark.createDataFrame([], schema).schema, "k", "ts", ["v"]).collect()}
    assert got == want and len(_deltas(spark, table)) < 3


def test_gold_files_are_sorted(spark):
    from contrail.sources.fixtures import Tables
    t, base = Tables(spark, "/root/testdata/sf0.001"), fresh_path(spark, "gold_order")
    run(spark, Inputs(t.flights, t.airlines, t.airports, t.zones, t.models), base, T0, datasets=["country_aircraft_model", "average_flight_distance_by_continent"])
    for name in ("country_aircraft_model", "average_flight_distance_by_continent"):
        folder = L.published(spark, L.run_path(L.layer_path(base, "gold_csv", name), T0))
        import glob
        said = [r for f in sorted(glob.glob(local_path(folder) + "/part-*")) for r in csv.DictReader(open(f))]
        keys = [c.lstrip("-") for c in GOLD_ORDER[name]]
        own = [tuple(int(r[k]) if k == "rank" else r[k] for k in keys) for r in said]
        assert own == sorted(own) and len(own) > 1
