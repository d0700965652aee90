"""Route length and zone assignment against brute-force Python references."""

import math
import random

import pytest
from pyspark.sql import functions as F

from contrail.functions.geo import WGS84_A_KM, WGS84_F, add_route_km, route_km
from contrail.operators.spatial import assign_zone


def vincenty_py(lat1, lon1, lat2, lon2, tol=1e-13, max_iter=1000):
    """Textbook iterative Vincenty inverse on WGS-84 (reference only), km."""
    a, f = WGS84_A_KM, WGS84_F
    b = a * (1 - f)
    u1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    u2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    big_l = math.radians(lon2 - lon1)
    lam = big_l
    su1, cu1, su2, cu2 = math.sin(u1), math.cos(u1), math.sin(u2), math.cos(u2)
    for _ in range(max_iter):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
        if ss == 0:
            return 0.0
        cs = su1 * su2 + cu1 * cu2 * cl
        sig = math.atan2(ss, cs)
        sa = cu1 * cu2 * sl / ss
        c2a = 1 - sa * sa
        c2m = cs - 2 * su1 * su2 / c2a if c2a else 0.0
        c = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        prev = lam
        lam = big_l + (1 - c) * f * sa * (sig + c * ss * (c2m + c * cs * (-1 + 2 * c2m * c2m)))
        if abs(lam - prev) < tol:
            break
    u = c2a * (a * a - b * b) / (b * b)
    ba = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    bb = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    ds = bb * ss * (c2m + bb / 4 * (cs * (-1 + 2 * c2m * c2m) - bb / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))
    return b * ba * (sig - ds)


@pytest.fixture(scope="module")
def pairs(spark):
    rnd = random.Random(7)
    data = [(rnd.uniform(-80, 80), rnd.uniform(-180, 180), rnd.uniform(-80, 80), rnd.uniform(-180, 180))
            for _ in range(400)]
    data += [(49.0097, 2.5479, 40.6413, -73.7781), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 90.0)]
    return data, spark.createDataFrame(data, "lat1 double, lon1 double, lat2 double, lon2 double")


def test_lambert_close_to_exact_geodesic(pairs):
    data, df = pairs
    got = add_route_km(df, "lat1", "lon1", "lat2", "lon2", "d").collect()
    for (la1, lo1, la2, lo2), r in zip(data, got):
        ref = vincenty_py(la1, lo1, la2, lo2)
        if ref < 15000:
            assert abs(r.d - ref) < 0.1, (la1, lo1, la2, lo2, r.d, ref)


def test_staged_equals_single_expression_and_vincenty5(pairs):
    data, df = pairs
    out = add_route_km(df, "lat1", "lon1", "lat2", "lon2", "staged")
    out = add_route_km(out, "lat1", "lon1", "lat2", "lon2", "v5", digits=None, method="vincenty5")
    out = out.select("staged", "v5", route_km("lat1", "lon1", "lat2", "lon2").alias("single")).collect()
    for (la1, lo1, la2, lo2), r in zip(data, out):
        assert r.staged == r.single
        ref = vincenty_py(la1, lo1, la2, lo2)
        if ref < 15000:
            assert abs(r.v5 - ref) < 0.01


def test_distance_properties(spark, pairs):
    _, df = pairs
    fwd = add_route_km(df, "lat1", "lon1", "lat2", "lon2", "ab")
    both = add_route_km(fwd, "lat2", "lon2", "lat1", "lon1", "ba")
    diag = add_route_km(df, "lat1", "lon1", "lat1", "lon1", "zero")
    assert both.where(F.abs(F.col("ab") - F.col("ba")) > 0.001).count() == 0
    assert both.where(F.col("ab") < 0).count() == 0
    assert diag.where(F.col("zero") != 0).count() == 0


def test_unknown_or_nan_coordinates_give_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0), (float("nan"), 1.0, 2.0, 3.0)],
                               "lat1 double, lon1 double, lat2 double, lon2 double")
    assert [r.d for r in add_route_km(df, "lat1", "lon1", "lat2", "lon2", "d").collect()] == [None, None]


ZONES = [("europe", 1, 72.0, -25.0, 35.0, 45.0),
         ("france", 3, 51.0, -5.0, 42.0, 8.0),       # inside europe, higher order wins
         ("pacific", 2, 30.0, 150.0, -30.0, -150.0),  # crosses the antimeridian
         ("empty", 4, 10.0, 10.0, 20.0, 20.0)]       # inverted box: matches nothing


def brute_zone(lat, lon, axes):
    best = None
    for name, order, tl_y, tl_x, br_y, br_x in ZONES:
        x, y = (lon, lat) if axes == "geographic" else (lat, lon)
        in_y = br_y <= y <= tl_y
        if axes == "geographic" and tl_x > br_x:
            in_x = x >= tl_x or x <= br_x
        else:
            in_x = tl_x <= x <= br_x
        if in_y and in_x and (best is None or order > best[1]):
            best = (name, order)
    return best[0] if best else None


@pytest.mark.parametrize("axes", ["geographic", "as_written"])
def test_zone_assignment_matches_brute_force(spark, axes):
    rnd = random.Random(3)
    pts = [(f"P{i}", rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(600)]
    pts += [("EDGE1", 35.0, -25.0), ("EDGE2", 0.0, 180.0), ("EDGE3", 0.0, -180.0), ("PARIS", 48.85, 2.35)]
    points = spark.createDataFrame(pts, "iata_code string, latitude double, longitude double")
    zones = spark.createDataFrame(ZONES, "zone_name string, zone_order int, tl_y double, tl_x double, "
                                         "br_y double, br_x double")
    got = {r.iata_code: r.continent for r in
           assign_zone(points, zones, axes=axes).collect()}
    assert len(got) == len(pts)
    for code, lat, lon in pts:
        assert got[code] == brute_zone(lat, lon, axes), (code, lat, lon)
    if axes == "geographic":
        assert got["PARIS"] == "france" and got["EDGE2"] == "pacific" and got["EDGE3"] == "pacific"


def test_junk_zone_box_is_clamped_to_the_globe(spark):
    pts = [("PARIS", 48.85, 2.35), ("NOWHERE", -80.0, 0.0)]
    points = spark.createDataFrame(pts, "iata_code string, latitude double, longitude double")
    zones = spark.createDataFrame([("world", 0, 1e10, -1e10, -1e10, 1e10), ("none", 1, None, None, None, None)],
                                  "zone_name string, zone_order int, tl_y double, tl_x double, br_y double, br_x double")
    assert {r.iata_code: r.continent for r in assign_zone(points, zones).collect()} == {"PARIS": "world", "NOWHERE": "world"}
