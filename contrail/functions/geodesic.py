"""Exact geodesic length on the WGS-84 ellipsoid as a native column, up to the exact antipode.

The inverse problem is solved for the departure azimuth on the auxiliary sphere. With the ends
ordered so that the first lies south and at least as far from the equator as the second, the
longitude that a geodesic has covered when it reaches the second parallel grows with the
azimuth, from 0 (due north) to 180 degrees (due south, over the pole), so bisection always
converges, also where the usual fixed-point iteration does not (near the antipode). Both
integrals, of longitude and of length, are Gauss-Legendre sums. What is left of the longitude
after the bisection is added as a step along the parallel, so a length is right to well below a millimetre.

The iteration runs per row inside one expression (higher-order functions, no Python worker), at
about a millisecond a row: compute it for the rows that need it, not for all.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, functions as F

# WGS-84 ellipsoid.
A_KM = 6378.137
FLAT = 1 / 298.257223563
B_KM = A_KM * (1 - FLAT)
EP2 = (A_KM**2 - B_KM**2) / B_KM**2

STEPS = 60  # halvings of 180 degrees: below the spacing of doubles
NODES = 16
#: Both ends on the equator: the first is moved south by this angle (micrometres), so that it has an azimuth.
OFF_EQUATOR = 1e-12


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _sum_over(integrand, lo: Column, hi: Column) -> Column:
    """The integral of ``integrand`` from ``lo`` to ``hi``."""
    nodes = F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in zip(*np.polynomial.legendre.leggauss(NODES))])
    return let(F.struct(((lo + hi) / 2).alias("mid"), ((hi - lo) / 2).alias("half")), lambda v: v["half"] * F.aggregate(
        nodes, F.lit(0.0), lambda s, x: s + x["w"] * integrand(v["mid"] + v["half"] * x["t"])))


def _path(ends: Column, azimuth: Column) -> Column:
    """The geodesic that leaves the first end at ``azimuth``, up to the second parallel: sine of the azimuth at the
    equator, k squared, arcs of both ends and the longitude covered on the sphere."""
    north = F.cos(azimuth) * ends["cos1"]
    sin0 = F.sin(azimuth) * ends["cos1"]
    north2 = F.sqrt(F.greatest(north * north + (ends["sin1"] - ends["sin2"]) * (ends["sin1"] + ends["sin2"]), F.lit(0.0)))
    return let(F.struct(north.alias("n1"), north2.alias("n2"), sin0.alias("sin0")), lambda v: F.struct(
        v["sin0"].alias("sin0"), (EP2 * (1 - v["sin0"] * v["sin0"])).alias("k2"),
        F.atan2(ends["sin1"], v["n1"]).alias("from"), F.atan2(ends["sin2"], v["n2"]).alias("to"),
        (F.atan2(v["sin0"] * ends["sin2"], v["n2"]) - F.atan2(v["sin0"] * ends["sin1"], v["n1"])).alias("turn")))


def _stretch(k2: Column, arc: Column) -> Column:
    return F.sqrt(1 + k2 * F.sin(arc) * F.sin(arc))


def _longitude(p: Column) -> Column:
    """Longitude covered on the ellipsoid."""
    return p["turn"] - FLAT * p["sin0"] * _sum_over(lambda arc: (2 - FLAT) / (1 + (1 - FLAT) * _stretch(p["k2"], arc)), p["from"], p["to"])


def _solved(ends: Column) -> Column:
    def halve(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        return let(F.struct(mid.alias("mid"), (let(_path(ends, mid), _longitude) > ends["lon"]).alias("over")), lambda v: F.struct(
            F.when(v["over"], s["lo"]).otherwise(v["mid"]).alias("lo"), F.when(v["over"], v["mid"]).otherwise(s["hi"]).alias("hi")))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("lo"), F.lit(math.pi).alias("hi")), halve,
                        lambda s: (s["lo"] + s["hi"]) / 2)
    return let(found, lambda azimuth: let(_path(ends, azimuth), lambda p: F.struct(
        (B_KM * _sum_over(lambda arc: _stretch(p["k2"], arc), p["from"], p["to"]) + A_KM * p["sin0"] * (ends["lon"] - _longitude(p))).alias("km"),
        azimuth.alias("azimuth"))))


def geodesic_km(lat1, lon1, lat2, lon2, digits: int | None = 3) -> Column:
    """Length of the shortest path in km; NULL if a coordinate is NULL or NaN, 0 for equal points."""
    coordinates = [c if isinstance(c, Column) else F.col(c) for c in (lat1, lon1, lat2, lon2)]
    u1, u2 = (F.atan((1 - FLAT) * F.tan(F.radians(c))) for c in coordinates[::2])
    lon = F.radians(F.abs(F.pmod(coordinates[3] - coordinates[1] + 180, F.lit(360.0)) - 180))
    further = F.abs(u1) >= F.abs(u2)
    first, second = F.when(further, u1).otherwise(u2), F.when(further, u2).otherwise(u1)

    def length(v: Column) -> Column:
        south = F.least(-F.abs(v["first"]), F.lit(-OFF_EQUATOR))
        other = F.when(v["first"] > 0, -v["second"]).otherwise(v["second"])
        ends = F.struct(F.sin(south).alias("sin1"), F.cos(south).alias("cos1"), F.sin(other).alias("sin2"), F.cos(other).alias("cos2"), v["lon"].alias("lon"))
        along_equator = (v["first"] == 0) & (v["lon"] <= math.pi * (1 - FLAT))
        return F.when(along_equator, A_KM * v["lon"]).otherwise(let(ends, lambda e: _solved(e)["km"]))

    known = coordinates[0].isNotNull()
    for c in coordinates:
        known = known & c.isNotNull() & ~F.isnan(c)
    km = F.when(known, let(F.struct(first.alias("first"), second.alias("second"), lon.alias("lon")), length))
    return F.round(km, digits) if digits is not None else km
