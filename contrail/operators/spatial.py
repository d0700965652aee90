"""Point-in-box zone assignment (airports -> continent).

The zones are covered by quadtree cells that fit them: a box goes to the level whose cells are
just as large as its longer side or larger, so it touches at most four cells there, whatever its
size (a box over the antimeridian is two). A point lies in one cell of every level. The two meet in an **equi-join on
(level, cell)** followed by the exact box test; the highest ``zone_order`` wins. Small boxes are only ever
compared with points near them, and large ones do not multiply.

Axes: ``geographic`` reads x as longitude and y as latitude and lets a box whose
``tl_x > br_x`` wrap over the antimeridian; ``as_written`` compares latitude with the
x bounds and longitude with the y bounds and never wraps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LEVELS = 20  # the finest cells are about 40 m wide
GLOBE = 180.0


def _point_xy(points: DataFrame, lat: str, lon: str, axes: str) -> tuple[Column, Column]:
    if axes == "geographic":
        return F.col(lon), F.col(lat)
    if axes == "as_written":
        return F.col(lat), F.col(lon)
    raise ValueError(f"unknown axes {axes!r}")


def _inside(px: Column, py: Column, wrap: bool) -> Column:
    in_y = (py >= F.col("_br_y")) & (py <= F.col("_tl_y"))
    straight = (px >= F.col("_tl_x")) & (px <= F.col("_br_x"))
    if not wrap:
        return in_y & straight
    wrapped = (F.col("_tl_x") > F.col("_br_x")) & ((px >= F.col("_tl_x")) | (px <= F.col("_br_x")))
    return in_y & (straight | wrapped)


def _share(v: str) -> str:
    """Place on an axis from 0 to 1 (SQL text); what lies beyond the globe counts as its edge."""
    return f"((greatest(least({v}, {GLOBE}D), -{GLOBE}D) + {GLOBE}D) / {2 * GLOBE}D)"


def _cell(share: str, level: str) -> str:
    return f"least(floor({share} * pow(2.0D, {level})), cast(pow(2.0D, {level}) AS bigint) - 1)"


def zone_cells(zones: DataFrame, wrap: bool) -> DataFrame:
    """The zones with a row per cell they touch: ``_level, _cx, _cy`` (at most four, eight over the antimeridian).
    Boxes with ends in the wrong order or NaN corners have none; one with a NULL corner never passes the exact test."""
    side = lambda lo, hi: f"struct({_share(lo)} AS lo, {_share(hi)} AS hi)"
    x = f"array({side('tl_x', 'br_x')})"
    if wrap:
        x = f"CASE WHEN tl_x > br_x THEN array({side('tl_x', f'{GLOBE}D')}, {side(f'-{GLOBE}D', 'br_x')}) ELSE {x} END"
    z = zones.selectExpr("zone_name AS _zone", "zone_order AS _zorder", *[f"{c} AS _{c}" for c in ("tl_x", "tl_y", "br_x", "br_y")],
                         f"{side('br_y', 'tl_y')} AS _y", f"explode({x}) AS _x")
    ends = ("_x.lo", "_x.hi", "_y.lo", "_y.hi")
    z = z.where("_x.lo <= _x.hi AND _y.lo <= _y.hi AND " + " AND ".join(f"NOT isnan({e})" for e in ends))
    z = z.selectExpr("*", f"cast(least(floor(-log2(greatest(_x.hi - _x.lo, _y.hi - _y.lo, {2.0 ** -LEVELS!r}D))), {LEVELS}) AS int) AS _level")
    reach = lambda a: f"explode(sequence({_cell(f'{a}.lo', '_level')}, {_cell(f'{a}.hi', '_level')}))"
    return z.selectExpr("*", f"{reach('_x')} AS _cx").selectExpr("*", f"{reach('_y')} AS _cy").drop("_x", "_y")


def assign_zone(points: DataFrame, zones: DataFrame, key: str = "iata_code", lat: str = "latitude",
                lon: str = "longitude", out: str = "continent", axes: str = "geographic") -> DataFrame:
    """Adds column ``out``: name of the highest-``zone_order`` zone containing the point (equal orders: the
    first name), NULL if none.

    ``key`` must be unique in ``points`` (see ``unique_by_key``); it bounds every window
    partition below by the number of overlapping zones.
    """
    wrap = axes == "geographic"
    px, py = _point_xy(points, lat, lon, axes)
    cells = zone_cells(zones, wrap)
    # Only the key and the place of a point meet the zones; the best zone comes back by key.
    place = points.select(F.col(key).alias("_key"), px.alias("_px"), py.alias("_py"), F.expr(f"explode(sequence(0, {LEVELS}))").alias("_plevel"))
    met = place.selectExpr("*", *[f"{_cell(_share(f'_p{a}'), '_plevel')} AS _pc{a}" for a in "xy"]).join(
        cells, (F.col("_plevel") == F.col("_level")) & (F.col("_pcx") == F.col("_cx")) & (F.col("_pcy") == F.col("_cy"))
        & _inside(F.col("_px"), F.col("_py"), wrap))
    w = Window.partitionBy("_key").orderBy(F.col("_zorder").desc_nulls_last(), F.col("_zone").asc_nulls_last())
    best = met.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select("_key", F.col("_zone").alias(out))
    return points.join(best, F.col(key) == F.col("_key"), "left").drop("_key")
