"""Query registry: one entry per operator / indicator, each with its oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``. Every query
reads whole driver tables (through the fixture views) so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.functions.columns import run_columns
from contrail.operators import bridge as B
from contrail.operators import clean as C
from contrail.operators import groups as G
from contrail.operators import ranking as R
from contrail.plans import indicators as I
from contrail.plans.oracle import with_ctes
from contrail.sources.fixtures import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Zone names the reference keeps at ingestion.
REFERENCE_ZONES = ["oceania", "asia", "africa", "atlantic", "northatlantic", "europe"]


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ projections & cleaning

@register("active_flights", with_ctes("fx_flights") + """
SELECT id, callsign, airline_icao, origin_airport_iata, destination_airport_iata
FROM fx_flights WHERE on_ground = 0""")
def _active(t: Tables) -> DataFrame:
    return C.active_flights(t.flights, ["id", "callsign", "airline_icao", "origin_airport_iata",
                                        "destination_airport_iata"])


@register("clean_nullish", with_ctes("fx_flights") + """
SELECT id, airline_icao, aircraft_code, destination_airport_iata FROM fx_flights
WHERE airline_icao IS NOT NULL AND trim(airline_icao) NOT IN ('N/A', 'NaN', 'None', '')
  AND aircraft_code IS NOT NULL AND trim(aircraft_code) NOT IN ('N/A', 'NaN', 'None', '')
  AND destination_airport_iata IS NOT NULL
  AND trim(destination_airport_iata) NOT IN ('N/A', 'NaN', 'None', '')""")
def _clean(t: Tables) -> DataFrame:
    f = C.normalise_sentinels(t.flights, ["airline_icao", "aircraft_code", "destination_airport_iata"])
    f = C.drop_nullish(f, ["airline_icao", "aircraft_code", "destination_airport_iata"])
    return f.select("id", "airline_icao", "aircraft_code", "destination_airport_iata")


@register("run_columns", with_ctes("fx_flights") + """
SELECT id, CAST(year(snapshot_ts) AS INTEGER) AS tech_year, strftime(snapshot_ts, '%Y-%m') AS tech_month,
       CAST(snapshot_ts AS DATE) AS tech_day, CAST(hour(snapshot_ts) AS INTEGER) AS tech_hour
FROM fx_flights""")
def _run_columns(t: Tables) -> DataFrame:
    return t.flights.select("id", *[c.alias(n) for n, c in run_columns(F.col("snapshot_ts")).items()])


@register("zone_filter", with_ctes("fx_zones") + f"""
SELECT zone_name, zone_order, tl_y, tl_x, br_y, br_x FROM fx_zones
WHERE zone_name IN ({", ".join(repr(z) for z in REFERENCE_ZONES)})""")
def _zone_filter(t: Tables) -> DataFrame:
    return C.zone_filter(t.zones, REFERENCE_ZONES)


_DUP_AIRPORTS = """
SELECT iata_code, icao_code, name, country, latitude, longitude, altitude FROM fx_airports
UNION ALL
SELECT iata_code, concat(icao_code, 'X') AS icao_code, lower(name) AS name, country, latitude, longitude,
       altitude FROM fx_airports"""


@register("unique_airports", with_ctes("fx_airports") + f"""
SELECT iata_code, icao_code, name, country, latitude, longitude, altitude FROM (
  SELECT *, row_number() OVER (PARTITION BY iata_code ORDER BY name, icao_code) AS rn
  FROM ({_DUP_AIRPORTS}) d) t WHERE rn = 1""")
def _unique_airports(t: Tables) -> DataFrame:
    ap = t.airports
    dup = ap.unionByName(ap.withColumns({"icao_code": F.concat("icao_code", F.lit("X")),
                                         "name": F.lower("name")}))
    return I.unique_airports(dup)


@register("distinct_rows", with_ctes("fx_flights") + """
SELECT DISTINCT origin_airport_iata, destination_airport_iata, aircraft_code FROM fx_flights""")
def _distinct_rows(t: Tables) -> DataFrame:
    return C.distinct_rows(t.flights, ["origin_airport_iata", "destination_airport_iata", "aircraft_code"])


# ------------------------------------------------------------------ group exclusion / distinct

@register("exclude_flagged_groups", with_ctes("grounded") + """
SELECT id, callsign, on_ground FROM fx_flights f
WHERE NOT EXISTS (SELECT 1 FROM grounded g WHERE g.callsign IS NOT DISTINCT FROM f.callsign)""")
def _exclude(t: Tables) -> DataFrame:
    return G.exclude_flagged_groups(t.flights, "callsign").select("id", "callsign", "on_ground")


@register("anti_join", with_ctes("fx_flights") + """
SELECT id, callsign FROM fx_flights f
WHERE on_ground = 0
  AND NOT EXISTS (SELECT 1 FROM fx_flights g WHERE g.on_ground = 1 AND g.callsign = f.callsign)""")
def _anti(t: Tables) -> DataFrame:
    f = t.flights
    grounded = f.where(F.col("on_ground") == 1).select("callsign")
    return G.anti_join(C.active_flights(f, ["id", "callsign"]), grounded, ["callsign"])


@register("distinct_callsigns", with_ctes("callsigns") + "SELECT * FROM callsigns")
def _distinct_callsigns(t: Tables) -> DataFrame:
    return I.distinct_callsigns(t.flights)


@register("approx_callsigns", with_ctes("callsigns") + "SELECT airline_icao, true AS within_error FROM callsigns")
def _approx_callsigns(t: Tables) -> DataFrame:
    """Whether each estimate lies within three standard errors (2 %) of the exact count."""
    exact = I.distinct_callsigns(t.flights).withColumnRenamed("number_of_flights", "exact")
    near = F.abs(F.col("number_of_flights") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * 0.02 * F.col("exact"))
    return exact.join(I.approx_callsigns(t.flights, 0.02), "airline_icao").select("airline_icao", near.alias("within_error"))


@register("q1_airline_most_active", with_ctes("callsigns", "fx_airlines") + """
SELECT t.airline_icao, a.airline_name AS name, t.number_of_flights
FROM (SELECT * FROM callsigns ORDER BY number_of_flights DESC, airline_icao ASC LIMIT 1) t
LEFT JOIN (SELECT airline_icao, min(airline_name) AS airline_name FROM fx_airlines
           WHERE airline_icao IS NOT NULL GROUP BY airline_icao) a ON t.airline_icao = a.airline_icao""")
def _q1(t: Tables) -> DataFrame:
    return I.q1_airline_most_active(t.flights, t.airlines)


# ------------------------------------------------------------------ ranking

@register("argmax_global", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice = (SELECT max(l_extendedprice) FROM lineitem)""")
def _argmax_global(t: Tables) -> DataFrame:
    li = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return R.argmax_global(li, "l_extendedprice")


@register("argmax_by_group", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rk
  FROM orders WHERE o_totalprice IS NOT NULL) t WHERE rk = 1""")
def _argmax_by_group(t: Tables) -> DataFrame:
    o = t.raw("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.argmax_by_group(o, "o_totalprice", "o_custkey")


@register("models_per_country", with_ctes("mpc") + "SELECT * FROM mpc")
def _mpc(t: Tables) -> DataFrame:
    return I.models_per_country(t.flights, t.airports)


@register("q6_top3_models_by_country", with_ctes("mpc") + """
SELECT country_origin, aircraft_code, count_model, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY country_origin
                                    ORDER BY count_model DESC, aircraft_code ASC) AS INTEGER) AS rank
  FROM mpc) t WHERE rank <= 3""")
def _q6(t: Tables) -> DataFrame:
    return I.q6_top3_models_by_country(t.flights, t.airports)


@register("q6_top3_models_by_airline_country", with_ctes("fx_flights", "fx_airline_homes") + """
SELECT country_origin, aircraft_code, count_model, rank FROM (
  SELECT country_origin, aircraft_code, CAST(count(*) AS BIGINT) AS count_model,
         CAST(row_number() OVER (PARTITION BY country_origin ORDER BY count(*) DESC, aircraft_code ASC) AS INTEGER) AS rank
  FROM fx_flights f JOIN (SELECT airline_icao, min(country) AS country_origin FROM fx_airline_homes GROUP BY airline_icao) h
    ON f.airline_icao = h.airline_icao
  WHERE aircraft_code IS NOT NULL AND country_origin IS NOT NULL
  GROUP BY country_origin, aircraft_code) t WHERE rank <= 3""")
def _q6_airline(t: Tables) -> DataFrame:
    return I.q6_top3_models_by_country(t.flights, None, country_of="airline", airlines=t.airline_homes)


# ------------------------------------------------------------------ geo

@register("continent_assign", with_ctes("cont") + "SELECT * FROM cont")
def _continent_assign(t: Tables) -> DataFrame:
    return I.continent_assign(t.airports, t.zones)


@register("continent_assign_broadcast", with_ctes("cont") + "SELECT * FROM cont")
def _continent_assign_b(t: Tables) -> DataFrame:
    return I.continent_assign(t.airports, t.zones)  # kept name; one physical form


@register("route_length", with_ctes("routes") + """
SELECT id, origin_airport_iata, destination_airport_iata, route_length, route_length > 18000.0 AS route_approx
FROM routes""")
def _route_length(t: Tables) -> DataFrame:
    return I.route_length(t.flights, t.airports)


@register("q3_longest_active_route", with_ctes("exact_pairs") + """
SELECT f.id, f.aircraft_code, f.airline_icao, f.callsign, p.km AS route_length, false AS route_approx
FROM fx_flights f JOIN exact_pairs p ON f.origin_airport_iata = p.o AND f.destination_airport_iata = p.d
WHERE f.on_ground = 0 AND p.km = (SELECT max(km) FROM exact_pairs)""")
def _q3(t: Tables) -> DataFrame:
    return I.q3_longest_active_route(t.flights, t.airports)


@register("q4_avg_route_by_continent", with_ctes("routes", "cont") + """
SELECT c.continent AS origin_continent, round(avg(r.route_length), 6) AS average_route_distance
FROM routes r JOIN cont c ON r.origin_airport_iata = c.iata_code
WHERE r.route_length IS NOT NULL AND NOT isnan(r.route_length) AND c.continent IS NOT NULL
GROUP BY c.continent""")
def _q4(t: Tables) -> DataFrame:
    return I.q4_avg_route_by_continent(t.flights, t.airports, t.zones)


@register("regional_flights", with_ctes("regional") + "SELECT * FROM regional")
def _regional(t: Tables) -> DataFrame:
    return I.regional_flights(t.flights, t.airports, t.zones)


# ------------------------------------------------------------------ bridge & Q2

@register("airline_bridge", with_ctes("bridge") + "SELECT * FROM bridge")
def _bridge(t: Tables) -> DataFrame:
    return B.airline_bridge(t.flights, t.airlines)


@register("union_dedup", with_ctes("bridge") + "SELECT * FROM bridge")
def _union_dedup(t: Tables) -> DataFrame:
    return B.airline_bridge_by_union(t.flights, t.airlines)


@register("q2_regional_leader", with_ctes("regional", "bridge") + """,
counts AS (
  SELECT r.origin_continent, b.airline_iata, b.airline_icao, b.airline_name,
         CAST(count(r.id) AS BIGINT) AS active_flights
  FROM regional r JOIN bridge b ON r.id = b.id
  GROUP BY r.origin_continent, b.airline_iata, b.airline_icao, b.airline_name)
SELECT origin_continent AS continent, airline_iata, airline_icao, airline_name, active_flights FROM (
  SELECT *, rank() OVER (PARTITION BY origin_continent ORDER BY active_flights DESC) AS rk FROM counts) t
WHERE rk = 1""")
def _q2(t: Tables) -> DataFrame:
    return I.q2_regional_leader(t.flights, t.airlines, t.airports, t.zones)


# ------------------------------------------------------------------ Q5 / models

@register("q5_manufacturer_leader", with_ctes("fx_flights", "fx_aircraft_models") + """,
counts AS (
  SELECT m.manufacturer, CAST(count(f.id) AS BIGINT) AS active_flights
  FROM fx_flights f JOIN (SELECT aircraft_code, min(manufacturer) AS manufacturer FROM fx_aircraft_models
                          WHERE aircraft_code IS NOT NULL GROUP BY aircraft_code) m
    ON f.aircraft_code = m.aircraft_code
  WHERE f.on_ground = 0 GROUP BY m.manufacturer)
SELECT manufacturer, active_flights FROM counts WHERE active_flights = (SELECT max(active_flights) FROM counts)""")
def _q5(t: Tables) -> DataFrame:
    return I.q5_manufacturer_leader(t.flights, t.models)


@register("models_per_continent", with_ctes("fx_flights", "cont") + """
SELECT c.continent AS origin_continent, f.aircraft_code AS model, CAST(count(f.id) AS BIGINT) AS active_flights
FROM fx_flights f JOIN cont c ON f.origin_airport_iata = c.iata_code
WHERE f.on_ground = 0 AND f.aircraft_code IS NOT NULL AND c.continent IS NOT NULL
GROUP BY c.continent, f.aircraft_code""")
def _models_per_continent(t: Tables) -> DataFrame:
    return I.models_per_continent(t.flights, t.airports, t.zones)


# ------------------------------------------------------------------ bonus

@register("airport_flow_imbalance", with_ctes("flows", "ap") + """,
j AS (SELECT f.iata_code, a.name AS airport_name, f.departures, f.arrivals,
             CAST(abs(f.departures - f.arrivals) AS BIGINT) AS abs_diff
      FROM flows f JOIN ap a ON f.iata_code = a.iata_code)
SELECT * FROM j WHERE abs_diff = (SELECT max(abs_diff) FROM j)""")
def _imbalance(t: Tables) -> DataFrame:
    return I.airport_flow_imbalance(t.flights, t.airports)
