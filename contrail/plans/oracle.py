"""Oracle SQL (DuckDB dialect, ANSI where possible) for every registered query.

Each statement is self-contained: the fixture views come first as CTEs, then helper
CTEs shared with other statements (unique airports, continents, routes), then the
query. Counts are cast to BIGINT and lengths rounded exactly as on the Spark side;
orderings spell out NULLS FIRST / LAST because the two engines' defaults differ.
"""

from __future__ import annotations

from contrail.functions.geo import WGS84_A_KM, WGS84_B_KM, WGS84_F, lambert_sql
from contrail.sources.fixtures import FIXTURE_SQL, _placeholders

HELPERS: dict[str, str] = {
    "ap": """
SELECT iata_code, icao_code, name, country, latitude, longitude, altitude FROM (
  SELECT *, row_number() OVER (PARTITION BY iata_code ORDER BY name NULLS FIRST, icao_code NULLS FIRST,
         country NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST, altitude NULLS FIRST) AS rn
  FROM fx_airports WHERE iata_code IS NOT NULL) t WHERE rn = 1""",
    "cont": """
SELECT iata_code, continent FROM (
  SELECT a.iata_code, z.zone_name AS continent,
         row_number() OVER (PARTITION BY a.iata_code ORDER BY z.zone_order DESC NULLS LAST,
                            z.zone_name ASC NULLS LAST) AS rn
  FROM ap a LEFT JOIN fx_zones z
    ON a.latitude >= z.br_y AND a.latitude <= z.tl_y
   AND ((a.longitude >= z.tl_x AND a.longitude <= z.br_x)
        OR (z.tl_x > z.br_x AND (a.longitude >= z.tl_x OR a.longitude <= z.br_x)))) t
WHERE rn = 1""",
    "routes": f"""
SELECT f.*, {lambert_sql('o.latitude', 'o.longitude', 'd.latitude', 'd.longitude')} AS route_length
FROM fx_flights f
LEFT JOIN ap o ON f.origin_airport_iata = o.iata_code
LEFT JOIN ap d ON f.destination_airport_iata = d.iata_code""",
    "grounded": """
SELECT DISTINCT callsign FROM fx_flights WHERE on_ground = 1""",
    "bridge": """
SELECT id, airline_iata, airline_icao, airline_name FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY pref, airline_name NULLS FIRST,
         airline_iata NULLS FIRST, airline_icao NULLS FIRST) AS rn
  FROM (SELECT f.id, 0 AS pref, l.airline_name, l.airline_iata, l.airline_icao
        FROM fx_flights f JOIN fx_airlines l ON f.airline_icao = l.airline_icao
        WHERE f.on_ground = 0 AND f.id IS NOT NULL
        UNION ALL
        SELECT f.id, 1 AS pref, l.airline_name, l.airline_iata, l.airline_icao
        FROM fx_flights f JOIN fx_airlines l ON f.airline_iata = l.airline_iata
        WHERE f.on_ground = 0 AND f.id IS NOT NULL) c) t
WHERE rn = 1""",
    "callsigns": """
SELECT airline_icao, CAST(count(DISTINCT callsign) AS BIGINT) AS number_of_flights
FROM fx_flights f
WHERE on_ground = 0 AND airline_icao <> 'N/A'
  AND NOT EXISTS (SELECT 1 FROM grounded g WHERE g.callsign IS NOT DISTINCT FROM f.callsign)
GROUP BY airline_icao""",
    "regional": """
SELECT DISTINCT f.id, f.origin_airport_iata, f.destination_airport_iata,
       oc.continent AS origin_continent, dc.continent AS destination_continent
FROM fx_flights f
LEFT JOIN cont oc ON f.origin_airport_iata = oc.iata_code
LEFT JOIN cont dc ON f.destination_airport_iata = dc.iata_code
WHERE f.on_ground = 0 AND oc.continent IS NOT NULL AND oc.continent = dc.continent""",
    "mpc": """
SELECT a.country AS country_origin, f.aircraft_code, CAST(count(*) AS BIGINT) AS count_model
FROM fx_flights f LEFT JOIN ap a ON f.origin_airport_iata = a.iata_code
WHERE a.country IS NOT NULL AND f.aircraft_code IS NOT NULL
GROUP BY a.country, f.aircraft_code""",
    "flows": """
SELECT iata_code, CAST(sum(dep) AS BIGINT) AS departures, CAST(sum(arr) AS BIGINT) AS arrivals FROM (
  SELECT origin_airport_iata AS iata_code, 1 AS dep, 0 AS arr FROM fx_flights
  UNION ALL
  SELECT destination_airport_iata AS iata_code, 0 AS dep, 1 AS arr FROM fx_flights) e
WHERE iata_code IS NOT NULL GROUP BY iata_code""",
}

# Exact route lengths for the oracle: the fixed-point iteration for the longitude, 40 rounds of it in a recursive
# query, which shares nothing with the solver on the Spark side. Right for pairs that are not nearly antipodal.
_F, _A = repr(WGS84_F), repr(WGS84_A_KM)
_B = repr(WGS84_B_KM)
_STEP = """(SELECT *, CASE WHEN c2a = 0 THEN 0.0 ELSE cs - 2 * sin(u1) * sin(u2) / c2a END AS c2m FROM
 (SELECT *, 1 - sa * sa AS c2a FROM (SELECT *, CASE WHEN ss = 0 THEN 0.0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa, atan2(ss, cs) AS sig FROM
 (SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
         sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM steps{where}) a) b) c)"""
HELPERS |= {
    "steps": f"""
SELECT DISTINCT f.origin_airport_iata AS o, f.destination_airport_iata AS d, atan((1 - {_F}) * tan(radians(a.latitude))) AS u1,
       atan((1 - {_F}) * tan(radians(b.latitude))) AS u2, radians((b.longitude - a.longitude + 540) % 360 - 180) AS l,
       radians((b.longitude - a.longitude + 540) % 360 - 180) AS lam, 0 AS n
FROM fx_flights f JOIN ap a ON f.origin_airport_iata = a.iata_code JOIN ap b ON f.destination_airport_iata = b.iata_code
WHERE f.on_ground = 0 AND a.latitude IS NOT NULL AND a.longitude IS NOT NULL AND b.latitude IS NOT NULL AND b.longitude IS NOT NULL
UNION ALL
SELECT o, d, u1, u2, l, l + (1 - k) * {_F} * sa * (sig + k * ss * (c2m + k * cs * (2 * c2m * c2m - 1))) AS lam, n + 1 AS n FROM
 (SELECT *, {_F} / 16 * c2a * (4 + {_F} * (4 - 3 * c2a)) AS k FROM {_STEP.format(where=' WHERE n < 40')} e) g""",
    "exact_pairs": f"""
SELECT o, d, round(CASE WHEN ss = 0 THEN 0.0 ELSE {_B} * big * (sig - small * ss * (c2m + small / 4 * (cs * (2 * c2m * c2m - 1)
       - small / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))) END, 3) AS km
FROM (SELECT *, 1 + q / 16384 * (4096 + q * (q * (320 - 175 * q) - 768)) AS big, q / 1024 * (256 + q * (q * (74 - 47 * q) - 128)) AS small
      FROM (SELECT *, c2a * ({_A} * {_A} - {_B} * {_B}) / ({_B} * {_B}) AS q FROM {_STEP.format(where=' WHERE n = 40')} e) g) h""",
}

# Helper dependencies (fixtures and other helpers), resolved in order.
DEPS: dict[str, tuple[str, ...]] = {
    "ap": ("fx_airports",),
    "cont": ("ap", "fx_zones"),
    "routes": ("fx_flights", "ap"),
    "steps": ("fx_flights", "ap"),
    "exact_pairs": ("steps",),
    "grounded": ("fx_flights",),
    "bridge": ("fx_flights", "fx_airlines"),
    "callsigns": ("fx_flights", "grounded"),
    "regional": ("fx_flights", "cont"),
    "mpc": ("fx_flights", "ap"),
    "flows": ("fx_flights",),
}


def _resolve(names, seen, out):
    for n in names:
        if n in seen:
            continue
        _resolve(DEPS.get(n, ()), seen, out)
        seen.add(n)
        out.append(n)


def with_ctes(*names: str) -> str:
    """``WITH`` clause for the named fixtures / helpers and everything they depend on."""
    order: list[str] = []
    _resolve(names, set(), order)
    parts = []
    for n in order:
        if n in FIXTURE_SQL:
            text = FIXTURE_SQL[n]
            text = text.format(**{t: t for t in _placeholders(text)})
        else:
            text = HELPERS[n]
        parts.append(f"{n} AS ({text}\n)")
    return ("WITH RECURSIVE " if "steps" in order else "WITH ") + ",\n".join(parts) + "\n"
