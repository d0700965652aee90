"""Flight-shaped views over the driver's TPC-H-like tables.

The same SQL text feeds Spark (``spark.sql(text, **frames)``: the placeholders are
bound to DataFrames, no global view names) and the DuckDB oracle (placeholders
replaced by the pre-registered table names). Every view reads whole tables, so
the work of each query grows with the scale factor.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

FIXTURE_SQL: dict[str, str] = {
    "fx_airports": """
SELECT concat('AP', cast(n_nationkey AS varchar(8))) AS iata_code,
       concat('ICAO', cast(n_nationkey AS varchar(8))) AS icao_code,
       n_name AS name, r_name AS country,
       cast((n_nationkey * 37) % 121 - 60 AS double) AS latitude,
       cast((n_nationkey * 71) % 341 - 170 AS double) AS longitude,
       cast((n_nationkey * 113) % 3000 AS bigint) AS altitude
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_zones": """
SELECT lower(r_name) AS zone_name, cast(r_regionkey AS integer) AS zone_order,
       cast(24 * r_regionkey - 36 AS double) AS tl_y, cast(-150 AS double) AS tl_x,
       cast(24 * r_regionkey - 60 AS double) AS br_y, cast(150 + 4 * r_regionkey AS double) AS br_x
FROM {region}
UNION ALL
SELECT 'overlap' AS zone_name, 5 AS zone_order, cast(10 AS double) AS tl_y, cast(-40 AS double) AS tl_x,
       cast(-30 AS double) AS br_y, cast(80 AS double) AS br_x""",
    # Every supplier is an airline; codes repeat (several airlines per ICAO / IATA code, the
    # two codes disagree) and flight codes K40..K44 / I37..I44 match no airline.
    "fx_airlines": """
SELECT concat('I', cast(s_suppkey % 37 AS varchar(8))) AS airline_iata,
       concat('K', cast(s_suppkey % 40 AS varchar(8))) AS airline_icao, s_name AS airline_name
FROM {supplier}""",
    # The airlines' home countries, for feeds that carry them; an ICAO code of several airlines
    # has several, of which the first in order counts.
    "fx_airline_homes": """
SELECT concat('K', cast(s_suppkey % 40 AS varchar(8))) AS airline_icao, n_name AS country
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "fx_flights": """
SELECT o_orderkey AS id,
       concat('I', cast(o_custkey % 45 AS varchar(8))) AS airline_iata,
       CASE WHEN o_orderkey % 17 = 0 THEN 'N/A'
            ELSE concat('K', cast(o_custkey % 45 AS varchar(8))) END AS airline_icao,
       concat('C', cast(o_orderkey - o_orderkey % 3 AS varchar(12))) AS callsign,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS on_ground,
       concat('AP', cast(CASE WHEN o_orderkey % 29 = 0 THEN 99 ELSE c_nationkey END AS varchar(8))) AS origin_airport_iata,
       CASE WHEN o_orderkey % 23 = 0 THEN cast(null AS varchar(8))
            ELSE concat('AP', cast((c_nationkey + o_orderkey % 7 * 5 + o_orderkey % 11) % 25 AS varchar(8)))
       END AS destination_airport_iata,
       CASE WHEN o_orderkey % 19 = 0 THEN cast(null AS varchar(8))
            ELSE concat('M', cast(o_custkey % 12 AS varchar(8))) END AS aircraft_code,
       o_orderdate AS snapshot_ts
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # Optional model -> manufacturer dimension (the feed does not carry it). Codes
    # M0..M9 get a maker, M10 and M11 stay unmatched.
    "fx_aircraft_models": """
SELECT DISTINCT concat('M', cast(p_size % 10 AS varchar(8))) AS aircraft_code,
       concat('maker', cast(p_size % 10 % 4 AS varchar(8))) AS manufacturer
FROM {part}""",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _placeholders(text: str) -> list[str]:
    return sorted({f for _, f, _, _ in string.Formatter().parse(text) if f})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame (placeholders bound to the parquet tables)."""
    return Tables(spark, sf_dir)._fixture(name)


class Tables:
    """Lazy accessor used by the registry: ``Tables(spark, sf).flights``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        # one file listing per table per query build
        if name not in self._raw:
            self._raw[name] = table(self.spark, self.sf_dir, name)
        return self._raw[name]

    def _fixture(self, name: str) -> DataFrame:
        text = FIXTURE_SQL[name]
        return self.spark.sql(text, **{t: self.raw(t) for t in _placeholders(text)})

    @property
    def flights(self) -> DataFrame:
        return self._fixture("fx_flights")

    @property
    def airports(self) -> DataFrame:
        return self._fixture("fx_airports")

    @property
    def airlines(self) -> DataFrame:
        return self._fixture("fx_airlines")

    @property
    def airline_homes(self) -> DataFrame:
        return self._fixture("fx_airline_homes")

    @property
    def zones(self) -> DataFrame:
        return self._fixture("fx_zones")

    @property
    def models(self) -> DataFrame:
        return self._fixture("fx_aircraft_models")

    @property
    def events(self) -> DataFrame:
        return self.raw("events")
