"""Explicit schemas. Nothing is inferred and nothing is renamed by position."""

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

FLIGHTS = T.StructType([
    T.StructField("id", L),
    T.StructField("airline_iata", S),
    T.StructField("airline_icao", S),
    T.StructField("callsign", S),
    T.StructField("on_ground", I),
    T.StructField("origin_airport_iata", S),
    T.StructField("destination_airport_iata", S),
    T.StructField("aircraft_code", S),
    T.StructField("snapshot_ts", T.TimestampNTZType()),
])

AIRLINES = T.StructType([
    T.StructField("airline_iata", S),
    T.StructField("airline_icao", S),
    T.StructField("airline_name", S),
])

AIRPORTS = T.StructType([
    T.StructField("iata_code", S),
    T.StructField("icao_code", S),
    T.StructField("name", S),
    T.StructField("country", S),
    T.StructField("latitude", D),
    T.StructField("longitude", D),
    T.StructField("altitude", L),
])

# Landed airports arrive as loosely typed JSON: every field is read as text and
# cast with try_cast, so one bad value nulls a field instead of failing the job.
AIRPORTS_RAW = T.StructType([T.StructField(f.name, S) for f in AIRPORTS.fields])

ZONES = T.StructType([
    T.StructField("zone_name", S),
    T.StructField("zone_order", I),
    T.StructField("tl_y", D),
    T.StructField("tl_x", D),
    T.StructField("br_y", D),
    T.StructField("br_x", D),
])

BRIDGE = T.StructType([
    T.StructField("id", L),
    T.StructField("airline_iata", S),
    T.StructField("airline_icao", S),
    T.StructField("airline_name", S),
])

AIRCRAFT_MODELS = T.StructType([
    T.StructField("aircraft_code", S),
    T.StructField("manufacturer", S),
])

EVENTS = T.StructType([
    T.StructField("event_id", L),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", L),
    T.StructField("event_type", S),
    T.StructField("value", D),
    T.StructField("props", S),
])

CORRUPT_COL = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, S)])
