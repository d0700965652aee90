"""Registry entries for sources, sinks, layers, streaming and the batch run.

These queries write into a fresh folder below ``spark.checkpoint.dir`` (never a
machine-local folder on a cluster), read it back and return what was read, so the
oracle is the query before writing. Landing helpers stand in for the external collector.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from contrail import schemas as SCH
from contrail.operators.clean import quarantine, quarantine_status
from contrail.functions.columns import RUN_COLUMNS
from contrail.operators.groups import LG_K, distinct_count_by, distinct_sketch_by, merged_distinct_by
from contrail.operators.profile import profile_change, profiled_write
from contrail.plans import indicators as I
from contrail.plans.oracle import with_ctes
from contrail.plans.job import STATUS_SCHEMA, SILVER, Inputs, ingest_landed, run, run_from_landing, zones_from_tree
from contrail.plans.registry import ORACLE, register
from contrail.session import fresh_path
from contrail.sources.drift import RESCUED_COL, note_fields, read_rescued, schema_drift
from contrail.sources.fixtures import FIXTURE_SQL, Tables, _placeholders
from contrail.sources.layers import layer_path, lookup, published, read_layer, read_run, run_id, run_path, stamp_run, write_layer
from contrail.sources.snapshots import JSON_OPTIONS, flatten_zones, land_json, land_text, read_airports, read_snapshots, \
    read_zone_docs, zone_nodes, zone_quarantine
from contrail.streaming.ingest import latest_per_key, latest_snapshot, snapshot_stream, stream_snapshots
from contrail.streaming.latest import read_latest, stream_latest

RUN_TS = dt.datetime(2024, 1, 1, 7, 0, 0)

_FLIGHT_COLS = ", ".join(SCH.FLIGHTS.fieldNames())
_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"

# ------------------------------------------------------------------ landed snapshots


@register("snapshot_ingest", with_ctes("fx_flights") + f"SELECT {_FLIGHT_COLS} FROM fx_flights")
def _snapshot_ingest(t: Tables) -> DataFrame:
    land = land_json(t.flights, fresh_path(t.spark, "landing/flights"))
    good, _bad = quarantine(read_snapshots(t.spark, land, SCH.FLIGHTS), required=["id"])
    return good


@register("airports_typed", with_ctes("fx_airports") + """
SELECT iata_code, icao_code, name, CASE WHEN latitude > 50 THEN NULL ELSE country END AS country,
       latitude, longitude, CASE WHEN altitude > 2500 THEN NULL ELSE altitude END AS altitude
FROM fx_airports""")
def _airports_typed(t: Tables) -> DataFrame:
    ap = t.airports
    # Every field lands as text; large altitudes arrive as junk, northern countries as 'None'.
    raw = ap.select(
        *[F.col(c).cast("string").alias(c) for c in ("iata_code", "icao_code", "name")],
        F.when(F.col("latitude") > 50, F.lit("None")).otherwise(F.col("country")).alias("country"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.when(F.col("altitude") > 2500, F.lit("unknown")).otherwise(F.col("altitude").cast("string"))
         .alias("altitude"))
    land = land_json(raw, fresh_path(t.spark, "landing/airports"))
    return read_airports(t.spark, land).drop(SCH.CORRUPT_COL)


_NATION_BOX = {
    "tl_y": "cast((n_nationkey * 37) % 121 - 57 AS double)",
    "tl_x": "cast((n_nationkey * 71) % 341 - 173 AS double)",
    "br_y": "cast((n_nationkey * 37) % 121 - 63 AS double)",
    "br_x": "cast((n_nationkey * 71) % 341 - 167 AS double)",
}
_REGION_BOX = {
    "tl_y": "cast(24 * r_regionkey - 36 AS double)",
    "tl_x": "cast(-150 AS double)",
    "br_y": "cast(24 * r_regionkey - 60 AS double)",
    "br_x": "cast(150 + 4 * r_regionkey AS double)",
}


def _zone_docs(t: Tables) -> DataFrame:
    """One zone document per region, its nations as subzones, in the order of the regions."""
    box = lambda m: F.struct(*[F.expr(v).alias(k) for k, v in m.items()])
    nations = t.raw("nation").select("n_regionkey", F.struct(F.col("n_name"), box(_NATION_BOX)).alias("e"))
    # Children of one zone: bounded by the zone tree itself, not by the flight volume.
    sub = nations.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list("e")).alias("subzones"))
    reg = t.raw("region").join(sub, F.col("r_regionkey") == F.col("n_regionkey"), "left").orderBy("r_regionkey")
    node = F.struct(*[F.expr(v).alias(k) for k, v in _REGION_BOX.items()], F.col("subzones"))
    return reg.select(F.to_json(F.create_map(F.lower("r_name"), node)).alias("value"))


def _land_zones(t: Tables, path: str) -> str:
    """The zone documents in one file of lines, an overlapping zone as a pretty-printed document after it, then a
    truncated document and one whose nodes are partly bad."""
    land_text(_zone_docs(t).coalesce(1), f"{path}/a")
    overlap = t.zones.where("zone_name = 'overlap'").select(F.create_map("zone_name", F.struct("tl_y", "tl_x", "br_y", "br_x")).alias("m"))
    land_text(overlap.select(F.to_json("m", {"pretty": "true"}).alias("value")), f"{path}/b")
    land_text(_zone_docs(t).select(F.substring("value", 1, 40).alias("value")).coalesce(1), f"{path}/c")
    bad = t.raw("nation").select(F.to_json(F.create_map(F.col("n_name"), F.struct(
        F.lit("north").alias("tl_y"), F.lit(1).alias("tl_x"), F.lit(1).alias("br_y"), F.lit(1).alias("br_x"), F.lit("none").alias("subzones")))).alias("value"))
    land_text(bad, f"{path}/d")
    return path


@register("zone_quarantine", """
SELECT '$' AS path, 'not JSON' AS problem FROM region
UNION ALL
SELECT concat('$.', n_name) AS path, p AS problem FROM nation, (VALUES ('tl_y is missing or no number'), ('subzones is not an object')) AS v(p)""")
def _zone_quarantine(t: Tables) -> DataFrame:
    land = _land_zones(t, fresh_path(t.spark, "landing/zones"))
    return zone_quarantine(zone_nodes(read_zone_docs(t.spark, land))).select("path", "problem")


@register("zone_order", """
SELECT zone_name, CAST(row_number() OVER (ORDER BY r, c) - 1 AS INTEGER) AS zone_order FROM (
  SELECT lower(r_name) AS zone_name, r_regionkey AS r, -1 AS c FROM region
  UNION ALL SELECT n_name, n_regionkey, n_nationkey FROM nation UNION ALL SELECT 'overlap', 99, 0) z""")
def _zone_order(t: Tables) -> DataFrame:
    """Zones by their place in the landed trees (subzones in the order of the document)."""
    nations = t.raw("nation").orderBy("n_nationkey").withColumn("n", F.struct(F.col("n_nationkey"), F.col("n_name"), F.struct(
        *[F.expr(v).alias(k) for k, v in _NATION_BOX.items()]).alias("box")))
    sub = nations.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n")).alias("ns"))
    said = F.concat_ws(",", F.transform("ns", lambda x: F.concat(F.lit('"'), x["n_name"], F.lit('":'), F.to_json(x["box"]))))
    head = F.to_json(F.struct(*[F.expr(v).alias(k) for k, v in _REGION_BOX.items()]))
    doc = F.concat(F.lit('{"'), F.lower("r_name"), F.lit('":'), F.expr("substring(head, 1, length(head) - 1)"), F.lit(',"subzones":{'), F.col("said"), F.lit("}}}"))
    docs = (t.raw("region").join(sub, F.col("r_regionkey") == F.col("n_regionkey"), "left").withColumns({"head": head, "said": said})
            .orderBy("r_regionkey").select(doc.alias("value")))
    path = fresh_path(t.spark, "landing/zones")
    land_text(docs.coalesce(1), f"{path}/a")
    overlap = t.zones.where("zone_name = 'overlap'").select(F.create_map("zone_name", F.struct("tl_y", "tl_x", "br_y", "br_x")).alias("m"))
    land_text(overlap.select(F.to_json("m", {"pretty": "true"}).alias("value")), f"{path}/b")
    return zones_from_tree(t.spark, path, depth=None).select("zone_name", "zone_order")


@register("zones_flatten", f"""
SELECT lower(r_name) AS zone_name, CAST(NULL AS VARCHAR) AS parent_zone, 0 AS depth,
       {", ".join(f"{v} AS {k}" for k, v in _REGION_BOX.items())}
FROM region
UNION ALL
SELECT n_name AS zone_name, lower(r_name) AS parent_zone, 1 AS depth,
       {", ".join(f"{v} AS {k}" for k, v in _NATION_BOX.items())}
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _zones_flatten(t: Tables) -> DataFrame:
    land = land_text(_zone_docs(t), fresh_path(t.spark, "landing/zones"))
    return flatten_zones(read_zone_docs(t.spark, land))


@register("quarantine_counts", """
SELECT CASE WHEN event_type IN ('error', 'signup') AND value > 100 THEN 'quarantined' ELSE 'accepted' END AS status,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1""")
def _quarantine_counts(t: Tables) -> DataFrame:
    ev = t.events
    line = F.to_json(F.struct(*ev.columns))
    mistyped = F.to_json(F.struct(*[F.lit("oops").alias(c) if c == "value" else F.col(c) for c in ev.columns]))
    # Fault injection by content: large error events land truncated, large signups mistyped.
    large = F.col("value") > 100
    text = ev.select(F.when((F.col("event_type") == "error") & large, F.substring(line, 1, 25))
                      .when((F.col("event_type") == "signup") & large, mistyped)
                      .otherwise(line).alias("value"))
    land = land_text(text, fresh_path(t.spark, "landing/events"))
    raw = read_snapshots(t.spark, land, SCH.EVENTS)
    return quarantine_status(raw, required=["event_id"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ layers

_YEAR_RUN_SQL = """, CAST(year(snapshot_ts) AS INTEGER) AS tech_year,
       strftime(date_trunc('year', snapshot_ts), '%Y-%m') AS tech_month,
       CAST(date_trunc('year', snapshot_ts) AS DATE) AS tech_day, 0 AS tech_hour"""


def _year_runs(flights: DataFrame) -> DataFrame:
    """Fixture flights grouped into runs: the poll year stands in for the run time."""
    return stamp_run(flights, F.date_trunc("year", F.col("snapshot_ts")))


@register("bronze_roundtrip", with_ctes("fx_flights") + f"SELECT {_FLIGHT_COLS}{_YEAR_RUN_SQL} FROM fx_flights")
def _bronze_roundtrip(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "bronze/flights")
    runs = _year_runs(t.flights)
    write_layer(runs, path)
    # Re-running one run must replace that run only (dynamic partition overwrite).
    write_layer(runs.where(F.col("tech_year") == 1995), path)
    return read_layer(t.spark, path, SCH.FLIGHTS)


@register("snapshot_lookup", with_ctes("fx_flights") + f"""
SELECT {_FLIGHT_COLS}{_YEAR_RUN_SQL} FROM fx_flights WHERE year(snapshot_ts) = 1995""")
def _snapshot_lookup(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "bronze/flights")
    write_layer(_year_runs(t.flights), path)
    return lookup(t.spark, path, SCH.FLIGHTS, "1995-01-01", 0)


def _roundtrip(t: Tables, df: DataFrame, name: str, fmt: str) -> DataFrame:
    path = fresh_path(t.spark, f"{name}")
    write_layer(stamp_run(df, RUN_TS), path, fmt)
    back = read_layer(t.spark, path, df.schema, fmt).where(
        (F.col("tech_day") == F.lit(RUN_TS.date())) & (F.col("tech_hour") == RUN_TS.hour))
    return back.select(*df.columns)


@register("silver_roundtrip", with_ctes("mpc") + "SELECT * FROM mpc")
def _silver_roundtrip(t: Tables) -> DataFrame:
    return _roundtrip(t, I.models_per_country(t.flights, t.airports), "silver/country_models", "parquet")


# ------------------------------------------------------------------ streaming


@register("stream_ingest", f"SELECT {_EVENT_COLS} FROM events")
def _stream_ingest(t: Tables) -> DataFrame:
    land = fresh_path(t.spark, "landing/events")
    t.events.write.options(**JSON_OPTIONS).json(land)
    sink, ck = fresh_path(t.spark, "stream/events"), fresh_path(t.spark, "checkpoint/events")
    stream_snapshots(t.spark, land, SCH.EVENTS, sink, ck, required=["event_id"], max_files_per_trigger=1)
    return t.spark.read.schema(SCH.EVENTS).parquet(sink)


@register("stream_dedup", f"SELECT DISTINCT {_EVENT_COLS} FROM events")
def _stream_dedup(t: Tables) -> DataFrame:
    land = fresh_path(t.spark, "landing/events")
    t.events.write.options(**JSON_OPTIONS).json(land)
    t.events.write.mode("append").options(**JSON_OPTIONS).json(land)  # every event lands a second time, later
    sink, ck = fresh_path(t.spark, "stream/events_dedup"), fresh_path(t.spark, "checkpoint/events_dedup")
    # Watermark wider than the data's time span: every repeat is still within state.
    stream_snapshots(t.spark, land, SCH.EVENTS, sink, ck, required=["event_id"],
                     dedup_keys=["event_id", "ts"], ts_col="ts", delay="3650 days", max_files_per_trigger=1)
    return t.spark.read.schema(SCH.EVENTS).parquet(sink)


@register("latest_snapshot", with_ctes("fx_flights") + """
SELECT id, callsign, on_ground, snapshot_ts FROM fx_flights
WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM fx_flights)""")
def _latest_snapshot(t: Tables) -> DataFrame:
    return latest_snapshot(t.flights.select("id", "callsign", "on_ground", "snapshot_ts"), "snapshot_ts")


@register("latest_per_flight", f"""
SELECT {_EVENT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1""")
def _latest_per_flight(t: Tables) -> DataFrame:
    return latest_per_key(t.events, "user_id", "ts", ["event_id"])


@register("latest_per_flight_stream", ORACLE["latest_per_flight"])
def _latest_per_flight_stream(t: Tables) -> DataFrame:
    """The newest row per key kept by a stream: events land in two lots (the later half first, so the second lot is
    late), each drained by a stream of its own with the same checkpoint."""
    land, table, ck = (fresh_path(t.spark, n) for n in ("landing/events", "stream/latest", "checkpoint/latest"))
    middle = t.events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    late = F.unix_micros(F.col("ts").cast("timestamp")) < middle
    for lot in (~late, late):
        t.events.where(lot).write.mode("append").options(**JSON_OPTIONS).json(land)
        rows = snapshot_stream(t.spark, land, SCH.EVENTS, max_files_per_trigger=1).drop(SCH.CORRUPT_COL)
        stream_latest(rows, table, ck, "user_id", "ts", ["event_id"], compact_every=3)
    return read_latest(t.spark, table, SCH.EVENTS, "user_id", "ts", ["event_id"])


# ------------------------------------------------------------------ Gold round trips (need the Q4/Q6 oracles)

@register("gold_csv_roundtrip", ORACLE["q6_top3_models_by_country"])
def _gold_csv(t: Tables) -> DataFrame:
    return _roundtrip(t, I.q6_top3_models_by_country(t.flights, t.airports), "gold/country_models", "csv")


@register("gold_json_roundtrip", ORACLE["q4_avg_route_by_continent"])
def _gold_json(t: Tables) -> DataFrame:
    return _roundtrip(t, I.q4_avg_route_by_continent(t.flights, t.airports, t.zones), "gold/avg_route", "json")


# ------------------------------------------------------------------ batch run and its metrics

_SILVER_ORACLE = {
    "most_airlines": "q1_airline_most_active",
    "top_regional": "q2_regional_leader",
    "find_longest_flight": "q3_longest_active_route",
    "average_flight_distance_by_continent": "q4_avg_route_by_continent",
    "manufacturer_leader": "q5_manufacturer_leader",
    "country_aircraft_model": "q6_top3_models_by_country",
    "greatest_flights_difference": "airport_flow_imbalance",
}


def _scheduled_run_oracle() -> str:
    parts = []
    bronze = {"flights": "fx_flights", "airlines": "fx_airlines", "airports": "fx_airports",
              "zones": "fx_zones", "aircraft_models": "fx_aircraft_models"}
    for name, fx in bronze.items():
        parts.append(f"SELECT 'bronze' AS layer, '{name}' AS dataset, "
                     f"(SELECT CAST(count(*) AS BIGINT) FROM ({with_ctes(fx)} SELECT * FROM {fx}) x) AS rows, "
                     f"'ok' AS status")
    parts.append("SELECT 'bronze' AS layer, 'airline_bridge' AS dataset, "
                 f"(SELECT CAST(count(*) AS BIGINT) FROM ({with_ctes('bridge')} SELECT * FROM bridge) x) AS rows, "
                 "'ok' AS status")
    for layer in ("silver", "gold_csv"):
        for name, key in _SILVER_ORACLE.items():
            parts.append(f"SELECT '{layer}' AS layer, '{name}' AS dataset, "
                         f"(SELECT CAST(count(*) AS BIGINT) FROM ({ORACLE[key]}) x) AS rows, 'ok' AS status")
    return "\nUNION ALL\n".join(parts)


@register("scheduled_run", _scheduled_run_oracle())
def _scheduled_run(t: Tables) -> DataFrame:
    inputs = Inputs(t.flights, t.airlines, t.airports, t.zones, t.models)
    return run(t.spark, inputs, fresh_path(t.spark, "scheduled_run"), RUN_TS)


# What a landed run's Silver rows are compared by: an item (SQL of both engines) and its value.
_LANDED_ITEMS = {
    "most_airlines": ("concat(airline_icao, ':', coalesce(name, ''))", "number_of_flights"),
    "top_regional": ("concat(continent, ':', coalesce(airline_name, ''))", "active_flights"),
    "find_longest_flight": ("cast(id AS varchar(20))", "route_length"),
    "average_flight_distance_by_continent": ("origin_continent", "average_route_distance"),
    "manufacturer_leader": ("manufacturer", "active_flights"),
    "country_aircraft_model": ("concat(country_origin, ':', aircraft_code)", "count_model"),
    "greatest_flights_difference": ("iata_code", "abs_diff"),
}

# What is left of the landed fixtures: whole lines (the zones' order is that of their documents).
_LANDED_FIXTURES = {
    "fx_flights": "SELECT * FROM fx_flights_all WHERE destination_airport_iata IS NOT NULL",
}


def _indicator_items(left: dict[str, str]) -> list[str]:
    """Per dataset the SQL of ``dataset, item, value``, over what is ``left`` of the fixtures."""
    parts = [f"SELECT '{name}' AS dataset, {item} AS item, round(CAST({value} AS DOUBLE), 3) AS value "
             f"FROM ({ORACLE[_SILVER_ORACLE[name]]}) x" for name, (item, value) in _LANDED_ITEMS.items()]
    for name, kept in left.items():
        text = FIXTURE_SQL[name].format(**{t: t for t in _placeholders(FIXTURE_SQL[name])})
        parts = [p.replace(f"{name} AS ({text}\n)", f"{name}_all AS ({text}\n),\n{name} AS ({kept})") for p in parts]
    return parts


def _gold_items(t: Tables, base: str, run_ts: dt.datetime) -> DataFrame:
    """``dataset, item, value`` of a run's indicators as its Gold files have them."""
    out = None
    for name, (item, value) in _LANDED_ITEMS.items():
        schema = t.spark.read.parquet(published(t.spark, run_path(layer_path(base, "silver", name), run_ts))).schema
        rows = read_run(t.spark, layer_path(base, "gold_csv", name), run_ts, schema, fmt="csv").select(
            F.lit(name).alias("dataset"), F.expr(item).alias("item"), F.round(F.col(value).cast("double"), 3).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("landed_run", "\nUNION ALL\n".join(_indicator_items(_LANDED_FIXTURES)))
def _landed_run(t: Tables) -> DataFrame:
    """The scheduled job from landed files to Gold: truncated lines, blank and NaN codes, airports
    as text, nested zone trees and broken ones; returns the indicators' rows as the Gold files have them."""
    landing, base = fresh_path(t.spark, "landing/run"), fresh_path(t.spark, "landed_run")
    f = t.flights.withColumns({
        "airline_icao": F.when((F.col("airline_icao") == "N/A") & (F.col("id") % 2 == 0), F.lit(" ")).otherwise(F.col("airline_icao")),
        "aircraft_code": F.coalesce("aircraft_code", F.lit("NaN"))})
    line = F.to_json(F.struct(*f.columns), JSON_OPTIONS)
    # Fault injection by content: flights without a destination land as truncated lines.
    land_text(f.select(F.when(F.col("destination_airport_iata").isNull(), F.substring(line, 1, 15)).otherwise(line).alias("value")),
              f"{landing}/flights")
    land_json(t.airlines, f"{landing}/airlines")
    land_json(t.airports.select(*[F.col(c).cast("string").alias(c) for c in t.airports.columns]), f"{landing}/airports")
    land_json(t.models, f"{landing}/aircraft_models")
    _land_zones(t, f"{landing}/zones")
    run_from_landing(t.spark, landing, base, RUN_TS)
    return _gold_items(t, base, RUN_TS)


@register("broken_source_run", f"""
SELECT dataset, CAST(rows AS BIGINT) AS rows, status FROM (
  SELECT 'airlines' AS dataset, CAST(NULL AS BIGINT) AS rows, 'fallback' AS status
  UNION ALL SELECT 'zones', NULL, 'fallback'
  UNION ALL SELECT 'flights', (SELECT count(*) FROM ({with_ctes('fx_flights')} SELECT * FROM fx_flights) x), 'ok'
  UNION ALL SELECT 'airports', (SELECT count(*) FROM ({with_ctes('fx_airports')} SELECT * FROM fx_airports) x), 'ok'
  UNION ALL SELECT 'airline_bridge', (SELECT count(*) FROM ({with_ctes('bridge')} SELECT * FROM bridge) x), 'ok'
  UNION ALL SELECT 'most_airlines', (SELECT count(*) FROM ({ORACLE["q1_airline_most_active"]}) x), 'ok'
  UNION ALL SELECT 'top_regional', (SELECT count(*) FROM ({ORACLE["q2_regional_leader"]}) x), 'ok') s""")
def _broken_source_run(t: Tables) -> DataFrame:
    """A run whose airlines are absent and whose zones fail while they are written, after a good run: both fall back
    to the good run's rows, and the datasets that need them are computed."""
    base, wanted = fresh_path(t.spark, "broken_source"), ["most_airlines", "top_regional"]
    run(t.spark, Inputs(t.flights, t.airlines, t.airports, t.zones), base, RUN_TS, gold_formats=(), datasets=wanted)
    broken = t.zones.withColumn("tl_y", F.when(F.col("zone_name") == "overlap", F.raise_error(F.lit("broken feed"))).otherwise(F.col("tl_y")))
    out = run(t.spark, Inputs(t.flights, None, t.airports, broken), base, RUN_TS + dt.timedelta(hours=2), gold_formats=(), datasets=wanted)
    return out.select("dataset", "rows", "status")


@register("run_metrics", with_ctes("fx_flights") + """
SELECT 'flights' AS table_name, CAST(count(*) AS BIGINT) AS rows_read,
       CAST(count(*) FILTER (WHERE destination_airport_iata IS NULL) AS BIGINT) AS rows_rejected,
       CAST(count(*) FILTER (WHERE destination_airport_iata IS NOT NULL) AS BIGINT) AS rows_written
FROM fx_flights""")
def _run_metrics(t: Tables) -> DataFrame:
    f = t.flights
    line = F.to_json(F.struct(*f.columns))
    # Fault injection by content: flights without a destination land as truncated lines.
    text = f.select(F.when(F.col("destination_airport_iata").isNull(), F.substring(line, 1, 20))
                     .otherwise(line).alias("value"))
    land = land_text(text, fresh_path(t.spark, "landing/flights"))
    base = fresh_path(t.spark, "metrics")
    m = ingest_landed(t.spark, land, SCH.FLIGHTS, f"{base}/bronze/flights", f"{base}/quarantine/flights",
                      RUN_TS, required=["id"])
    return t.spark.createDataFrame([("flights", m["rows_read"], m["rows_rejected"], m["rows_written"])],
                                   "table_name string, rows_read bigint, rows_rejected bigint, rows_written bigint")


__all__ = ["STATUS_SCHEMA", "SILVER", "RUN_TS"]


# ------------------------------------------------------------------ the polling loop as a stream

POLLS = 3  # the fixture's flights land as this many polls, ten seconds apart
POLL_FILE_ROWS = 250_000  # about the rows of one landed file: a large poll lands in many, so no task writes it alone
_POLL = f"CAST(year(snapshot_ts) % {POLLS} AS INTEGER)"


def _stream_runs_oracle() -> str:
    parts = []
    for poll in range(POLLS):
        kept = {"fx_flights": f"SELECT * FROM fx_flights_all WHERE {_POLL} = {poll}"}
        parts += [f"SELECT {poll} AS poll, x.* FROM ({sql}) x" for sql in _indicator_items(kept)]
        parts.append(f"SELECT {poll} AS poll, 'runs' AS dataset, 'most_airlines' AS item, 1.0 AS value")
    parts += [f"SELECT 0 AS poll, 'failed first' AS dataset, '{name}' AS item, 1.0 AS value"
              for name in ("top_regional", "average_flight_distance_by_continent")]
    return "\nUNION ALL\n".join(parts)


@register("stream_runs", _stream_runs_oracle())
def _stream_runs(t: Tables) -> DataFrame:
    """Polls ten seconds apart, all seven datasets and their Gold files per poll. The first poll lands alone and meets
    broken zones: two datasets fail and the next drain runs them again. The second lands in three times as many files
    as the others (one each, more where a poll is large), is read in three micro-batches and runs once. Returns the
    Gold rows, how often a poll ran, and what failed at first."""
    from contrail.streaming.runs import stream_runs
    spark = t.spark
    land, base, ck = (fresh_path(spark, n) for n in ("landing/polls", "stream_runs", "checkpoint/stream_runs"))
    polls = t.flights.withColumns({"_p": F.expr(_POLL), "snapshot_ts": F.expr(f"timestampadd(SECOND, 10 * {_POLL}, timestamp_ntz'{RUN_TS}')")})

    wave = -(-t.raw("orders").count() // (POLLS * POLL_FILE_ROWS)) or 1  # files of a micro-batch; a count of the files' footers

    def land_poll(p: int, files: int) -> None:
        polls.where(F.col("_p") == p).drop("_p").repartition(files).write.mode("append").options(**JSON_OPTIONS).json(land)

    broken = t.zones.withColumn("tl_y", F.raise_error(F.lit("broken feed")).cast("double"))
    land_poll(0, wave)
    first = stream_runs(spark, land, Inputs(None, t.airlines, t.airports, broken, t.models), base, ck)
    for p in range(1, POLLS):
        land_poll(p, 3 * wave if p == 1 else wave)
    rest = stream_runs(spark, land, Inputs(None, t.airlines, t.airports, t.zones, t.models), base, ck, max_files_per_trigger=wave)

    times = {p: RUN_TS + dt.timedelta(seconds=10 * p) for p in range(POLLS)}
    number = F.create_map(*[F.lit(x) for p, ts in times.items() for x in (run_id(ts), p)])[F.col("poll")].alias("poll")
    one = lambda rows, dataset, item: rows.groupBy(number, F.lit(dataset).alias("dataset"), item.alias("item")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    out = one(first.where("status LIKE 'failed%'"), "failed first", F.col("dataset"))
    ran = first.unionByName(rest).where("layer = 'silver' AND dataset = 'most_airlines' AND status = 'ok'")
    out = out.unionByName(one(ran, "runs", F.col("dataset")))
    for p, ts in times.items():
        out = out.unionByName(_gold_items(t, base, ts).withColumn("poll", F.lit(p)))
    return out


# ------------------------------------------------------------------ what runs are compared by

@register("callsigns_over_runs", """
SELECT y.y AS from_year, c.airline_icao, true AS within_error FROM (VALUES (1993), (1996)) AS y(y), LATERAL (
  SELECT DISTINCT airline_icao FROM (""" + with_ctes("fx_flights") + """
    SELECT airline_icao, year(snapshot_ts) AS fy FROM fx_flights WHERE airline_icao IS NOT NULL AND callsign IS NOT NULL) f
  WHERE f.fy BETWEEN y.y AND y.y + 2) c""")
def _callsigns_over_runs(t: Tables) -> DataFrame:
    """Distinct callsigns per airline over spans of three years from the sketches stored per run: whether each
    estimate lies within three standard errors of the exact count. The estimates read no flights."""
    path = fresh_path(t.spark, "sketches/callsigns")
    runs = _year_runs(t.flights.where(F.col("airline_icao").isNotNull()))
    by = [*RUN_COLUMNS, "airline_icao"]
    write_layer(distinct_sketch_by(runs, by, "callsign"), path)
    schema = T.StructType([T.StructField("airline_icao", T.StringType()), T.StructField("sketch", T.BinaryType())])
    out = None
    for first in (1993, 1996):
        span = F.col("tech_year").between(first, first + 2)
        near = merged_distinct_by(read_layer(t.spark, path, schema).where(span), "airline_icao", "estimate")
        exact = distinct_count_by(runs.where(span & F.col("callsign").isNotNull()), "airline_icao", "callsign", "exact")
        error = 3 * 1.04 / 2 ** (LG_K / 2)
        ok = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), error * F.col("exact"))
        rows = exact.join(near, "airline_icao").select(F.lit(first).alias("from_year"), "airline_icao", ok.alias("within_error"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("schema_drift", """
SELECT 'props' AS field, 'vanished' AS change, 'string' AS before, CAST(NULL AS VARCHAR) AS after, count(props) AS records FROM events
UNION ALL SELECT 'session', 'new', NULL, 'object', count(user_id) FROM events
UNION ALL SELECT 'value', 'retyped', 'number', 'mixed', count(value) FROM events""")
def _schema_drift(t: Tables) -> DataFrame:
    """Two landed runs: in the second the props are gone, values of purchases are text and a session is new."""
    path, lands = fresh_path(t.spark, "fields/events"), [fresh_path(t.spark, "landing/events") for _ in range(2)]
    land_json(t.events, lands[0])
    text = F.to_json(F.struct(*[c for c in t.events.columns if c not in ("props", "value")], "value",
                              F.when(F.col("user_id").isNotNull(), F.struct("user_id")).alias("session")), JSON_OPTIONS)
    retyped = F.regexp_replace(text, r'"value":([-+.0-9Ee]+)', '"value":"$1"')
    land_text(t.events.select(F.when(F.col("event_type") == "purchase", retyped).otherwise(text).alias("value")), lands[1])
    for hour, land in enumerate(lands):
        note_fields(t.spark, land, path, RUN_TS + dt.timedelta(hours=hour))
    return schema_drift(t.spark, path, RUN_TS + dt.timedelta(hours=1))


@register("rescued_fields", """
SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN user_id END AS session_user,
       CASE WHEN event_id % 3 = 0 THEN 'tag ' || event_type END AS tag, event_id % 2 = 0 OR event_id % 3 = 0 AS rescued
FROM events""")
def _rescued_fields(t: Tables) -> DataFrame:
    """Fields the schema does not name are read back from the rescue column with their types."""
    land = fresh_path(t.spark, "landing/events")
    land_json(t.events.withColumns({"session": F.when(F.col("event_id") % 2 == 0, F.struct("user_id")),
                                    "tag": F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("tag "), "event_type"))}), land)
    read = read_rescued(t.spark, land, SCH.EVENTS)
    return read.select("event_id", "event_type", F.variant_get(RESCUED_COL, "$.session.user_id", "bigint").alias("session_user"),
                       F.variant_get(RESCUED_COL, "$.tag", "string").alias("tag"), F.col(RESCUED_COL).isNotNull().alias("rescued"))


def _run_profile_oracle() -> str:
    one = lambda col, metric, cond: (
        f"SELECT '{col}' AS \"column\", '{metric}' AS metric, CAST(count(*) FILTER (WHERE year(snapshot_ts) % 2 = 0 AND ({cond})) AS DOUBLE) AS before, "
        f"CAST(count(*) FILTER (WHERE year(snapshot_ts) % 2 = 1 AND ({cond})) AS DOUBLE) AS now FROM fx_flights")
    texts = [f.name for f in SCH.FLIGHTS.fields if f.dataType == T.StringType()]
    parts = [one("*", "rows", "true"), one("on_ground", "out_of_range", "on_ground > 0")]
    parts += [one(c, "nulls", f"{c} IS NULL") for c in SCH.FLIGHTS.fieldNames()]
    parts += [one(c, "sentinels", f"{c} IN ('N/A', 'NaN', 'None', '')") for c in texts]
    return with_ctes("fx_flights") + "\nUNION ALL\n".join(parts)


@register("run_profile", _run_profile_oracle())
def _run_profile(t: Tables) -> DataFrame:
    """The profiles of two runs beside each other, from their writes (the counts; quantiles are estimates, see the tests)."""
    base = fresh_path(t.spark, "profiled")
    for odd in range(2):
        part = t.flights.where(F.year("snapshot_ts") % 2 == odd).select(*SCH.FLIGHTS.fieldNames())
        profiled_write(part, f"{base}/bronze", f"{base}/profile", RUN_TS + dt.timedelta(hours=odd), {"on_ground": (None, 0)})
    return profile_change(t.spark, f"{base}/profile", RUN_TS + dt.timedelta(hours=1)).where(~F.col("metric").rlike("^p[0-9]"))
