"""One scheduled run: landed data -> Bronze -> indicators (Silver) -> Gold.

* One run timestamp stamps every table of the run (partition columns ``tech_year``,
  ``tech_month`` = YYYY-MM, ``tech_day`` = date, ``tech_hour``).
* Every table of a run is written to the run's own folder and published as a whole, an empty result
  too; until then, and if a write fails, readers see the last good rows. Earlier runs, also of the
  same hour, stay queryable.
* Indicators read Bronze back from this run's folder only; the written table is also the
  lineage cut between steps. A source that failed falls back to its last good run.
* A failing dataset is isolated: its status row says so and the others still run.
* The independent writes of a layer are submitted together (a small thread pool), so
  Spark runs their jobs side by side instead of one small job after another.
* Row counts come from ``DataFrame.observe`` on the writes (no extra count jobs).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from contrail import schemas as SCH
from contrail.operators.bridge import airline_bridge
from contrail.operators.clean import normalise_sentinels, quarantine
from contrail.operators.profile import profiled_write
from contrail.operators.ranking import order_columns
from contrail.plans import indicators as I
from contrail.sources.layers import last_run_before, layer_path, read_run, write_run
from contrail.sources.snapshots import read_snapshots, read_zone_docs, zone_nodes, zone_quarantine, zones_in_order

log = logging.getLogger("contrail.job")


@dataclass(frozen=True)
class Inputs:
    flights: DataFrame | None
    airlines: DataFrame | None
    airports: DataFrame | None
    zones: DataFrame | None
    models: DataFrame | None = None
    bridge: DataFrame | None = None  # flight -> airline, where a run has stored it


BRONZE_SCHEMAS = {"flights": SCH.FLIGHTS, "airlines": SCH.AIRLINES, "airports": SCH.AIRPORTS,
                  "zones": SCH.ZONES, "aircraft_models": SCH.AIRCRAFT_MODELS, "airline_bridge": SCH.BRIDGE}

# What a profile counts as out of range.
GOOD_RANGES = {"flights": {"on_ground": (0, 1)}, "airports": {"latitude": (-90, 90), "longitude": (-180, 180), "altitude": (-2000, 30000)}}

# The Silver / Gold dataset names analysts already look up (kept unchanged).
SILVER: dict[str, Callable[[Inputs], DataFrame]] = {
    "most_airlines": lambda b: I.q1_airline_most_active(b.flights, b.airlines),
    "top_regional": lambda b: I.q2_regional_leader(b.flights, b.airlines, b.airports, b.zones, bridge=b.bridge),
    "find_longest_flight": lambda b: I.q3_longest_active_route(b.flights, b.airports),
    "average_flight_distance_by_continent": lambda b: I.q4_avg_route_by_continent(b.flights, b.airports, b.zones),
    "manufacturer_leader": lambda b: I.q5_manufacturer_leader(b.flights, b.models),
    "country_aircraft_model": lambda b: I.q6_top3_models_by_country(b.flights, b.airports),
    "greatest_flights_difference": lambda b: I.airport_flow_imbalance(b.flights, b.airports),
}

# The tables each dataset needs; a dataset without one of them fails alone (models: is skipped).
NEEDS = {"most_airlines": ("flights", "airlines"), "top_regional": ("flights", "airlines", "airports", "zones"),
         "find_longest_flight": ("flights", "airports"),
         "average_flight_distance_by_continent": ("flights", "airports", "zones"),
         "manufacturer_leader": ("flights", "models"), "country_aircraft_model": ("flights", "airports"),
         "greatest_flights_difference": ("flights", "airports")}

# Presentation order of the Gold files (T5: sort at the sink only, never inside a plan).
GOLD_ORDER: dict[str, list[str]] = {  # '-col' = descending
    "most_airlines": ["-number_of_flights", "airline_icao"],
    "top_regional": ["-active_flights", "continent", "airline_icao"],
    "find_longest_flight": ["-route_length", "id"],
    "average_flight_distance_by_continent": ["origin_continent"],
    "manufacturer_leader": ["manufacturer"],
    "country_aircraft_model": ["country_origin", "rank"],
    "greatest_flights_difference": ["iata_code"],
}

STATUS_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("status", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name with their types; a missing column raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _observed_write(df: DataFrame, name: str, path: str, run_ts: dt.datetime | str, fmt: str = "parquet") -> int:
    obs = Observation(f"{name}_{abs(hash(path))}")
    write_run(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, run_ts, fmt)
    return int(obs.get["rows"])


def ingest_landed(spark: SparkSession, landing: str, schema: T.StructType, bronze: str, quarantine_dir: str,
                  run_ts: dt.datetime | str, required: Sequence[str] = ()) -> dict[str, int]:
    """Landed JSON -> Bronze (good rows) + quarantine (bad rows, raw text kept).

    Returns ``rows_read``, ``rows_rejected``, ``rows_written`` from the writes' observations.
    """
    raw = read_snapshots(spark, landing, schema)
    good, bad = quarantine(raw, required)
    written = _observed_write(good, "good", bronze, run_ts)
    rejected = _observed_write(bad, "bad", quarantine_dir, run_ts)
    log.info("ingest %s: written=%d rejected=%d", landing, written, rejected)
    return {"rows_read": written + rejected, "rows_rejected": rejected, "rows_written": written}


def run(spark: SparkSession, inputs: Inputs, base: str, run_ts: dt.datetime | str,
        gold_formats: Sequence[str] = ("csv",), datasets: Sequence[str] | None = None,
        bronze_tables: Sequence[str] | None = None, profile: bool = False) -> DataFrame:
    """Execute one run and return its status table ``layer, dataset, rows, status``.

    ``bronze_tables`` limits the Bronze writes (e.g. a stream of polls writes only the
    bridge per poll); the other inputs are used as given. An input that is None or cannot be
    written falls back to its last good run (status ``fallback``); only the datasets of a
    table that has none fail. Without aircraft models their dataset is ``skipped``. ``profile`` keeps
    a data profile of every Bronze table beside it (layer ``profile``), from the write itself.
    """
    if isinstance(run_ts, str):
        run_ts = dt.datetime.fromisoformat(run_ts)
    status: list[tuple] = []
    given = {"flights": inputs.flights, "airlines": inputs.airlines, "airports": inputs.airports,
             "zones": inputs.zones, "aircraft_models": inputs.models}
    tables = [n for n in given if bronze_tables is None or n in bronze_tables]
    ready: dict[str, DataFrame | None] = {n: df for n, df in given.items() if n not in tables}

    def write_bronze(name: str, df: DataFrame | None) -> tuple:
        path, schema = layer_path(base, "bronze", name), BRONZE_SCHEMAS[name]
        failure = "missing"
        if df is not None:
            try:
                n = (profiled_write(conform(df, schema), path, layer_path(base, "profile", name), run_ts, GOOD_RANGES.get(name))
                     if profile else _observed_write(conform(df, schema), name, path, run_ts))
                ready[name] = read_run(spark, path, run_ts, schema)
                return ("bronze", name, n, "ok")
            except Exception as e:  # isolate: later steps see the failure in the status table
                log.exception("bronze %s failed", name)
                failure = f"failed: {type(e).__name__}"
        ready[name] = last_run_before(spark, path, run_ts, schema)
        return ("bronze", name, None, failure if ready[name] is None else "fallback")

    written = _concurrently([lambda n=n: write_bronze(n, given[n]) for n in tables
                             if n != "aircraft_models" or inputs.models is not None])
    ready.setdefault("aircraft_models", None)
    status += written
    # The flight -> airline bridge comes from the Bronze tables, not from the landed files.
    if (bronze_tables is None or "airline_bridge" in bronze_tables) and ready["flights"] is not None and ready["airlines"] is not None:
        status.append(write_bronze("airline_bridge", airline_bridge(ready["flights"], ready["airlines"])))

    b = Inputs(ready["flights"], ready["airlines"], ready["airports"], ready["zones"], ready["aircraft_models"], ready.get("airline_bridge"))
    names = list(datasets or SILVER)

    # Silver: one dataset per indicator, each isolated.
    def write_silver(name: str) -> tuple:
        absent = [n for n in NEEDS[name] if getattr(b, n) is None]
        if absent == ["models"] and inputs.models is None:
            return ("silver", name, None, "skipped")
        if absent:
            return ("silver", name, None, "failed: missing " + ", ".join(absent))
        try:
            return ("silver", name, _observed_write(SILVER[name](b), name, layer_path(base, "silver", name), run_ts), "ok")
        except Exception as e:
            log.exception("silver %s failed", name)
            return ("silver", name, None, f"failed: {type(e).__name__}")

    status += _concurrently([lambda n=n: write_silver(n) for n in names])

    # Gold: the run's Silver rows as analyst-facing files, same partition naming.
    def write_gold(name: str, fmt: str) -> tuple:
        try:
            silver = read_run(spark, layer_path(base, "silver", name), run_ts)
            if name in GOLD_ORDER:
                silver = silver.orderBy(*order_columns(GOLD_ORDER[name]))
            return (f"gold_{fmt}", name, _observed_write(silver, f"{name}_{fmt}", layer_path(base, f"gold_{fmt}", name), run_ts, fmt), "ok")
        except Exception as e:
            log.exception("gold %s %s failed", fmt, name)
            return (f"gold_{fmt}", name, None, f"failed: {type(e).__name__}")

    ok = [n for n in names if any(s[0] == "silver" and s[1] == n and s[3] == "ok" for s in status)]
    status += _concurrently([lambda n=n, f=f: write_gold(n, f) for n in ok for f in gold_formats])
    return spark.createDataFrame(status, STATUS_SCHEMA)


# Independent writes of one layer are submitted together: Spark runs their jobs side by
# side (small indicator jobs leave most executors idle when run one after another).
MAX_CONCURRENT_WRITES = 8


def _concurrently(tasks: list[Callable[[], tuple]]) -> list[tuple]:
    """Run the callables in a thread pool; results in submission order."""
    if len(tasks) <= 1:
        return [t() for t in tasks]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_WRITES, len(tasks))) as pool:
        return list(pool.map(lambda t: t(), tasks))


# ------------------------------------------------------------------ scheduled entry point

def _read_landed(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str],
                 base: str, name: str, run_ts: dt.datetime, status: list) -> DataFrame | None:
    """Landed JSON -> good rows; bad rows go to ``<base>/quarantine/<name>`` for the run."""
    from contrail.sources.snapshots import read_airports
    try:
        raw = read_airports(spark, path) if name == "airports" else read_snapshots(spark, path, schema)
        good, bad = quarantine(raw, required)
        n_bad = _observed_write(bad, f"q_{name}", layer_path(base, "quarantine", name), run_ts)
        status.append(("quarantine", name, n_bad, "ok"))
        return normalise_sentinels(good)
    except Exception as e:
        log.exception("landing %s unreadable", name)
        status.append(("quarantine", name, None, f"failed: {type(e).__name__}"))
        return None


def zones_from_tree(spark: SparkSession, path: str, names: Sequence[str] | None = None, depth: int | None = 0,
                    nodes: DataFrame | None = None) -> DataFrame:
    """Landed zone trees -> flat zones: the top-level zones, or those of ``depth`` (None: all).
    ``zone_order`` is a zone's place in its tree: of overlapping zones the later one wins, a subzone over its parent."""
    z = zones_in_order(zone_nodes(read_zone_docs(spark, path)) if nodes is None else nodes)
    if depth is not None:
        z = z.where(F.col("depth") == depth)
    if names:
        z = z.where(F.col("zone_name").isin(list(names)))
    return z.select("zone_name", "zone_order", "tl_y", "tl_x", "br_y", "br_x")


def _landed_zones(spark: SparkSession, path: str, names: Sequence[str] | None, base: str, run_ts: dt.datetime, status: list) -> DataFrame | None:
    """Landed zone trees -> zones; broken documents and nodes go to ``<base>/quarantine/zones`` for the run."""
    try:
        nodes = zone_nodes(read_zone_docs(spark, path))
        n_bad = _observed_write(zone_quarantine(nodes), "q_zones", layer_path(base, "quarantine", "zones"), run_ts)
        status.append(("quarantine", "zones", n_bad, "ok"))
        return zones_from_tree(spark, path, names, nodes=nodes)
    except Exception as e:
        log.exception("zones unreadable")
        status.append(("quarantine", "zones", None, f"failed: {type(e).__name__}"))
        return None


def run_from_landing(spark: SparkSession, landing: str, base: str, run_ts: dt.datetime | str,
                     zone_names: Sequence[str] | None = None, gold_formats: Sequence[str] = ("csv",),
                     profile: bool = False) -> DataFrame:
    """The scheduled job: ``<landing>/{flights,airlines,airports}`` JSON lines,
    ``<landing>/zones`` zone-tree documents and optional ``<landing>/aircraft_models``.
    Returns the run's status table (quarantine rows included)."""
    if isinstance(run_ts, str):
        run_ts = dt.datetime.fromisoformat(run_ts)
    pre: list[tuple] = []
    lp = lambda n: f"{landing.rstrip('/')}/{n}"
    flights = _read_landed(spark, lp("flights"), SCH.FLIGHTS, ["id"], base, "flights", run_ts, pre)
    airlines = _read_landed(spark, lp("airlines"), SCH.AIRLINES, [], base, "airlines", run_ts, pre)
    airports = _read_landed(spark, lp("airports"), SCH.AIRPORTS, ["iata_code"], base, "airports", run_ts, pre)
    models = _read_landed(spark, lp("aircraft_models"), SCH.AIRCRAFT_MODELS, ["aircraft_code"], base,
                          "aircraft_models", run_ts, pre)
    if models is None:
        pre = [p for p in pre if p[1] != "aircraft_models"]  # optional input
    zones = _landed_zones(spark, lp("zones"), zone_names, base, run_ts, pre)
    out = run(spark, Inputs(flights, airlines, airports, zones, models), base, run_ts, gold_formats, profile=profile)
    return spark.createDataFrame(pre, STATUS_SCHEMA).unionByName(out)


def main(argv: Sequence[str] | None = None) -> None:
    import argparse
    ap = argparse.ArgumentParser(description="one scheduled run: landing -> Bronze -> Silver -> Gold")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--base", required=True, help="shared folder holding bronze/ silver/ gold_*/ quarantine/")
    ap.add_argument("--run-ts", default=None, help="ISO time of the run (default: now)")
    ap.add_argument("--zones", nargs="*", default=None, help="zone names to keep")
    a = ap.parse_args(argv)
    run_ts = (dt.datetime.fromisoformat(a.run_ts) if a.run_ts
              else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("contrail-run").getOrCreate()
    status = run_from_landing(spark, a.landing, a.base, run_ts, a.zones, profile=True)
    rows = status.collect()  # the status table is one row per dataset
    for r in rows:
        log.info("%s %s rows=%s %s", r.layer, r.dataset, r.rows, r.status)
    failed = [f"{r.layer}/{r.dataset}" for r in rows if r.status.startswith(("failed", "missing"))]
    if failed:
        raise SystemExit("failed: " + ", ".join(failed))


if __name__ == "__main__":
    main()
