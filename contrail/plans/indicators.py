"""The kata's indicators as lazy DataFrame plans, plus their unranked intermediates.

Inputs are DataFrames with the schemas of ``contrail.schemas``: ``flights``, ``airlines``,
``airports``, ``zones`` and the optional ``models`` (aircraft_code -> manufacturer).
Every function returns a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from contrail.functions.geo import SPHERE_ERROR, add_route_km, haversine_km, is_approx, route_km
from contrail.operators.bridge import airline_dictionary, chosen_rank, with_airline, with_airline_choice
from contrail.functions.columns import is_present
from contrail.operators.clean import active_flights, drop_nullish, unique_by_key
from contrail.operators.groups import approx_distinct_count_by, exclude_flagged_groups
from contrail.operators.ranking import argmax_by_group, argmax_global, top1, top_n_per_group
from contrail.operators.spatial import assign_zone

ENDS = ("origin_airport_iata", "destination_airport_iata")

# ---------------------------------------------------------------- dimensions


def unique_airports(airports: DataFrame) -> DataFrame:
    """Airports with a unique IATA code (smallest name, then ICAO code, wins)."""
    return unique_by_key(airports.where(F.col("iata_code").isNotNull()), ["iata_code"], ["name", "icao_code"])


DIM_COLUMNS = ("iata_code", "name", "country", "latitude", "longitude")


def airport_dim(airports: DataFrame, zones: DataFrame | None = None,
                axes: str = "geographic") -> DataFrame:
    """Conformed airport dimension: one row per IATA code with name, country, coordinates
    and, when ``zones`` are given, the ``continent`` (NULL outside every zone)."""
    ap = unique_airports(airports).select(*DIM_COLUMNS)
    return ap if zones is None else assign_zone(ap, zones, axes=axes)


def continent_assign(airports: DataFrame, zones: DataFrame,
                     axes: str = "geographic") -> DataFrame:
    """``iata_code, continent`` for every (de-duplicated) airport; continent NULL outside all zones."""
    return airport_dim(airports, zones, axes).select("iata_code", "continent")


def lookup(fact: DataFrame, dim: DataFrame, key: str, take: dict[str, str], source: DataFrame,
           how: str = "left") -> DataFrame:
    """``fact`` joined to the airport dimension on ``key = iata_code``; ``take`` renames the
    dimension columns kept.

    Spark broadcasts the dimension when its size allows. It is joined *unchanged* (columns are
    renamed after the join), so the origin and destination lookups of one plan share one
    exchange of it.
    """
    j = fact.join(dim, F.col(key) == F.col("iata_code"), how)
    return j.select(*[F.col(c) for c in fact.columns], *[F.col(src).alias(dst) for src, dst in take.items()])


# ---------------------------------------------------------------- enrichment


def with_route_length(flights: DataFrame, airports: DataFrame, method: str = "lambert",
                      dim: DataFrame | None = None, origin_take: dict[str, str] | None = None) -> DataFrame:
    """Adds ``route_length`` (km, 3 decimals; NULL when an end is unknown), ``route_approx``
    and ``route_known`` (+ any ``origin_take`` columns of the origin airport).

    Both ends are broadcast lookups of one airport dimension and the length is a native
    column expression, so the flights are enriched in one map-side pass (no self-join).
    """
    dim = dim if dim is not None else airport_dim(airports)
    extra = dict(origin_take or {})
    f = lookup(flights, dim, "origin_airport_iata", {"latitude": "_olat", "longitude": "_olon", **extra}, airports)
    f = lookup(f, dim, "destination_airport_iata", {"latitude": "_dlat", "longitude": "_dlon"}, airports)
    f = add_route_km(f, "_olat", "_olon", "_dlat", "_dlon", "route_length", method=method)
    return (f.withColumn("route_known", _both_ends_known())
             .withColumn("route_approx", is_approx(F.col("route_length")))
             .drop("_olat", "_olon", "_dlat", "_dlon")
             .select(*flights.columns, *extra.values(), "route_length", "route_approx", "route_known"))


def _both_ends_known():
    """Cheap stand-in for ``route_length IS NOT NULL`` (NaN coordinates count as unknown).

    Filters on the computed length would be pushed below its projection and re-evaluate
    the whole formula; this predicate only reads the joined coordinates. The one case it
    keeps that the length drops (exact antipodes, NULL length) never matches a maximum
    and is excluded from averages by ``avg`` itself.
    """
    ok = None
    for n in ("_olat", "_olon", "_dlat", "_dlon"):
        p = F.col(n).isNotNull() & ~F.isnan(F.col(n))
        ok = p if ok is None else ok & p
    return ok


def with_continents(flights: DataFrame, airports: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds ``origin_continent`` and ``destination_continent`` (two lookups, one broadcast)."""
    dim = airport_dim(airports, zones)
    f = lookup(flights, dim, "origin_airport_iata", {"continent": "origin_continent"}, airports)
    return lookup(f, dim, "destination_airport_iata", {"continent": "destination_continent"}, airports)


# ---------------------------------------------------------------- Q1


def callsign_activity(flights: DataFrame) -> DataFrame:
    """Per (callsign, airline): airborne seen, and whether the callsign was ever grounded.

    The fact table is first reduced by an aggregate on (callsign, airline_icao) — with
    partial aggregation, so a hot callsign costs one row per task — and only then is the
    per-callsign "ever grounded" flag computed with a window over that small result
    (a window partition holds one callsign's airlines, not its flights).
    """
    per = flights.groupBy("callsign", "airline_icao").agg(
        F.max((F.col("on_ground") == 1).cast("int")).alias("_grounded"),
        F.max((F.col("on_ground") == 0).cast("int")).alias("_airborne"))
    w = Window.partitionBy("callsign")
    return per.withColumn("_ever_grounded", F.coalesce(F.max("_grounded").over(w), F.lit(0)))


def distinct_callsigns(flights: DataFrame) -> DataFrame:
    """``airline_icao, number_of_flights``: distinct airborne callsigns of airlines whose
    callsigns were never seen on the ground (NULL and sentinel airlines dropped)."""
    act = callsign_activity(flights)
    keep = act.where((F.col("_ever_grounded") == 0) & (F.col("_airborne") == 1)
                     & is_present(F.col("airline_icao"), "string"))
    return keep.groupBy("airline_icao").agg(F.count("callsign").alias("number_of_flights"))


def approx_callsigns(flights: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Approximate twin of :func:`distinct_callsigns` (HLL sketch per airline)."""
    f = active_flights(exclude_flagged_groups(flights, "callsign")).where(is_present(F.col("airline_icao"), "string"))
    return approx_distinct_count_by(f, "airline_icao", "callsign", "number_of_flights", rsd)


def q1_airline_most_active(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """``airline_icao, name, number_of_flights`` of the airline with most airborne callsigns."""
    top = top1(distinct_callsigns(flights), ["-number_of_flights", "airline_icao"])
    # One name per ICAO code (smallest), so a code shared by several airlines cannot fan out.
    names = (airlines.where(F.col("airline_icao").isNotNull())
             .groupBy(F.col("airline_icao").alias("_icao")).agg(F.min("airline_name").alias("name")))
    return (top.join(names, F.col("airline_icao") == F.col("_icao"), "left")
               .select("airline_icao", "name", "number_of_flights"))


# ---------------------------------------------------------------- Q2


def regional_flights(flights: DataFrame, airports: DataFrame, zones: DataFrame,
                     regional_only: bool = True) -> DataFrame:
    """Distinct airborne flights with a known origin continent (and, by default, the same
    continent at both ends): ``id, origin_airport_iata, destination_airport_iata,
    origin_continent, destination_continent``."""
    act = active_flights(flights, ["id", "origin_airport_iata", "destination_airport_iata"])
    f = with_continents(act, airports, zones)
    f = drop_nullish(f, ["origin_continent"])
    if regional_only:
        f = f.where(F.col("origin_continent") == F.col("destination_continent"))
    return f.select("id", "origin_airport_iata", "destination_airport_iata",
                    "origin_continent", "destination_continent").distinct()


def q2_regional_leader(flights: DataFrame, airlines: DataFrame, airports: DataFrame, zones: DataFrame,
                       regional_only: bool = True, known_airline_only: bool = True, bridge: DataFrame | None = None) -> DataFrame:
    """Per continent, the airline(s) with most regional airborne flights (ties kept).

    The flights are read once: id, ends and the airline choice (a long) stand on one row. They are reduced to one row per
    (id, ends), the id's best choice is the least over its few rows, and names come back by rank
    after the count. With a stored ``bridge`` (a run's Bronze table) the flights meet it by id instead and need no
    airline lookup. The per-continent maximum is a ``rank()`` over the counts, at most one row per
    (continent, airline).
    """
    how = "inner" if known_airline_only else "left"
    group = ["airline_iata", "airline_icao", "airline_name"]
    if bridge is not None:
        reg = regional_flights(flights, airports, zones, regional_only)
        counts = reg.join(bridge, "id", how).groupBy("origin_continent", *group).agg(F.count("id").alias("active_flights"))
    else:
        dictionary = airline_dictionary(airlines)
        act = active_flights(flights, ["id", *ENDS, "airline_iata", "airline_icao"])
        choice = F.when(F.col("id").isNotNull(), F.col("_choice"))
        few = (with_airline_choice(act, dictionary).withColumn("_choice", choice)
               .groupBy("id", *ENDS).agg(F.min("_choice").alias("_choice")))
        few = few.withColumn("_choice", F.min("_choice").over(Window.partitionBy("id")))
        if known_airline_only:
            few = few.where(F.col("_choice").isNotNull())
        reg = drop_nullish(with_continents(few, airports, zones), ["origin_continent"])
        if regional_only:
            reg = reg.where(F.col("origin_continent") == F.col("destination_continent"))
        per_choice = reg.groupBy("origin_continent", chosen_rank("_choice").alias("_choice")).agg(F.count("id").alias("active_flights"))
        counts = with_airline(per_choice, dictionary, "_choice", how)
    best = argmax_by_group(counts, "active_flights", "origin_continent", method="window")
    return best.select(F.col("origin_continent").alias("continent"), *group, "active_flights")


# ---------------------------------------------------------------- Q3 / Q4

def route_length(flights: DataFrame, airports: DataFrame, method: str = "lambert") -> DataFrame:
    """``id, origin_airport_iata, destination_airport_iata, route_length, route_approx``."""
    return with_route_length(flights, airports, method).select(
        "id", "origin_airport_iata", "destination_airport_iata", "route_length", "route_approx")


def longest_pairs(pairs: DataFrame, airports: DataFrame) -> DataFrame:
    """The pairs of airports that can be the longest, with their exact ``route_length``.

    The great circle bounds a length to ``SPHERE_ERROR``, so only pairs within twice that of the
    longest great circle are solved exactly (a per-row iteration, right up to the antipode).
    """
    dim = airport_dim(airports)
    p = lookup(pairs, dim, ENDS[0], {"latitude": "_olat", "longitude": "_olon"}, airports)
    p = lookup(p, dim, ENDS[1], {"latitude": "_dlat", "longitude": "_dlon"}, airports)
    ends = ("_olat", "_olon", "_dlat", "_dlon")
    p = p.where(_both_ends_known()).withColumn("_circle", haversine_km(*ends))
    near = p.where(F.col("_circle") >= p.agg(F.max("_circle")).scalar() * (1 - 2 * SPHERE_ERROR))
    return near.select(*ENDS, route_km(*ends, method="exact").alias("route_length"))


def q3_longest_active_route(flights: DataFrame, airports: DataFrame, method: str = "exact") -> DataFrame:
    """Airborne flight(s) with the longest route (ties kept); ``route_approx`` where the length is not exact.

    A length depends on the pair of airports alone, so the flights are first reduced to their
    pairs (one row per pair and task), the longest pairs are found among those, and only the
    winning pairs meet the flights again.
    """
    f = active_flights(flights.select("id", "aircraft_code", "airline_icao", "callsign", "on_ground", *ENDS))
    pairs = f.select(*ENDS).distinct()
    if method == "exact":
        r = longest_pairs(pairs, airports).withColumn("route_approx", F.lit(False))
    else:
        r = with_route_length(pairs, airports, method).where(F.col("route_known"))
    # argmax's equi-join never matches a NULL length, so no filter on the length itself.
    longest = argmax_global(r, "route_length").select(*ENDS, "route_length", "route_approx")
    return f.join(longest, list(ENDS)).select("id", "aircraft_code", "airline_icao", "callsign", "route_length", "route_approx")


def q4_avg_route_by_continent(flights: DataFrame, airports: DataFrame, zones: DataFrame,
                              method: str = "lambert", active_only: bool = False) -> DataFrame:
    """Mean route length per origin continent, over the flights.

    Flights are counted per pair of airports first; the length is computed once per pair and
    weighted by its flights.
    """
    f = flights.select("on_ground", *ENDS)
    if active_only:
        f = active_flights(f)
    pairs = f.groupBy(*ENDS).agg(F.count(F.lit(1)).alias("_n"))
    # One dimension (coordinates + continent) serves both ends and the continent.
    r = with_route_length(pairs, airports, method, dim=airport_dim(airports, zones),
                          origin_take={"continent": "origin_continent"})
    r = r.where(F.col("route_known") & F.col("origin_continent").isNotNull())
    agg = r.groupBy("origin_continent").agg(
        F.sum(F.col("route_length") * F.col("_n")).alias("_km"),
        F.sum(F.when(F.col("route_length").isNotNull(), F.col("_n"))).alias("_n"))
    # A continent appears only if it has at least one route with a length.
    return agg.where(F.col("_n") > 0).select("origin_continent", F.round(F.col("_km") / F.col("_n"), 6).alias("average_route_distance"))


# ---------------------------------------------------------------- Q5


def q5_manufacturer_leader(flights: DataFrame, models: DataFrame) -> DataFrame:
    """``manufacturer, active_flights`` of the maker(s) with most airborne flights (ties kept)."""
    dim = unique_by_key(models.where(F.col("aircraft_code").isNotNull()), ["aircraft_code"], ["manufacturer"])
    act = active_flights(flights, ["id", "aircraft_code"])
    j = act.join(dim, "aircraft_code", "inner")
    counts = j.groupBy("manufacturer").agg(F.count("id").alias("active_flights"))
    return argmax_global(counts, "active_flights")


def models_per_continent(flights: DataFrame, airports: DataFrame, zones: DataFrame,
                         active_only: bool = True) -> DataFrame:
    """``origin_continent, model, active_flights``: flights per (origin continent, model)."""
    f = flights.select("id", "on_ground", "origin_airport_iata", F.col("aircraft_code").alias("model"))
    if active_only:
        f = active_flights(f)
    f = drop_nullish(f, ["model"])
    f = lookup(f, airport_dim(airports, zones), "origin_airport_iata", {"continent": "origin_continent"}, airports)
    f = f.where(F.col("origin_continent").isNotNull())
    return f.groupBy("origin_continent", "model").agg(F.count("id").alias("active_flights"))


# ---------------------------------------------------------------- Q6


def models_per_country(flights: DataFrame, airports: DataFrame | None, clean: bool = True,
                       country_of: str = "origin", airlines: DataFrame | None = None) -> DataFrame:
    """``country_origin, aircraft_code, count_model``: flights per (country, model).

    The country is the origin airport's, or with ``country_of="airline"`` the airline's home
    country, for feeds whose ``airlines`` table has a ``country`` column.
    """
    if country_of == "airline":
        home = (unique_by_key(airlines.where(F.col("airline_icao").isNotNull()), ["airline_icao"], ["country"])
                .select(F.col("airline_icao").alias("_icao"), F.col("country").alias("country_origin")))
        f = flights.select("airline_icao", "aircraft_code").join(home, F.col("airline_icao") == F.col("_icao"), "left")
    elif country_of == "origin":
        f = lookup(flights.select("origin_airport_iata", "aircraft_code"), airport_dim(airports),
                   "origin_airport_iata", {"country": "country_origin"}, airports)
    else:
        raise ValueError(f"country_of: {country_of!r}")
    if clean:
        f = drop_nullish(f, ["country_origin", "aircraft_code"])
    return f.groupBy("country_origin", "aircraft_code").agg(F.count(F.lit(1)).alias("count_model"))


def q6_top3_models_by_country(flights: DataFrame, airports: DataFrame | None, n: int = 3,
                              drop_after_rank: bool = False, country_of: str = "origin",
                              airlines: DataFrame | None = None) -> DataFrame:
    """Top ``n`` models per country (count desc, code asc); ``country_of`` as in :func:`models_per_country`.

    Default cleans NULL countries/models before ranking; ``drop_after_rank=True``
    reproduces ranking first and dropping afterwards (fewer than ``n`` rows possible).
    """
    counts = models_per_country(flights, airports, not drop_after_rank, country_of, airlines)
    ranked = top_n_per_group(counts, "country_origin", ["-count_model", "aircraft_code"], n)
    if drop_after_rank:
        ranked = ranked.na.drop()
    return ranked.select("country_origin", "aircraft_code", "count_model", "rank")


# ---------------------------------------------------------------- bonus


def airport_flows(flights: DataFrame, active_only: bool = False) -> DataFrame:
    """``iata_code, departures, arrivals`` in one pass: flights are counted per pair of airports,
    each pair yields its two ends (``stack``) and one aggregate adds up both directions."""
    f = active_flights(flights) if active_only else flights
    pairs = f.groupBy(*ENDS).agg(F.count(F.lit(1)).alias("_n"))
    ends = pairs.select(F.expr("stack(2, origin_airport_iata, _n, 0L, destination_airport_iata, 0L, _n)")
                        .alias("iata_code", "_dep", "_arr"))
    return (ends.where(F.col("iata_code").isNotNull())
                .groupBy("iata_code")
                .agg(F.sum("_dep").cast("bigint").alias("departures"),
                     F.sum("_arr").cast("bigint").alias("arrivals")))


def airport_flow_imbalance(flights: DataFrame, airports: DataFrame, active_only: bool = False,
                           known_only: bool = True, both_required: bool = False) -> DataFrame:
    """Airport(s) with the largest |departures - arrivals| (ties kept).

    ``known_only`` keeps airports of the airport table; ``both_required`` reproduces the
    inner join of the two counts (airports seen in one direction only drop out).
    """
    flows = airport_flows(flights, active_only)
    if both_required:
        flows = flows.where((F.col("departures") > 0) & (F.col("arrivals") > 0))
    names = airport_dim(airports).select("iata_code", F.col("name").alias("airport_name"))
    j = flows.join(names, "iata_code", "inner" if known_only else "left")
    j = j.withColumn("abs_diff", F.abs(F.col("departures") - F.col("arrivals")))
    return argmax_global(j, "abs_diff").select("iata_code", "airport_name", "departures", "arrivals", "abs_diff")
