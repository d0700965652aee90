"""Flight -> airline bridge and the generic union + keyed de-duplication.

Preference for a flight's airline: a match on ICAO beats a match on IATA; among equal
matches the smallest (name, iata, icao) wins. Flights without any match get no row.

The preference is one long: airlines are numbered in the order of (name, iata, icao) in a stored
dictionary, and a match on IATA adds ``IATA_ONLY``. Choosing an airline per flight id is then a
``min`` of a long, which Spark does in a hash aggregate without sorting the flights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contrail.operators.clean import active_flights, unique_by_key
from contrail.session import fresh_path

_AIRLINE = ("airline_name", "airline_iata", "airline_icao")
IATA_ONLY = 1 << 62


def union_dedup(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``UNION ALL`` by name, then one row per key by ``order`` (aggregate form, skew-safe). Where all
    other columns are one number, its minimum is the row."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    rest = [c for c in u.columns if c not in keys]
    if rest == list(order) and len(rest) == 1 and dict(u.dtypes)[rest[0]] in ("int", "bigint", "double"):
        return u.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
    return unique_by_key(u, keys, order)


def airline_dictionary(airlines: DataFrame) -> DataFrame:
    """``airline_rank, airline_name, airline_iata, airline_icao``: every different airline once, ranks in
    the order of (name, iata, icao), NULLs first. Written once, so that the ranks are fixed; they
    grow with the order but have gaps (a number per partition of the sort)."""
    ranked = (airlines.select(*_AIRLINE).distinct().orderBy(*[F.asc_nulls_first(c) for c in _AIRLINE])
              .select(F.monotonically_increasing_id().alias("airline_rank"), *_AIRLINE))
    path = fresh_path(airlines.sparkSession, "airline_dictionary")
    ranked.write.parquet(path)
    return airlines.sparkSession.read.schema(ranked.schema).parquet(path)


def _best_rank_per(dictionary: DataFrame, code: str, key: str, out: str) -> DataFrame:
    return dictionary.where(F.col(code).isNotNull()).groupBy(F.col(code).alias(key)).agg(F.min("airline_rank").alias(out))


def with_airline_choice(flights: DataFrame, dictionary: DataFrame, out: str = "_choice") -> DataFrame:
    """Adds ``out``: the preferred airline of this row as a long (smaller is better), NULL if neither code
    matches. Two lookups of the airline dimension, reduced to one airline per code."""
    by_icao = _best_rank_per(dictionary, "airline_icao", "_k0", "_r0")
    by_iata = _best_rank_per(dictionary, "airline_iata", "_k1", "_r1")
    j = (flights.join(by_icao, F.col("airline_icao") == F.col("_k0"), "left")
                .join(by_iata, F.col("airline_iata") == F.col("_k1"), "left"))
    return j.withColumn(out, F.coalesce("_r0", F.col("_r1") + F.lit(IATA_ONLY))).drop("_k0", "_r0", "_k1", "_r1")


def chosen_rank(choice: str) -> Column:
    """The airline's rank of a choice."""
    return F.col(choice).bitwiseAND(F.lit(IATA_ONLY - 1))


def with_airline(df: DataFrame, dictionary: DataFrame, choice: str, how: str = "inner") -> DataFrame:
    """``df`` with the airline columns of its choice, which is dropped."""
    j = df.join(dictionary, chosen_rank(choice) == F.col("airline_rank"), how)
    return j.select(*[F.col(c) for c in df.columns if c != choice], "airline_iata", "airline_icao", "airline_name")


def _chosen_from(flights: DataFrame, active_only: bool) -> DataFrame:
    f = active_flights(flights) if active_only else flights
    return f.where(F.col("id").isNotNull()).select("id", "airline_iata", "airline_icao")


def airline_bridge(flights: DataFrame, airlines: DataFrame, active_only: bool = True, dictionary: DataFrame | None = None) -> DataFrame:
    """One row per flight id: ``id, airline_iata, airline_icao, airline_name``.

    The flights meet the airline dimension in two lookups and are reduced to one long per id by a
    hash aggregate with partial aggregation; names come back by rank.
    """
    dictionary = dictionary if dictionary is not None else airline_dictionary(airlines)
    cand = with_airline_choice(_chosen_from(flights, active_only), dictionary).where(F.col("_choice").isNotNull())
    best = cand.groupBy("id").agg(F.min("_choice").alias("_choice"))
    return with_airline(best, dictionary, "_choice")


def airline_bridge_by_union(flights: DataFrame, airlines: DataFrame, active_only: bool = True) -> DataFrame:
    """Same result written as the two lookups unioned and de-duplicated per id. Each lookup meets one airline
    per code, its first, so a flight has at most two candidates, however many airlines share its codes."""
    f, dictionary = _chosen_from(flights, active_only), airline_dictionary(airlines)
    match = lambda code: f.select("id", code).join(_best_rank_per(dictionary, code, code, "airline_rank"), code, "inner")
    by_icao = match("airline_icao").select("id", F.col("airline_rank").alias("_choice"))
    by_iata = match("airline_iata").select("id", (F.col("airline_rank") + F.lit(IATA_ONLY)).alias("_choice"))
    return with_airline(union_dedup([by_icao, by_iata], ["id"], ["_choice"]), dictionary, "_choice")
