"""Indicators on a hand-made snapshot with the edge rows of the fixture plan."""

import pytest

from contrail.plans import indicators as I
from contrail.schemas import AIRCRAFT_MODELS, AIRLINES, AIRPORTS, FLIGHTS, ZONES
from tests.conftest import rows


@pytest.fixture(scope="module")
def snap(spark):
    airports = spark.createDataFrame([
        ("CDG", "LFPG", "Paris", "France", 49.0, 2.5, 100),
        ("ORY", "LFPO", "Orly", "France", 48.7, 2.4, 90),
        ("FRA", "EDDF", "Frankfurt", "Germany", 50.0, 8.6, 110),
        ("JFK", "KJFK", "New York", "USA", 40.6, -73.8, 4),
        ("NRT", "RJAA", "Narita", "Japan", 35.8, 140.4, 40),
        ("NRT", "RJAX", "Zz duplicate", "Japan", 0.0, 0.0, 0),    # duplicate code: 'Narita' wins
    ], AIRPORTS)
    zones = spark.createDataFrame([("europe", 1, 72.0, -25.0, 35.0, 45.0), ("america", 1, 72.0, -170.0, 10.0, -50.0),
                                   ("asia", 1, 60.0, 60.0, 0.0, 150.0)], ZONES)
    airlines = spark.createDataFrame([("AF", "AFR", "Air France"), ("LH", "DLH", "Lufthansa"),
                                      ("JL", "JAL", "Japan Airlines")], AIRLINES)
    f = [
        # id, iata, icao, callsign, on_ground, origin, dest, model
        (1, "AF", "AFR", "AF1", 0, "CDG", "FRA", "A320"),
        (2, "AF", "AFR", "AF2", 0, "ORY", "FRA", "A320"),
        (3, "AF", "AFR", "AF3", 0, "CDG", "JFK", "A350"),
        (4, "LH", "DLH", "LH1", 0, "FRA", "CDG", "A320"),
        (5, "LH", "DLH", "LH2", 0, "FRA", "ORY", "B738"),
        (6, "LH", "DLH", "LH3", 0, "FRA", "NRT", "B748"),
        (7, "LH", "DLH", "LH3", 1, "FRA", "NRT", "B748"),          # LH3 seen on the ground -> excluded in Q1
        (8, "JL", "JAL", "JL1", 0, "NRT", "JFK", "B789"),
        (9, "JL", "N/A", "JL2", 0, "NRT", "XXX", None),            # N/A airline, unknown airport, no model
        (10, "AF", "AFR", "AF4", 1, "CDG", None, "A320"),          # grounded, no destination
    ]
    flights = spark.createDataFrame([r + (None,) for r in f], FLIGHTS)
    models = spark.createDataFrame([("A320", "Airbus"), ("A350", "Airbus"), ("B738", "Boeing"),
                                    ("B748", "Boeing"), ("B789", "Boeing")], AIRCRAFT_MODELS)
    return dict(flights=flights, airports=airports, zones=zones, airlines=airlines, models=models)


def test_q1_tie_broken_by_code(snap):
    # AFR: AF1, AF2, AF3 (AF4 only grounded) = 3 ; DLH: LH1, LH2 (LH3 excluded) = 2
    assert rows(I.q1_airline_most_active(snap["flights"], snap["airlines"])) == [("AFR", "Air France", 3)]
    dc = dict((r.airline_icao, r.number_of_flights) for r in I.distinct_callsigns(snap["flights"]).collect())
    assert dc == {"AFR": 3, "DLH": 2, "JAL": 1}


def test_q2_regional_leader_and_written_variant(snap):
    s = snap
    got = rows(I.q2_regional_leader(s["flights"], s["airlines"], s["airports"], s["zones"]))
    # regional europe flights: 1, 2 (AF) and 4, 5 (LH) -> tie, both kept
    assert got == [("europe", "AF", "AFR", "Air France", 2), ("europe", "LH", "DLH", "Lufthansa", 2)]
    allf = rows(I.q2_regional_leader(s["flights"], s["airlines"], s["airports"], s["zones"], regional_only=False))
    # all airborne flights by origin continent: europe AF 3 vs LH 3 (LH3's airborne row counts) ; asia JL 2
    assert ("asia", "JL", "JAL", "Japan Airlines", 2) in allf


def test_q3_longest_route(snap):
    got = I.q3_longest_active_route(snap["flights"], snap["airports"]).collect()
    assert [r.id for r in got] == [8]  # NRT -> JFK
    assert 10800 < got[0].route_length < 10950


def test_q4_average_by_continent(snap):
    got = {r.origin_continent: r.average_route_distance
           for r in I.q4_avg_route_by_continent(snap["flights"], snap["airports"], snap["zones"]).collect()}
    assert set(got) == {"europe", "asia"}


def test_q5_manufacturer(snap):
    got = rows(I.q5_manufacturer_leader(snap["flights"], snap["models"]))
    # airborne: Airbus A320 x3 (1, 2, 4) + A350 (3) = 4 ; Boeing B738, B748, B789 = 3
    assert got == [("Airbus", 4)]


def test_q6_clean_first_vs_drop_after_rank(snap):
    clean = rows(I.q6_top3_models_by_country(snap["flights"], snap["airports"]))
    assert ("France", "A320", 3, 1) in clean and ("Japan", "B789", 1, 1) in clean
    written = rows(I.q6_top3_models_by_country(snap["flights"], snap["airports"], drop_after_rank=True))
    # Japan: NULL model (flight 9) ranks before B789 by code order and is dropped afterwards
    assert [r for r in written if r[0] == "Japan"] == [("Japan", "B789", 1, 2)]


def test_imbalance_variants(snap):
    got = rows(I.airport_flow_imbalance(snap["flights"], snap["airports"]))
    # FRA: departures 4 (4,5,6,7) arrivals 2 (1,2) -> 2 ; CDG: dep 3 arr 1 -> 2 ; NRT dep 2 arr 2 ; JFK 0/2 -> 2
    assert {r[0] for r in got} == {"FRA", "CDG", "JFK"} and {r[4] for r in got} == {2}
    both = rows(I.airport_flow_imbalance(snap["flights"], snap["airports"], both_required=True))
    assert {r[0] for r in both} == {"FRA", "CDG"}  # JFK has arrivals only
    unknown = rows(I.airport_flow_imbalance(snap["flights"], snap["airports"], known_only=False))
    assert all(r[0] != "XXX" for r in unknown)  # XXX differs by 1 only


def test_continent_assign_dedups_airports(snap):
    got = dict(I.continent_assign(snap["airports"], snap["zones"]).collect())
    assert got == {"CDG": "europe", "ORY": "europe", "FRA": "europe", "JFK": "america", "NRT": "asia"}


def test_top_models_by_airline_country(spark):
    flights = spark.createDataFrame([("AFR", "A320"), ("AFR", "A320"), ("AFR", "B738"), ("DLH", "B738"), (None, "A320"), ("XXX", "B738"), ("DLH", None)],
                                    "airline_icao string, aircraft_code string")
    airlines = spark.createDataFrame([("AFR", "France"), ("AFR", "France"), ("DLH", "Germany"), (None, "Nowhere")], "airline_icao string, country string")
    got = I.q6_top3_models_by_country(flights, None, n=1, country_of="airline", airlines=airlines).collect()
    assert {tuple(r) for r in got} == {("France", "A320", 2, 1), ("Germany", "B738", 1, 1)}
