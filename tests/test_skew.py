"""Hot keys (a third of all rows on one key, NULL included) give exact results.

Each case is checked against a brute-force pandas computation on the same rows.
"""

import random

import pandas as pd
import pytest

from contrail.operators.groups import exclude_flagged_groups
from contrail.plans import indicators as I
from contrail.schemas import AIRPORTS, FLIGHTS


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(30000):
        if i % 3 == 0:
            callsign = None                      # a third: NULL callsign
        elif i % 3 == 1:
            callsign = "HOT"                     # a third: one hot callsign
        else:
            callsign = f"C{rnd.randrange(4000)}"
        airline = f"K{rnd.randrange(12)}"
        on_ground = 1 if rnd.random() < (0.002 if callsign is None else 0.3) else 0
        origin = "AP1" if i % 3 != 2 else f"AP{rnd.randrange(2, 9)}"   # hot origin airport
        dest = f"AP{rnd.randrange(1, 9)}"
        model = "M1" if i % 3 == 0 else f"M{rnd.randrange(2, 9)}"
        rows.append((i, "X", airline, callsign, on_ground, origin, dest, model, None))
    pdf = pd.DataFrame(rows, columns=FLIGHTS.fieldNames())
    flights = spark.createDataFrame(rows, FLIGHTS).repartition(8)
    airports = spark.createDataFrame(
        [(f"AP{k}", f"I{k}", f"Airport {k}", "Hotland" if k < 4 else "Coldland", float(k), float(k), 0)
         for k in range(1, 9)], AIRPORTS)
    return pdf, flights, airports


def test_distinct_callsigns_hot_and_null_callsigns(skewed):
    pdf, flights, _ = skewed
    key = pdf.callsign.fillna("<null>")
    grounded = set(key[pdf.on_ground == 1])
    keep = pdf[~key.isin(grounded) & (pdf.on_ground == 0) & pdf.airline_icao.notna() & (pdf.airline_icao != "N/A")]
    expected = keep.groupby("airline_icao").callsign.nunique().to_dict()
    # airlines whose only airborne rows carry NULL callsigns still appear, with 0
    for a in keep.airline_icao.unique():
        expected.setdefault(a, 0)
    got = {r.airline_icao: r.number_of_flights for r in I.distinct_callsigns(flights).collect()}
    assert got == expected


def test_exclude_flagged_groups_hot_keys(skewed):
    pdf, flights, _ = skewed
    key = pdf.callsign.fillna("<null>")
    grounded = set(key[pdf.on_ground == 1])
    expected = sorted(pdf[~key.isin(grounded)].id)
    got = sorted(r.id for r in exclude_flagged_groups(flights, "callsign").select("id").collect())
    assert got == expected


def test_flows_hot_airport(skewed):
    pdf, flights, airports = skewed
    dep = pdf.origin_airport_iata.value_counts()
    arr = pdf.destination_airport_iata.value_counts()
    codes = sorted(set(dep.index) | set(arr.index))
    diff = {c: abs(int(dep.get(c, 0)) - int(arr.get(c, 0))) for c in codes}
    best = max(diff.values())
    got = {r.iata_code: r.abs_diff for r in I.airport_flow_imbalance(flights, airports).collect()}
    assert got == {c: d for c, d in diff.items() if d == best}


def test_top3_hot_country(skewed):
    pdf, flights, airports = skewed
    country = {f"AP{k}": ("Hotland" if k < 4 else "Coldland") for k in range(1, 9)}
    p = pdf.assign(country=pdf.origin_airport_iata.map(country)).dropna(subset=["country", "aircraft_code"])
    counts = p.groupby(["country", "aircraft_code"]).size().reset_index(name="n")
    counts = counts.sort_values(["country", "n", "aircraft_code"], ascending=[True, False, True])
    counts["rank"] = counts.groupby("country").cumcount() + 1
    expected = sorted(tuple(x) for x in counts[counts["rank"] <= 3][["country", "aircraft_code", "n", "rank"]]
                      .itertuples(index=False, name=None))
    got = sorted(tuple(r) for r in I.q6_top3_models_by_country(flights, airports).collect())
    assert got == expected
