"""Nearest-outlet join and imputations."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.operators.impute import impute_hierarchical, impute_nearest, nearest_donors
from outletlab.operators.spatial import nearest_within

KPD = conf.KM_PER_DEGREE
R = conf.NEAREST_MAX_KM / KPD


def brute(queries, donors, max_km=conf.NEAREST_MAX_KM):
    out = {}
    for qk, qlat, qlon in queries:
        if qlat is None or qlon is None:
            continue
        best = None
        for dk, dlat, dlon in donors:
            if dlat is None or dlon is None:
                continue
            d = math.sqrt((qlat - dlat) * (qlat - dlat) + (qlon - dlon) * (qlon - dlon)) * KPD
            if best is None or (d, dk) < best:
                best = (d, dk)
        if best is not None and best[0] < max_km:
            out[qk] = (best[1], best[0])
    return out


def run(spark, queries, donors, leaf_points=32):
    q = spark.createDataFrame(queries, "CUSTOMER string, LATITUDE double, LONGITUDE double")
    d = spark.createDataFrame(donors, "DONOR string, LATITUDE double, LONGITUDE double")
    rows = nearest_within(q, d, leaf_points=leaf_points).collect()
    return {r.CUSTOMER: (r.DONOR, r.distance_km) for r in rows}


def test_tie_goes_to_smallest_key_and_radius_is_strict(spark):
    queries = [("q1", 45.0, 13.0), ("q2", 46.0, 13.0), ("q3", None, 13.0), ("q4", 47.0, 13.0)]
    donors = [("d2", 45.0 + R / 4, 13.0), ("d1", 45.0 - R / 4, 13.0),      # equidistant
              ("d3", 46.0 + 2 * R, 13.0),                                  # beyond 5 km
              ("d4", 47.0, 13.0 + R * 0.999), ("d5", None, None)]
    got = run(spark, queries, donors)
    assert got["q1"][0] == "d1"
    assert "q2" not in got and "q3" not in got
    assert got["q4"][0] == "d4" and got["q4"][1] < 5
    assert got == brute(queries, donors)


coord = st.floats(min_value=45.0, max_value=45.3, allow_nan=False)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=25),
       st.lists(st.tuples(coord, coord), min_size=0, max_size=40),
       st.integers(min_value=1, max_value=5))
def test_grid_join_equals_brute_force(spark, qpts, dpts, leaf_points):
    # a third of the donors share one location (hot cell / copies)
    dpts = dpts + [dpts[0]] * (len(dpts) // 2) if dpts else dpts
    queries = [(f"q{i:03d}", a, b) for i, (a, b) in enumerate(qpts)]
    donors = [(f"d{i:03d}", a, b) for i, (a, b) in enumerate(dpts)]
    got = run(spark, queries, donors, leaf_points)
    want = brute(queries, donors)
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == want[k][1]


def test_crowded_places(spark):
    """Two clusters of distinct points, of 400 donors each: a query inside one,
    one at its edge, one between them, and one on a ring of equal distances."""
    donors = [(f"a{i:03d}", 45.0 + (i % 20) * 1e-5, 13.0 + (i // 20) * 1e-5) for i in range(400)]
    donors += [(f"b{i:03d}", 45.02 + (i % 20) * 1e-9, 13.0 + (i // 20) * 1e-9) for i in range(400)]
    donors += [(f"r{i:03d}", 46.0 + 0.01 * math.cos(i), 14.0 + 0.01 * math.sin(i)) for i in range(100)]
    queries = [("q1", 45.0001, 13.00012), ("q2", 44.99, 13.0), ("q3", 45.01, 13.0), ("q4", 46.0, 14.0), ("q5", 45.02, 13.0)]
    assert run(spark, queries, donors) == brute(queries, donors)


def star(spark, rows):
    schema = ("CUSTOMER string, LATITUDE double, LONGITUDE double, _BIC_CDMD_AREA string, "
              "pop_sum double, hh_sum double")
    return spark.createDataFrame(rows, schema)


def test_impute_nearest_fills_only_missing_values(spark):
    df = star(spark, [
        ("a", 45.0, 13.0, "1", 100.0, 10.0),
        ("b", 45.0, 13.0 + R / 2, "1", None, 20.0),     # takes pop_sum from a
        ("c", 45.0, 13.0 + 3 * R, "2", None, None),     # nobody within 5 km
        ("d", None, None, "1", None, 5.0),              # no coordinates: never imputed
        ("e", 45.0 + R / 3, 13.0, None, 7.0, None),     # incomplete: takes hh_sum, keeps its missing area
    ])
    out = {r.CUSTOMER: r for r in impute_nearest(df, ["pop_sum", "hh_sum"]).collect()}
    assert out["a"].pop_sum == 100.0
    assert out["b"].pop_sum == 100.0 and out["b"].hh_sum == 20.0
    assert out["c"].pop_sum is None and out["d"].pop_sum is None
    assert out["e"]._BIC_CDMD_AREA is None and out["e"].pop_sum == 7.0 and out["e"].hh_sum == 10.0
    assert sorted(r.CUSTOMER for r in nearest_donors(df, ["pop_sum", "hh_sum"]).collect()) == ["b", "e"]
    fb = {r.CUSTOMER: r for r in impute_nearest(df, ["pop_sum", "hh_sum"], area_fallback=True).collect()}
    assert fb["c"].pop_sum is None  # area "2" has no known value
    assert fb["d"].pop_sum is None  # no coordinates


def test_hierarchical_means_with_null_strata(spark):
    df = spark.createDataFrame([
        ("1", "A", "x", 10.0), ("2", "A", "x", None), ("3", "A", "y", None), ("4", "A", "y", 30.0),
        ("5", None, None, 50.0), ("6", None, None, None), ("7", "B", "z", None),
    ], "CUSTOMER string, CUST_CTRADE_CH_DESC string, CUST_CDMD_AREA string, v double")
    out = {r.CUSTOMER: r.v_imp for r in impute_hierarchical(df, {"v": "v_imp"}).collect()}
    assert out == {"1": 10.0, "2": 10.0, "3": 30.0, "4": 30.0, "5": 50.0, "6": 50.0, "7": 30.0}


def test_hierarchical_channel_fallback(spark):
    df = spark.createDataFrame([
        ("1", "A", "x", 10.0), ("2", "A", "y", 20.0), ("3", "A", "w", None),
    ], "CUSTOMER string, CUST_CTRADE_CH_DESC string, CUST_CDMD_AREA string, v double")
    out = {r.CUSTOMER: r.v_imp for r in impute_hierarchical(df, {"v": "v_imp"}).collect()}
    assert out["3"] == 15.0


def test_empty_input(spark):
    df = star(spark, [])
    assert impute_nearest(df, ["pop_sum", "hh_sum"]).count() == 0
    assert impute_hierarchical(
        spark.createDataFrame([], "CUSTOMER string, CUST_CTRADE_CH_DESC string, CUST_CDMD_AREA string, v double"),
        {"v": "w"}).count() == 0
    assert F is not None
