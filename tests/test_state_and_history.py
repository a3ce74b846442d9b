"""E3 before fitting, C6 with missing coordinates, L7 with history outside every window."""

from __future__ import annotations

import datetime as dt

import pytest

from roadpulse.operators.clean import impute_coords_by_group
from roadpulse.operators.lags import LagSpec, lookback_counts_with_history, naive_lookback_counts
from roadpulse.operators.state import FeatureModel


def test_unfitted_model_refuses_to_transform(spark):
    df = spark.createDataFrame([(1, "c")], "id long, corridor string")
    with pytest.raises((RuntimeError, ValueError)):
        FeatureModel().transform(df)


def test_missing_coordinates_take_the_mean_of_their_key(spark):
    rows = [(1, "a", 1.0, 10.0), (2, "a", 3.0, 20.0), (3, "a", None, None), (4, "b", None, 5.0), (5, None, None, None), (6, "a", None, 40.0)]
    df = spark.createDataFrame(rows, "id long, corridor string, latitude double, longitude double")
    got = {r.id: (r.latitude, r.longitude) for r in impute_coords_by_group(df).collect()}
    assert got[3] == (2.0, 70.0 / 3) and got[6] == (2.0, 40.0)
    assert got[4] == (None, 5.0) and got[5] == (None, None) and got[1] == (1.0, 10.0) and len(got) == 6


def test_history_is_read_within_the_longest_window_only(spark):
    t0 = dt.datetime(2024, 1, 10)
    hours = [-400, -169, -168, -100, -24, -23, -1, 0, 1, 50, 400]
    history = spark.createDataFrame([(i, "k" if i % 3 else None, t0 + dt.timedelta(hours=h)) for i, h in enumerate(hours)], "id long, zone string, start_datetime timestamp")
    scored = spark.createDataFrame([(100 + i, "k" if i else None, t0 + dt.timedelta(hours=i)) for i in range(3)], "id long, zone string, start_datetime timestamp")
    specs = [LagSpec("n7d", "zone", 168, "strict"), LagSpec("n1d", None, 24, "row_order")]
    got = {r.id: (r.n7d, r.n1d) for r in lookback_counts_with_history(scored, history, specs).collect()}
    both = scored.unionByName(history)
    want = {}
    for spec in specs:
        for r in naive_lookback_counts(both, spec).where("id >= 100").collect():
            want.setdefault(r.id, []).append(r[spec.name])
    assert got == {k: tuple(v) for k, v in want.items()}
    assert lookback_counts_with_history(scored.where("id < 0"), history, specs).count() == 0
