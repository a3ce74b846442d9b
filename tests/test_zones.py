"""Zone counts against brute force with half of the incidents in one cell; leg ends; the sample's fallback."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators.evaluate import diverse_sample
from roadpulse.plans import deployment as R
from roadpulse.plans.zones import SHRINK, zone_counts


def test_counts_equal_brute_force_with_a_hot_cell(spark):
    rng = np.random.default_rng(7)
    lat = np.r_[12.97 + rng.normal(0, 0.004, 700), 12.9 + rng.uniform(0, 0.2, 500), np.full(120, 12.95)]
    lng = np.r_[77.59 + rng.normal(0, 0.004, 700), 77.5 + rng.uniform(0, 0.2, 500), np.full(120, 77.6)]
    rad = 0.002 + 0.015 * rng.random(len(lat))
    rad[:5] = 0.0
    rows = [(i, float(a), float(b), float(r), 1) for i, (a, b, r) in enumerate(zip(lat, lng, rad))]
    rows += [rows[9], (5000, None, 77.6, 0.01, 1), (5001, 12.97, 77.59, None, 1), (5002, float("nan"), 77.6, 0.01, 1)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double, zone_radius_deg double, w int").repartition(4)
    got = sorted(map(tuple, zone_counts(df, df).collect()))
    placed = [r for r in rows if r[1] is not None and not np.isnan(r[1])]
    x, y = np.array([r[1] for r in placed]), np.array([r[2] for r in placed]) * SHRINK
    want = sorted((r[0], int((((x - r[1]) ** 2 + (y - r[2] * SHRINK) ** 2) <= r[3] ** 2).sum())) for r in placed if r[3] is not None)
    assert got == want and max(n for _, n in got) > 500
    assert zone_counts(df, df.limit(0)).agg(F.max("incidents_inside")).first()[0] == 0
    assert zone_counts(df.limit(0), df).collect() == []


@pytest.mark.parametrize("proba,n", [(0.1, 1), (0.3, 2), (0.7, 3), (0.9, 4)])
def test_legs_end_on_the_outline(spark, proba, n):
    df = spark.createDataFrame([(12.0, 77.0, proba)], "latitude double, longitude double, severity_proba double")
    r = R.affected_zone(df).first()
    assert len(r.escape_ends) == len(r.escape_routes) == n
    for e in r.escape_ends:
        assert abs(np.hypot(e.lat - 12.0, (e.lng - 77.0) * 0.97) - r.zone_radius_deg) < 1e-12


def test_sample_falls_back_to_the_first_events(spark):
    df = spark.createDataFrame([(f"e{i}", "other", i) for i in range(5)], "id string, event_cause string, start_datetime int")
    assert sorted(r.id for r in diverse_sample(df, ["fire"]).collect()) == ["e0", "e1", "e2"]
    assert [r.id for r in diverse_sample(df.withColumn("event_cause", F.lit("fire")), ["fire"]).collect()] == ["e0"]
    assert diverse_sample(df.limit(0), ["fire"]).collect() == []
