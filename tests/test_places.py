"""Searches by place at any latitude: spillover pairs and nearest centres equal brute force."""

import math
import random

import numpy as np

from roadpulse import config as C
from roadpulse.operators import clusters as K
from roadpulse.operators.estimate import spillover

SPOTS = [(12.97, 77.6), (40.0, -3.7), (-62.0, 179.99), (89.95, 10.0), (0.0, -180.0), (71.0, 0.0)]


def _km(a, b):
    la, lo, lb, ob = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - lo) / 2) ** 2
    return 2 * C.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def test_spillover_misses_no_pair(spark):
    rnd = random.Random(3)
    near = lambda: [(max(-90.0, min(90.0, y + rnd.uniform(-0.2, 0.2))), (x + 180 + rnd.uniform(-1, 1)) % 360 - 180) for y, x in SPOTS for _ in range(12)]
    centres = [(f"c{i}", *p) for i, p in enumerate(near())]
    places = [(f"e{i}", "none", *p, 1.0, 1000.0) for i, p in enumerate(near())]
    inc = spark.createDataFrame([*places, ("e_null", "none", None, 1.0, 1.0, 1000.0)], "id string, corridor string, latitude double, longitude double, severity_proba double, duration_p50 double")
    got = {(r.id, r.spill_corridor) for r in spillover(inc, spark.createDataFrame(centres, "corridor string, c_lat double, c_lng double"), top_n=1000).collect()}
    want = {(e[0], c[0]) for e in places for c in centres if _km(e[2:4], c[1:]) <= 15.0}
    assert got == want and len(want) > 60


def test_nearest_centre_equals_brute_force(spark):
    rnd = random.Random(5)
    events = [(f"e{i}", rnd.choice([12.9 + rnd.random() * 0.2, 13.5, None, float("nan")]), 77.5 + rnd.random() * 0.3, rnd.randrange(24), "accident") for i in range(200)]
    df = spark.createDataFrame(events, "id string, latitude double, longitude double, hour int, event_cause string")
    stats = spark.createDataFrame(
        [(f"k{i:02}", 12.9 + rnd.random() * 0.2, 77.5 + rnd.random() * 0.3, rnd.uniform(0, 24)) for i in range(25)] + [("k99", 60.0, 10.0, 3.0)],
        "cluster_id string, center_lat double, center_lng double, avg_hour double",
    )
    scaler = K.scaler_stats(K.cluster_inputs(df))
    got = {r.id: r.cluster_id for r in K.assign_nearest(df, stats, scaler).collect()}
    s = scaler.first()
    m, d = (np.array([s[f"{k}_{a}"] or 0.0 for a in K.NEAR_AXES]) for k in "ms")

    def point(lat, lng, hour):
        lat = lat if lat is not None and lat == lat else 0.0
        return (np.array([lat, lng, math.sin(2 * math.pi * hour / 24), math.cos(2 * math.pi * hour / 24)]) - m) / d

    centres = [(r.cluster_id, point(r.center_lat, r.center_lng, r.avg_hour)) for r in stats.collect()]
    assert len(got) == len(events)
    for i, lat, lng, hour, _ in events:
        far = {k: float(np.sum((point(lat, lng, hour) - c) ** 2)) for k, c in centres}
        assert far[got[i]] <= min(far.values()) + 1e-9
    assert {r.cluster_id for r in K.assign_nearest(df, stats.limit(0), scaler).collect()} == {K.NOISE}
