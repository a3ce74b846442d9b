"""Correction factors (F6) against the committed post-event report of the reproduced system."""

from roadpulse.operators.feedback import correction_factors

# Golden values: per-cause rounded bias and ratio in, factor out.
SEV_BIAS = {
    "accident": -0.001, "vehicle_breakdown": -0.002, "others": -0.001, "road_conditions": -0.001,
    "congestion": 0.011, "procession": 0.0, "construction": -0.001, "public_event": -0.001,
    "tree_fall": 0.0, "pot_holes": -0.001, "water_logging": -0.001, "vip_movement": 0.0,
}
DUR_RATIO = {
    "vehicle_breakdown": 0.744, "accident": 0.697, "others": 0.219, "road_conditions": 0.19,
    "construction": 0.228, "water_logging": 0.855, "pot_holes": 0.707, "congestion": 0.667, "tree_fall": 0.094,
}
FACTORS = {
    "accident": 1.2, "vehicle_breakdown": 1.0, "others": 1.2, "road_conditions": 1.2, "congestion": 1.2,
    "procession": 1.0, "construction": 1.2, "public_event": 1.0, "tree_fall": 1.2, "pot_holes": 1.0,
    "water_logging": 1.0, "vip_movement": 1.0,
}


def test_factors_match_report(spark):
    sev = spark.createDataFrame(list(SEV_BIAS.items()), "event_cause string, bias double")
    dur = spark.createDataFrame(list(DUR_RATIO.items()), "event_cause string, ratio double")
    got = {r.event_cause: r.factor for r in correction_factors(sev, dur).collect()}
    assert got.keys() == FACTORS.keys()
    for k, v in FACTORS.items():
        assert abs(got[k] - v) < 1e-12, k


def test_bias_thresholds(spark):
    sev = spark.createDataFrame([("a", -0.3), ("b", 0.5), ("c", 0.1), ("d", -0.1)], "event_cause string, bias double")
    dur = spark.createDataFrame([("a", 1.5)], "event_cause string, ratio double")
    got = {r.event_cause: r.factor for r in correction_factors(sev, dur).collect()}
    assert abs(got["a"] - round(1 + 0.3 * 0.5, 2) * 0.9) < 1e-12
    assert got["b"] == round(max(0.8, 1 - 0.5 * 0.3), 2)
    assert got["c"] == 1.0 and got["d"] == 1.0
