"""Hand-computed plan rows (R1–R8) for the alert combinations and the boundaries."""

import math

from roadpulse.plans.deployment import recommend


def _plan(spark, rows):
    schema = (
        "id string, event_cause string, corridor string, is_rush_hour int, severity_proba double, closure_needed boolean,"
        " closure_proba double, duration_mean double, duration_p10 double, duration_p25 double, duration_p50 double,"
        " duration_p75 double, duration_p90 double"
    )
    return {r.id: r for r in recommend(spark.createDataFrame(rows, schema)).collect()}


def test_alert_levels_and_manpower(spark):
    rows = [
        ("a", "accident", "CBD 1", 1, 0.5, False, 0.2, 2.0, 0.4, 1.0, 6.0, 9.6, 15.0),      # score 0 (0.5 and 6 not above)
        ("b", "protest", "X", 0, 0.51, False, 0.31, 2.0, 0.4, 1.0, 6.0, 9.6, 15.0),         # score 1
        ("c", "vip_movement", "Non-corridor", 1, 0.9, True, 0.9, 2.0, 0.4, 1.0, 8.0, 9.6, 15.0),   # score 3 -> 5
        ("d", "unknown_cause", "X", 0, 0.2, True, 0.9, 2.0, 0.4, 1.0, 12.5, 9.6, 15.0),     # score 2 -> 3
    ]
    p = _plan(spark, rows)
    assert [p[k].alert_level for k in "abcd"] == [1, 2, 5, 3]
    assert p["a"].total_personnel == math.ceil(4 * 1.0 * 1.3 * 1.0 * 1.0)
    assert p["c"].total_personnel == math.ceil(12 * 1.5 * 1.3 * 1.5 * 1.2)
    assert p["d"].total_personnel == math.ceil(2 * 1.0 * 1.0 * 1.5 * 1.5)
    c = p["c"]
    assert (c.traffic_officers, c.constables, c.support_staff) == (max(2, int(c.total_personnel * 0.4)), int(c.total_personnel * 0.4), max(1, int(c.total_personnel * 0.2)))
    assert p["d"].shifts_needed == 2 and p["a"].shifts_needed == 1
    assert p["a"].manpower_formula == "Base(4) × Severity(1.0) × Rush(1.3) × Closure(1.0) × Duration(1.0)"


def test_barricades_diversion_cost(spark):
    rows = [
        ("a", "accident", "CBD 1", 1, 0.5, False, 0.2, 2.0, 0.4, 1.0, 6.0, 9.6, 15.0),
        ("b", "construction", "Nowhere", 0, 0.51, False, 0.31, 2.0, 0.4, 1.0, 0.15, 9.6, 15.0),
        ("c", "procession", "Non-corridor", 1, 0.9, True, 0.9, 0.25, 0.4, 0.25, 8.0, 9.6, 15.0),
    ]
    p = _plan(spark, rows)
    assert (p["a"].barricade_type, p["a"].barricade_count, p["a"].signage_boards) == ("no_closure", 0, 2)
    assert p["a"].reflective_tape_meters == 30 and p["a"].emergency_lighting is True
    assert (p["b"].barricade_type, p["b"].cones_required, p["b"].temporary_fencing_meters) == ("partial_closure", 24, 50)
    assert (p["c"].barricade_type, p["c"].temporary_fencing_meters) == ("full_closure", 100)
    assert p["a"].diversion_primary.startswith("Residency Road")
    assert p["b"].diversion_primary == "Use adjacent parallel roads via nearest corridor"
    assert p["c"].diversion_advisory.startswith("FULL ROAD CLOSURE")
    # Python rounds the binary value half-even: 0.15 -> 0.1, 0.25 -> 0.2.
    assert p["b"].median_hours == round(0.15, 1) and p["c"].expected_hours == round(0.25, 1)
    assert p["c"].confidence_interval == f"{0.25:.1f} – {9.6:.1f} hours (50% CI)"
    a = p["a"]
    mp = a.traffic_officers * 500 * 6.0 + a.constables * 300 * 6.0 + a.support_staff * 200 * 6.0
    assert a.total_estimated_cost_inr == round(mp + 0 + 500)
    assert a.total_formatted == f"₹{mp + 500:,.0f}"
    assert p["c"].equipment[:3] == ["Walkie-talkies", "Reflective jackets", "Whistles"]
    assert len(p["c"].communication_actions) == 10 and len(p["a"].communication_actions) == 1
