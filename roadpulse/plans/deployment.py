"""Deployment plans (R1–R11) as columns over a scored incident table.

Input columns: ``event_cause``, ``corridor``, ``is_rush_hour``, ``severity_proba``,
``closure_needed``, ``closure_proba`` and ``duration_mean/p10/p25/p50/p75/p90``
(plus ``latitude``/``longitude`` for the affected zone).  Every rule is a
column expression; the only join is the optional correction-factor table
(one row per cause), left-joined without a hint so adaptive execution picks
broadcast or shuffle from its measured size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.functions.rounding import py_fixed, py_round


def _map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def _p50() -> Column:
    return F.coalesce(F.col("duration_p50"), F.lit(2.0))


def alert_level(df: DataFrame) -> DataFrame:
    """score = (proba > .5) + closure + (p50 > 6); level 1, 2, 3, then 4 or 5 as the rules fall."""
    sev = F.coalesce(F.col("severity_proba"), F.lit(0.5)) > 0.5
    clo = F.coalesce(F.col("closure_needed"), F.lit(False))
    long_ = _p50() > 6
    score = sev.cast("int") + clo.cast("int") + long_.cast("int")
    level = (
        F.when(score == 0, 1).when(score == 1, 2).when(score == 2, 3)
        .when(sev & clo & ~long_, 4).otherwise(5)
    )
    colors = {lv: color for lv, color, _ in C.ALERT_LEVELS}
    descs = {lv: d for lv, _, d in C.ALERT_LEVELS}
    return df.withColumn("alert_level", level).withColumns(
        {
            "alert_color": F.element_at(_map(colors), F.col("alert_level")),
            "alert_description": F.element_at(_map(descs), F.col("alert_level")),
        }
    )


def manpower(df: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """R2 (+R9): ``ceil(base·sev·rush·closure·dur·correction)`` multiplied in this order."""
    if factors is not None:
        df = apply_correction_factors(df, factors)
    elif "correction_factor" not in df.columns:
        df = df.withColumn("correction_factor", F.lit(1.0))
    base = F.coalesce(F.element_at(_map(C.MANPOWER_BASE), F.col("event_cause")), F.lit(C.MANPOWER_BASE_DEFAULT))
    sev = F.when(F.coalesce(F.col("severity_proba"), F.lit(0.5)) > 0.5, F.lit(C.SEVERITY_MULTIPLIER["High"])).otherwise(
        F.lit(C.SEVERITY_MULTIPLIER["Low"])
    )
    rush = F.when(F.coalesce(F.col("is_rush_hour"), F.lit(0)) != 0, F.lit(C.RUSH_HOUR_MULTIPLIER)).otherwise(F.lit(1.0))
    clo = F.when(F.coalesce(F.col("closure_needed"), F.lit(False)), F.lit(C.ROAD_CLOSURE_MULTIPLIER)).otherwise(F.lit(1.0))
    dur = F.when(_p50() > 12, F.lit(1.5)).when(_p50() > 6, F.lit(1.2)).otherwise(F.lit(1.0))
    df = df.withColumns(
        {"_base": base, "_sev_mult": sev, "_rush_mult": rush, "_clo_mult": clo, "_dur_mult": dur}
    )
    raw = (
        F.col("_base").cast("double") * F.col("_sev_mult") * F.col("_rush_mult") * F.col("_clo_mult")
        * F.col("_dur_mult") * F.col("correction_factor")
    )
    p = F.ceil(raw).cast("int")
    df = df.withColumn("total_personnel", p)
    tp = F.col("total_personnel")
    return df.withColumns(
        {
            "traffic_officers": F.greatest(F.lit(2), (tp * 0.4).cast("int")),
            "constables": (tp * 0.4).cast("int"),
            "support_staff": F.greatest(F.lit(1), (tp * 0.2).cast("int")),
            "shifts_needed": F.greatest(F.lit(1), F.ceil(_p50() / 8).cast("int")),
            "manpower_formula": F.format_string(
                "Base(%d) × Severity(%s) × Rush(%s) × Closure(%s) × Duration(%s)",
                F.col("_base"), F.col("_sev_mult").cast("string"), py_fixed(F.col("_rush_mult"), 1),
                py_fixed(F.col("_clo_mult"), 1), py_fixed(F.col("_dur_mult"), 1),
            ),
        }
    ).drop("_base", "_sev_mult", "_rush_mult", "_clo_mult", "_dur_mult")


def barricading(df: DataFrame) -> DataFrame:
    """Full / partial / none, cones, boards, and cause-specific extras (nullable)."""
    clo = F.coalesce(F.col("closure_needed"), F.lit(False))
    proba = F.coalesce(F.col("closure_proba"), F.lit(0.0))
    btype = F.when(clo, F.lit("full_closure")).when(proba > 0.3, F.lit("partial_closure")).otherwise(F.lit("no_closure"))
    df = df.withColumn("barricade_type", btype)
    df = df.withColumn("barricade_count", F.element_at(_map(C.BARRICADE_BASE), F.col("barricade_type")))
    cause = F.col("event_cause")
    return df.withColumns(
        {
            "cones_required": F.col("barricade_count") * 4,
            "signage_boards": F.greatest(F.lit(2), F.floor(F.col("barricade_count") / 2).cast("int")),
            "temporary_fencing_meters": F.when(
                cause.isin("construction", "public_event", "procession"), F.when(clo, F.lit(100)).otherwise(F.lit(50))
            ),
            "reflective_tape_meters": F.when(cause == "accident", F.lit(30)),
            "emergency_lighting": F.when(cause == "accident", F.lit(True)),
        }
    )


def diversion(df: DataFrame) -> DataFrame:
    """Corridor lookup (22 corridors + default) with closure flag and advisory."""
    routes = F.element_at(
        F.create_map(*[x for k, v in C.DIVERSIONS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))]),
        F.col("corridor"),
    )
    default = F.array(*[F.lit(s) for s in C.DIVERSION_DEFAULT])
    r = F.coalesce(routes, default)
    clo = F.coalesce(F.col("closure_needed"), F.lit(False))
    return df.withColumns(
        {
            "diversion_primary": r[0],
            "diversion_secondary": r[1],
            "diversion_avoid": r[2],
            "diversion_closure_needed": clo,
            "diversion_advisory": F.when(clo, F.lit(C.ADVISORY_CLOSURE)).otherwise(F.lit(C.ADVISORY_PARTIAL)),
        }
    )


def duration_estimate(df: DataFrame) -> DataFrame:
    """1-decimal estimates and the 50 % interval text (Python half-even rounding)."""

    def d(c: str, default: float) -> Column:
        return F.coalesce(F.col(c), F.lit(default))

    return df.withColumns(
        {
            "expected_hours": py_round(d("duration_mean", 2.0), 1),
            "best_case_hours": py_round(d("duration_p10", 0.5), 1),
            "median_hours": py_round(d("duration_p50", 2.0), 1),
            "worst_case_hours": py_round(d("duration_p90", 12.0), 1),
            "confidence_interval": F.concat(
                py_fixed(d("duration_p25", 1.0), 1), F.lit(" – "), py_fixed(d("duration_p75", 6.0), 1), F.lit(" hours (50% CI)")
            ),
        }
    )


def equipment(df: DataFrame) -> DataFrame:
    """Base kit + cause kit."""
    kit = F.element_at(
        F.create_map(*[x for k, v in C.CAUSE_EQUIPMENT.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))]),
        F.col("event_cause"),
    )
    base = F.array(*[F.lit(s) for s in C.BASE_EQUIPMENT])
    return df.withColumn("equipment", F.concat(base, F.coalesce(kit, F.array().cast("array<string>"))))


def communication(df: DataFrame) -> DataFrame:
    """Actions accumulate with the alert level (needs R1)."""
    if "alert_level" not in df.columns:
        df = alert_level(df)
    lv = F.col("alert_level")
    parts = [F.when(lv >= need, F.array(F.lit(a))).otherwise(F.array().cast("array<string>")) for need, a in C.COMMUNICATION_ACTIONS]
    return df.withColumns({"communication_actions": F.concat(*parts), "communication_priority": F.col("alert_color")})


def estimated_cost(df: DataFrame) -> DataFrame:
    """Manpower × p50 hours at role rates, barricades, equipment; half-even rounding."""
    if "traffic_officers" not in df.columns:
        df = manpower(df)
    if "barricade_count" not in df.columns:
        df = barricading(df)
    dur = _p50()
    r = C.COST_RATES
    mp = (
        F.col("traffic_officers") * F.lit(r["officer"]) * dur
        + F.col("constables") * F.lit(r["constable"]) * dur
        + F.col("support_staff") * F.lit(r["support"]) * dur
    )
    bc = (F.col("barricade_count") * F.lit(r["barricade"])).cast("double")
    ec = F.when(F.coalesce(F.col("closure_needed"), F.lit(False)), F.lit(float(C.EQUIPMENT_COST["closure"]))).otherwise(
        F.lit(float(C.EQUIPMENT_COST["no_closure"]))
    )
    total = mp + bc + ec
    return df.withColumns(
        {
            "manpower_cost_inr": py_round(mp, 0).cast("bigint"),
            "barricade_cost_inr": py_round(bc, 0).cast("bigint"),
            "equipment_cost_inr": py_round(ec, 0).cast("bigint"),
            "total_estimated_cost_inr": py_round(total, 0).cast("bigint"),
            "total_formatted": F.concat(F.lit("₹"), F.format_number(py_round(total, 0), 0)),
        }
    )


def apply_correction_factors(df: DataFrame, factors: DataFrame) -> DataFrame:
    """``correction_factor`` by cause (default 1.0)."""
    f = factors.select("event_cause", F.col("factor").alias("_cf"))
    out = df.join(f, on="event_cause", how="left").withColumn("correction_factor", F.coalesce(F.col("_cf"), F.lit(1.0)))
    return out.drop("_cf")


_NAIVE_RATE = (
    C.NAIVE_PLAN["personnel"] * 0.4 * C.COST_RATES["officer"]
    + C.NAIVE_PLAN["personnel"] * 0.4 * C.COST_RATES["constable"]
    + C.NAIVE_PLAN["personnel"] * 0.2 * C.COST_RATES["support"]
)


def savings_vs_naive(df: DataFrame) -> DataFrame:
    """Naive plan = 12 people for p90 hours, 12 barricades, full kit."""
    if "total_estimated_cost_inr" not in df.columns:
        df = estimated_cost(df)
    naive = (
        F.lit(_NAIVE_RATE) * F.coalesce(F.col("duration_p90"), F.lit(12.0))
        + F.lit(float(C.NAIVE_PLAN["barricades"] * C.COST_RATES["barricade"]))
        + F.lit(float(C.NAIVE_PLAN["equipment"]))
    )
    df = df.withColumn("naive_total_inr", naive)
    sav = F.greatest(F.lit(0.0), F.col("naive_total_inr") - F.col("total_estimated_cost_inr"))
    return df.withColumns(
        {
            "savings_inr": sav,
            "savings_pct": F.when(F.col("naive_total_inr") > 0, sav / F.col("naive_total_inr") * 100).otherwise(F.lit(0.0)),
        }
    )


def savings_rollup(df: DataFrame) -> DataFrame:
    """Plans, naive cost and savings by cause, by corridor and in all (null keys: all of them), in one grouping-sets pass."""
    keys = [F.col("event_cause"), F.col("corridor")]
    total = df.groupingSets([[keys[0]], [keys[1]], []], *keys).agg(
        F.count(F.lit(1)).alias("plans"), F.sum("naive_total_inr").alias("naive_total_inr"), F.sum("savings_inr").alias("savings_inr")
    )
    share = F.when(F.col("naive_total_inr") > 0, F.col("savings_inr") / F.col("naive_total_inr") * 100).otherwise(F.lit(0.0))
    return total.withColumn("savings_pct", share)


def affected_zone(df: DataFrame, points: int = 40) -> DataFrame:
    """Radius by severity, escape legs by thresholds and where they end, and the closed outline (points+1 vertices)."""
    proba = F.coalesce(F.col("severity_proba"), F.lit(0.5))
    r = F.lit(0.002) + proba * F.lit(0.015)
    df = df.withColumn("zone_radius_deg", r)
    legs = F.concat(
        F.array(F.lit("Primary Escape (East)")),
        F.when(proba >= 0.3, F.array(F.lit("Secondary Escape (West)"))).otherwise(F.array().cast("array<string>")),
        F.when(proba >= 0.6, F.array(F.lit("Alternative Corridor (North)"))).otherwise(F.array().cast("array<string>")),
        F.when(proba >= 0.8, F.array(F.lit("Emergency Corridor (South)"))).otherwise(F.array().cast("array<string>")),
    )
    rad, lat, lng = F.col("zone_radius_deg"), F.col("latitude"), F.col("longitude")
    # Where each leg leaves the zone: east, west, north, south, as many as there are legs.
    ends = F.array(*[F.struct((lat + a * rad).alias("lat"), (lng + b * rad / F.lit(0.97)).alias("lng")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    outline = F.transform(
        F.sequence(F.lit(0), F.lit(points)),
        lambda i: F.struct(
            (lat + rad * F.cos(i / F.lit(points) * F.lit(2 * math.pi))).alias("lat"),
            (lng + (rad / F.lit(0.97)) * F.sin(i / F.lit(points) * F.lit(2 * math.pi))).alias("lng"),
        ),
    )
    return df.withColumns(
        {
            "zone_radius_km": rad * 111,
            "escape_routes": legs,
            "escape_ends": F.slice(ends, F.lit(1), F.size(legs)),
            "zone_outline": outline,
        }
    )


def recommend(df: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """Full plan: R1–R9 in one projection chain."""
    df = alert_level(df)
    df = manpower(df, factors)
    df = barricading(df)
    df = diversion(df)
    df = duration_estimate(df)
    df = equipment(df)
    df = communication(df)
    return estimated_cost(df)


PLAN_FIELDS = {
    "alert_level": ["alert_level", "alert_color", "alert_description"],
    "manpower": ["total_personnel", "traffic_officers", "constables", "support_staff", "shifts_needed", "manpower_formula"],
    "barricading": ["barricade_type", "barricade_count", "cones_required", "signage_boards",
                    "temporary_fencing_meters", "reflective_tape_meters", "emergency_lighting"],
    "diversion": ["diversion_primary", "diversion_secondary", "diversion_avoid", "diversion_closure_needed", "diversion_advisory"],
    "duration_estimate": ["expected_hours", "best_case_hours", "median_hours", "worst_case_hours", "confidence_interval"],
    "communication": ["communication_actions", "communication_priority"],
    "estimated_cost": ["manpower_cost_inr", "barricade_cost_inr", "equipment_cost_inr", "total_estimated_cost_inr", "total_formatted"],
}


def plan_struct(df: DataFrame) -> Column:
    """Nested plan struct (for JSON export), built from the flat plan columns."""
    parts = [F.struct(*[F.col(c) for c in cols]).alias(name) for name, cols in PLAN_FIELDS.items()]
    parts.append(F.col("equipment"))
    return F.struct(*parts)
