"""Registered queries for deployment plans (R1–R11), feedback (F1–F8), metrics (V1–V5, M5)
and the diverse sample (M9), all over the scored binding with pseudo-predictions."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.functions.rounding import py_round_sql as prs
from roadpulse.operators import evaluate as V
from roadpulse.operators import feedback as FB
from roadpulse.operators.features import split_condition
from roadpulse.plans import deployment as R
from roadpulse.plans.zones import zone_counts
from roadpulse.registry.common import TEST_SPLIT_DATE, i64, load_scored, r6, register, with_scored
from roadpulse.session import checkpoint_dir, materialize

# ---------------------------------------------------------------------------
# DuckDB plan CTE
# ---------------------------------------------------------------------------


def _case(col: str, mapping: dict, default: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items()) + f" ELSE {default} END"


def _sq(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


_ALERT_COLOR = "CASE alert_level " + " ".join(f"WHEN {lv} THEN {_sq(c)}" for lv, c, _ in C.ALERT_LEVELS) + " END"
_ALERT_DESC = "CASE alert_level " + " ".join(f"WHEN {lv} THEN {_sq(d)}" for lv, _, d in C.ALERT_LEVELS) + " END"
_DIV = {
    i: "CASE corridor " + " ".join(f"WHEN {_sq(k)} THEN {_sq(v[i])}" for k, v in C.DIVERSIONS.items())
    + f" ELSE {_sq(C.DIVERSION_DEFAULT[i])} END"
    for i in range(3)
}
_EQUIP = (
    "array_to_string(list_concat([" + ", ".join(_sq(s) for s in C.BASE_EQUIPMENT) + "], CASE event_cause "
    + " ".join(f"WHEN {_sq(k)} THEN [" + ", ".join(_sq(s) for s in v) + "]" for k, v in C.CAUSE_EQUIPMENT.items())
    + " ELSE CAST([] AS VARCHAR[]) END), '|')"
)
_ACTIONS = "concat_ws('|', " + ", ".join(f"CASE WHEN alert_level >= {n} THEN {_sq(a)} END" for n, a in C.COMMUNICATION_ACTIONS) + ")"
_NAIVE = repr(
    C.NAIVE_PLAN["personnel"] * 0.4 * C.COST_RATES["officer"]
    + C.NAIVE_PLAN["personnel"] * 0.4 * C.COST_RATES["constable"]
    + C.NAIVE_PLAN["personnel"] * 0.2 * C.COST_RATES["support"]
)
_TWO_PI = repr(2 * math.pi)


def plan_ctes(factor_join: bool = False) -> list[str]:
    corr = "coalesce(cf.factor, 1.0e0)" if factor_join else "1.0e0"
    src = "sc LEFT JOIN cf ON sc.event_cause = cf.event_cause" if factor_join else "sc"
    p1 = f"""pl1 AS (
  SELECT sc.*, {corr} AS correction_factor,
    (severity_proba > 0.5) AS _sev, closure_needed AS _clo, (duration_p50 > 6) AS _long,
    {_case('sc.event_cause', C.MANPOWER_BASE, str(C.MANPOWER_BASE_DEFAULT))} AS _base,
    CASE WHEN severity_proba > 0.5 THEN 1.5e0 ELSE 1.0e0 END AS _sev_mult,
    CASE WHEN is_rush_hour <> 0 THEN 1.3e0 ELSE 1.0e0 END AS _rush_mult,
    CASE WHEN closure_needed THEN 1.5e0 ELSE 1.0e0 END AS _clo_mult,
    CASE WHEN duration_p50 > 12 THEN 1.5e0 WHEN duration_p50 > 6 THEN 1.2e0 ELSE 1.0e0 END AS _dur_mult,
    CASE WHEN closure_needed THEN 'full_closure' WHEN closure_proba > 0.3 THEN 'partial_closure' ELSE 'no_closure' END AS barricade_type
  FROM {src}
)"""
    p2 = f"""pl2 AS (
  SELECT *,
    CASE CAST(_sev AS INT) + CAST(_clo AS INT) + CAST(_long AS INT) WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3
         ELSE CASE WHEN _sev AND _clo AND NOT _long THEN 4 ELSE 5 END END AS alert_level,
    CAST(ceil(CAST(_base AS DOUBLE) * _sev_mult * _rush_mult * _clo_mult * _dur_mult * correction_factor) AS INTEGER) AS total_personnel,
    {_case('barricade_type', C.BARRICADE_BASE, 'NULL')} AS barricade_count
  FROM pl1
)"""
    p3 = f"""pl AS (
  SELECT *,
    {_ALERT_COLOR} AS alert_color, {_ALERT_DESC} AS alert_description,
    greatest(2, CAST(trunc(total_personnel * 0.4e0) AS INTEGER)) AS traffic_officers,
    CAST(trunc(total_personnel * 0.4e0) AS INTEGER) AS constables,
    greatest(1, CAST(trunc(total_personnel * 0.2e0) AS INTEGER)) AS support_staff,
    greatest(1, CAST(ceil(duration_p50 / 8) AS INTEGER)) AS shifts_needed,
    printf('Base(%d) × Severity(%s) × Rush(%s) × Closure(%s) × Duration(%s)', _base, CAST(_sev_mult AS VARCHAR),
           printf('%.1f', {prs('_rush_mult', 1)}), printf('%.1f', {prs('_clo_mult', 1)}), printf('%.1f', {prs('_dur_mult', 1)})) AS manpower_formula,
    barricade_count * 4 AS cones_required,
    greatest(2, barricade_count // 2) AS signage_boards,
    CASE WHEN event_cause IN ('construction', 'public_event', 'procession') THEN CASE WHEN _clo THEN 100 ELSE 50 END END AS temporary_fencing_meters,
    CASE WHEN event_cause = 'accident' THEN 30 END AS reflective_tape_meters,
    CASE WHEN event_cause = 'accident' THEN 1 END AS emergency_lighting,
    {_DIV[0]} AS diversion_primary, {_DIV[1]} AS diversion_secondary, {_DIV[2]} AS diversion_avoid,
    CAST(_clo AS INTEGER) AS diversion_closure_needed,
    CASE WHEN _clo THEN {_sq(C.ADVISORY_CLOSURE)} ELSE {_sq(C.ADVISORY_PARTIAL)} END AS diversion_advisory,
    {prs('duration_mean', 1)} AS expected_hours, {prs('duration_p10', 1)} AS best_case_hours,
    {prs('duration_p50', 1)} AS median_hours, {prs('duration_p90', 1)} AS worst_case_hours,
    printf('%.1f', {prs('duration_p25', 1)}) || ' – ' || printf('%.1f', {prs('duration_p75', 1)}) || ' hours (50% CI)' AS confidence_interval,
    {_EQUIP} AS equipment,
    {_ACTIONS} AS communication_actions
  FROM pl2
)"""
    p4 = f"""plc AS (
  SELECT *, {_ALERT_COLOR} AS communication_priority,
    traffic_officers * 500 * duration_p50 + constables * 300 * duration_p50 + support_staff * 200 * duration_p50 AS _mp,
    CAST(barricade_count * 50 AS DOUBLE) AS _bc,
    CASE WHEN _clo THEN 2000.0e0 ELSE 500.0e0 END AS _ec
  FROM pl
),
plf AS (
  SELECT *,
    CAST({prs('_mp', 0)} AS BIGINT) AS manpower_cost_inr, CAST({prs('_bc', 0)} AS BIGINT) AS barricade_cost_inr,
    CAST({prs('_ec', 0)} AS BIGINT) AS equipment_cost_inr, CAST({prs('_mp + _bc + _ec', 0)} AS BIGINT) AS total_estimated_cost_inr,
    '₹' || format('{{:,.0f}}', {prs('_mp + _bc + _ec', 0)}) AS total_formatted,
    {_NAIVE} * duration_p90 + 600.0e0 + 2000.0e0 AS naive_total_inr
  FROM plc
)"""
    return [p1, p2, p3, p4]


def _cols_sql(cols: list[str], ints: set[str], strs: set[str]) -> str:
    return ", ".join(c if c in strs else (f"{i64(c)} AS {c}" if c in ints else f"{r6(c)} AS {c}") for c in cols)


_INTS = {
    "alert_level", "total_personnel", "traffic_officers", "constables", "support_staff", "shifts_needed",
    "barricade_count", "cones_required", "signage_boards", "temporary_fencing_meters", "reflective_tape_meters",
    "emergency_lighting", "diversion_closure_needed", "manpower_cost_inr", "barricade_cost_inr",
    "equipment_cost_inr", "total_estimated_cost_inr",
}
_STRS = {
    "id", "alert_color", "alert_description", "manpower_formula", "barricade_type", "diversion_primary",
    "diversion_secondary", "diversion_avoid", "diversion_advisory", "confidence_interval", "equipment",
    "communication_actions", "communication_priority", "total_formatted",
}


def plan_query(name: str, cols: list[str]):
    sql = with_scored(f"SELECT id, {_cols_sql(cols, _INTS, _STRS)} FROM plf", *plan_ctes())

    @register(name, sql)
    def q(spark, sf_dir):
        return R.recommend(load_scored(spark, sf_dir)).select("id", *cols)

    return q


for _name, _fields in [
    ("r1_alert_level", "alert_level"),
    ("r2_manpower", "manpower"),
    ("r3_barricading", "barricading"),
    ("r4_diversion", "diversion"),
    ("r5_duration_estimate", "duration_estimate"),
    ("r7_communication", "communication"),
    ("r8_estimated_cost", "estimated_cost"),
]:
    plan_query(_name, R.PLAN_FIELDS[_fields])
plan_query("r6_equipment", ["equipment"])


# ---------------------------------------------------------------------------
# Feedback (F3, F4, F6) — shared SQL
# ---------------------------------------------------------------------------

CTE_BIAS = f"""sb AS (
  SELECT event_cause, {prs('avg(priority_binary)', 3)} AS actual_high_rate, {prs('avg(severity_proba)', 3)} AS predicted_high_rate,
         {prs('avg(severity_proba) - avg(priority_binary)', 3)} AS bias, count(*) AS count
  FROM sc WHERE event_cause IS NOT NULL GROUP BY event_cause HAVING count(*) >= 5
),
db AS (
  SELECT event_cause, {prs('avg(resolution_hours)', 2)} AS actual_mean_hours, {prs('avg(duration_mean)', 2)} AS predicted_mean_hours,
         {prs('avg(duration_mean) / greatest(avg(resolution_hours), 0.1e0)', 3)} AS ratio, count(*) AS count
  FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0 AND event_cause IS NOT NULL
  GROUP BY event_cause HAVING count(*) >= 5
),
cf AS (
  SELECT sb.event_cause,
    CASE WHEN db.ratio IS NULL THEN f WHEN db.ratio < 0.7 THEN f * 1.2e0 WHEN db.ratio > 1.3 THEN f * 0.9e0 ELSE f END AS factor
  FROM (SELECT event_cause, CASE WHEN bias < -0.1 THEN {prs('1 + abs(bias) * 0.5e0', 2)}
                                 WHEN bias > 0.1 THEN {prs('greatest(0.8e0, 1 - bias * 0.3e0)', 2)} ELSE 1.0e0 END AS f
        FROM sb) sb LEFT JOIN db ON sb.event_cause = db.event_cause
)"""


def _factors(scored):
    return FB.correction_factors(FB.severity_bias(scored), FB.duration_bias(scored))


@register(
    "r9_correction_factors_applied",
    with_scored(
        f"SELECT id, {r6('correction_factor')} AS correction_factor, {i64('total_personnel')} AS total_personnel FROM plf",
        CTE_BIAS, *plan_ctes(factor_join=True),
    ),
)
def r9(spark, sf_dir):
    scored = load_scored(spark, sf_dir)
    return R.manpower(scored, _factors(scored)).select("id", "correction_factor", "total_personnel")


@register(
    "r10_savings_vs_naive",
    with_scored(
        f"""SELECT id, {r6('naive_total_inr')} AS naive_total_inr,
  {r6('greatest(0.0e0, naive_total_inr - total_estimated_cost_inr)')} AS savings_inr,
  {r6('CASE WHEN naive_total_inr > 0 THEN greatest(0.0e0, naive_total_inr - total_estimated_cost_inr) / naive_total_inr * 100 ELSE 0.0e0 END')} AS savings_pct
FROM plf""",
        *plan_ctes(),
    ),
)
def r10(spark, sf_dir):
    return R.savings_vs_naive(R.recommend(load_scored(spark, sf_dir))).select("id", "naive_total_inr", "savings_inr", "savings_pct")


@register(
    "r10_savings_rollup",
    with_scored(
        f"""SELECT event_cause, corridor, CAST(count(*) AS BIGINT) AS plans, {r6('sum(naive_total_inr)')} AS naive_total_inr,
  {r6('sum(s)')} AS savings_inr, {r6('CASE WHEN sum(naive_total_inr) > 0 THEN sum(s) / sum(naive_total_inr) * 100 ELSE 0.0e0 END')} AS savings_pct
FROM (SELECT *, greatest(0.0e0, naive_total_inr - total_estimated_cost_inr) AS s FROM plf)
GROUP BY GROUPING SETS ((event_cause), (corridor), ())""",
        *plan_ctes(),
    ),
)
def r10_rollup(spark, sf_dir):
    """Savings by cause, by corridor and in all, from one pass over the plans."""
    return R.savings_rollup(R.savings_vs_naive(R.recommend(load_scored(spark, sf_dir))))


@register(
    "r11_affected_zone",
    with_scored(
        f"""SELECT id, {r6('r')} AS zone_radius_deg, {r6('r * 111')} AS zone_radius_km,
  concat_ws('|', 'Primary Escape (East)', CASE WHEN p >= 0.3 THEN 'Secondary Escape (West)' END,
            CASE WHEN p >= 0.6 THEN 'Alternative Corridor (North)' END, CASE WHEN p >= 0.8 THEN 'Emergency Corridor (South)' END) AS escape_routes,
  CAST(41 AS BIGINT) AS outline_points,
  {r6('latitude + r * cos(0 / 40 * ' + _TWO_PI + ')')} AS outline_north_lat,
  {r6('longitude + (r / 0.97e0) * sin(10 / 40 * ' + _TWO_PI + ')')} AS outline_east_lng
FROM (SELECT *, severity_proba AS p, 0.002e0 + severity_proba * 0.015e0 AS r FROM sc)"""
    ),
)
def r11(spark, sf_dir):
    z = R.affected_zone(load_scored(spark, sf_dir))
    return z.select(
        "id", "zone_radius_deg", "zone_radius_km", "escape_routes",
        F.size("zone_outline").alias("outline_points"),
        F.col("zone_outline")[0]["lat"].alias("outline_north_lat"),
        F.col("zone_outline")[10]["lng"].alias("outline_east_lng"),
    )


@register(
    "r11_zone_counts",
    with_scored(
        """SELECT a.id, CAST(count(b.id) AS BIGINT) AS incidents_inside
FROM (SELECT id, latitude AS x, longitude * 0.97e0 AS y, 0.002e0 + severity_proba * 0.015e0 AS r FROM sc WHERE latitude IS NOT NULL AND longitude IS NOT NULL) a
JOIN (SELECT id, latitude AS x, longitude * 0.97e0 AS y FROM sc) b
  ON b.x BETWEEN a.x - 0.02e0 AND a.x + 0.02e0 AND (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) <= a.r * a.r
GROUP BY a.id"""
    ),
)
def r11_counts(spark, sf_dir):
    """How many incidents lie in each incident's zone."""
    zones = materialize(R.affected_zone(load_scored(spark, sf_dir)).select("id", "latitude", "longitude", "zone_radius_deg"), "zones")
    return zone_counts(zones, zones)


@register(
    "f1_prediction_log",
    with_scored(
        f"""SELECT id AS event_id, event_cause, corridor, severity AS predicted_severity,
  {r6('severity_proba')} AS predicted_severity_proba, {r6('duration_p50')} AS predicted_duration_hours,
  {i64('closure_needed')} AS predicted_closure, {r6('closure_proba')} AS predicted_closure_proba,
  {i64('total_personnel')} AS predicted_manpower
FROM plf""",
        *plan_ctes(),
    ),
)
def f1(spark, sf_dir):
    log = FB.prediction_log(R.recommend(load_scored(spark, sf_dir)))
    return log.drop("logged_at")


def _log_and_actuals(scored):
    log = FB.prediction_log(scored, logged_at=F.col("start_datetime"))
    first = scored.select(
        F.col("id").alias("event_id"), F.col("priority").alias("actual_severity"),
        F.col("resolution_hours").alias("actual_duration_hours"), F.col("road_closure_binary").alias("actual_closure"),
        F.lit(None).cast("int").alias("actual_manpower_deployed"), F.col("created_date").alias("updated_at"),
    )
    # A provisional report at creation and the final one at closure: the later one must win.
    final = scored.select(
        F.col("id").alias("event_id"), F.col("priority").alias("actual_severity"),
        (F.col("resolution_hours") * 1.0).alias("actual_duration_hours"), F.col("road_closure_binary").alias("actual_closure"),
        F.col("total_personnel").alias("actual_manpower_deployed") if "total_personnel" in scored.columns else F.lit(None).cast("int").alias("actual_manpower_deployed"),
        F.coalesce(F.col("closed_datetime_combined"), F.col("created_date")).alias("updated_at"),
    ).where(F.col("closed_datetime_combined") > F.col("created_date"))
    first = first.withColumn("actual_duration_hours", F.lit(None).cast("double"))
    return log, first.unionByName(final)


@register(
    "f2_update_actuals",
    with_scored(
        f"""SELECT id AS event_id, {r6('duration_p50')} AS predicted_duration_hours,
  {r6('CASE WHEN closed_datetime_combined > created_date THEN resolution_hours END')} AS actual_duration_hours,
  priority AS actual_severity, {i64('road_closure_binary')} AS actual_closure
FROM sc"""
    ),
)
def f2(spark, sf_dir):
    log, actuals = _log_and_actuals(load_scored(spark, sf_dir))
    return FB.update_actuals(log, actuals).select(
        "event_id", "predicted_duration_hours", "actual_duration_hours", "actual_severity", "actual_closure"
    )


@register(
    "f2_log_batches",
    with_scored(
        f"""SELECT id AS event_id, {r6('duration_p50')} AS predicted_duration_hours,
  {r6('CASE WHEN closed_datetime_combined > created_date THEN resolution_hours END')} AS actual_duration_hours,
  priority AS actual_severity, {i64('road_closure_binary')} AS actual_closure
FROM sc"""
    ),
)
def f2b(spark, sf_dir):
    """The log kept in batches, one of them appended twice, and read with the actuals appended since."""
    log, actuals = _log_and_actuals(load_scored(spark, sf_dir))
    base = f"{checkpoint_dir(spark)}/roadpulse/log-{uuid.uuid4().hex}"
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for name, part in (("0", 0), ("1", 1), ("0", 0)):
        FB.append_batch(log.where(half == part), f"{base}/predictions", name)
        FB.append_batch(actuals.where(half == part), f"{base}/actuals", name)
    return FB.read_log(spark, f"{base}/predictions", f"{base}/actuals").select(
        "event_id", "predicted_duration_hours", "actual_duration_hours", "actual_severity", "actual_closure"
    )


@register(
    "f3_severity_bias",
    with_scored(
        f"SELECT event_cause, {r6('actual_high_rate')} AS actual_high_rate, {r6('predicted_high_rate')} AS predicted_high_rate,"
        f" {r6('bias')} AS bias, CAST(count AS BIGINT) AS count FROM sb",
        CTE_BIAS,
    ),
)
def f3(spark, sf_dir):
    return FB.severity_bias(load_scored(spark, sf_dir))


@register(
    "f4_duration_bias",
    with_scored(
        f"SELECT event_cause, {r6('actual_mean_hours')} AS actual_mean_hours, {r6('predicted_mean_hours')} AS predicted_mean_hours,"
        f" {r6('ratio')} AS ratio, CAST(count AS BIGINT) AS count FROM db",
        CTE_BIAS,
    ),
)
def f4(spark, sf_dir):
    return FB.duration_bias(load_scored(spark, sf_dir))


@register(
    "f5_overall_accuracy",
    with_scored(
        f"""SELECT CAST(count(*) AS BIGINT) AS total_events,
  {r6('avg(CAST(CAST(severity_proba >= 0.5 AS INT) = priority_binary AS DOUBLE))')} AS severity_accuracy,
  {r6('avg(CAST(CAST(closure_needed AS INT) = road_closure_binary AS DOUBLE))')} AS closure_accuracy,
  {r6('avg(err)')} AS duration_bias_hours, {r6('quantile_cont(err, 0.5)')} AS duration_median_error_hours,
  {r6('avg(abs(err))')} AS duration_mae_hours, CAST(count(err) AS BIGINT) AS duration_rows
FROM (SELECT *, CASE WHEN resolution_hours IS NOT NULL AND resolution_hours > 0 THEN duration_mean - resolution_hours END AS err FROM sc)"""
    ),
)
def f5(spark, sf_dir):
    return FB.overall_accuracy(load_scored(spark, sf_dir))


@register("f6_correction_factors", with_scored(f"SELECT event_cause, {r6('factor')} AS factor FROM cf", CTE_BIAS))
def f6(spark, sf_dir):
    return _factors(load_scored(spark, sf_dir))


@register(
    "f7_worst_predictions",
    with_scored(
        f"""SELECT event_id, {r6('duration_error')} AS duration_error FROM (
  SELECT id AS event_id, abs(duration_p50 - resolution_hours) AS duration_error FROM sc
  WHERE closed_datetime_combined > created_date AND resolution_hours IS NOT NULL
) ORDER BY duration_error DESC, event_id LIMIT 10"""
    ),
)
def f7(spark, sf_dir):
    log, actuals = _log_and_actuals(load_scored(spark, sf_dir))
    return FB.worst_predictions(FB.update_actuals(log, actuals), 10).select("event_id", "duration_error")


@register(
    "f7_top_severity_bias",
    with_scored(f"SELECT event_cause, {r6('bias')} AS bias FROM sb ORDER BY abs(bias) DESC, event_cause LIMIT 5", CTE_BIAS),
)
def f7b(spark, sf_dir):
    return FB.top_bias(FB.severity_bias(load_scored(spark, sf_dir)), 5).select("event_cause", "bias")


@register(
    "f8_factor_presentation",
    with_scored(
        f"""SELECT event_cause, {r6('factor')} AS factor,
  CASE WHEN factor > 1 THEN '↑ Increase resources' WHEN factor < 1 THEN '↓ Decrease resources' ELSE '= No change' END AS direction,
  printf('%+.0f', {prs('(factor - 1) * 100', 0)}) || '% adjustment' AS impact
FROM cf""",
        CTE_BIAS,
    ),
)
def f8(spark, sf_dir):
    return FB.factor_presentation(_factors(load_scored(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Metrics
# ---------------------------------------------------------------------------


def _confusion_sql(label: str, pred: str) -> str:
    return f"""SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  {r6('prec')} AS precision, {r6('rec')} AS recall,
  {r6('CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END')} AS f1,
  {r6('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0e0 END AS prec,
                CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0e0 END AS rec
      FROM (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
                   count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn
            FROM (SELECT CAST({label} AS INT) AS y, CAST({pred} AS INT) AS p FROM sc)))"""


@register("v1_severity_confusion", with_scored(_confusion_sql("priority_binary", "severity_proba >= 0.5")))
def v1s(spark, sf_dir):
    s = load_scored(spark, sf_dir).withColumn("_p", F.col("severity_proba") >= 0.5)
    return V.confusion(s, "priority_binary", "_p")


@register("v1_closure_confusion", with_scored(_confusion_sql("road_closure_binary", "closure_needed")))
def v1c(spark, sf_dir):
    return V.confusion(load_scored(spark, sf_dir), "road_closure_binary", "closure_needed")


@register(
    "v1_severity_classes",
    with_scored(
        """SELECT cls AS class, CAST(sum(CAST(y = cls AS INTEGER)) AS BIGINT) AS support,
  round(CASE WHEN sum(CAST(p = cls AS INTEGER)) > 0 THEN sum(CAST(y = cls AND p = cls AS INTEGER)) / sum(CAST(p = cls AS INTEGER)) ELSE 0.0e0 END + 1e-9, 6) AS precision,
  round(CASE WHEN sum(CAST(y = cls AS INTEGER)) > 0 THEN sum(CAST(y = cls AND p = cls AS INTEGER)) / sum(CAST(y = cls AS INTEGER)) ELSE 0.0e0 END + 1e-9, 6) AS recall,
  round(CASE WHEN sum(CAST(y = cls AS INTEGER) + CAST(p = cls AS INTEGER)) > 0 THEN 2 * sum(CAST(y = cls AND p = cls AS INTEGER)) / sum(CAST(y = cls AS INTEGER) + CAST(p = cls AS INTEGER)) ELSE 0.0e0 END + 1e-9, 6) AS f1
FROM (SELECT priority_binary AS y, CAST(severity_proba >= 0.5 AS INTEGER) AS p FROM sc) , (VALUES (0), (1)) c(cls) GROUP BY cls"""
    ),
)
def v1_classes(spark, sf_dir):
    """Precision, recall, F1 and support of each class."""
    s = load_scored(spark, sf_dir).withColumn("_p", (F.col("severity_proba") >= 0.5).cast("int"))
    return V.class_report(s, "priority_binary", "_p", [0, 1])


def _auc_sql(label: str, score: str) -> str:
    return f"""SELECT {r6('sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg))')} AS roc_auc FROM (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM (
    SELECT CAST({score} AS DOUBLE) AS score, count(*) FILTER (WHERE {label} = 1) AS pos, count(*) FILTER (WHERE {label} = 0) AS neg
    FROM sc WHERE {score} IS NOT NULL GROUP BY 1))"""


@register("v2_severity_auc", with_scored(_auc_sql("priority_binary", "severity_proba")))
def v2s(spark, sf_dir):
    return V.roc_auc(load_scored(spark, sf_dir), "priority_binary", "severity_proba")


@register("v2_closure_auc", with_scored(_auc_sql("road_closure_binary", "closure_proba")))
def v2c(spark, sf_dir):
    return V.roc_auc(load_scored(spark, sf_dir), "road_closure_binary", "closure_proba")


@register(
    "v3_duration_regression",
    with_scored(
        f"""SELECT {r6('avg(abs(p - y))')} AS mae, {r6('sqrt(avg((p - y) * (p - y)))')} AS rmse,
  {r6('1 - sum((p - y) * (p - y)) / sum((y - ybar) * (y - ybar))')} AS r2,
  {r6('avg(abs(ln(1 + p) - ln(1 + y)))')} AS mae_log, {r6('sqrt(avg((ln(1 + p) - ln(1 + y)) * (ln(1 + p) - ln(1 + y))))')} AS rmse_log,
  {r6('1 - sum((ln(1 + p) - ln(1 + y)) * (ln(1 + p) - ln(1 + y))) / sum((ln(1 + y) - lybar) * (ln(1 + y) - lybar))')} AS r2_log,
  {r6('quantile_cont(abs(p - y), 0.5)')} AS median_ae, CAST(count(*) AS BIGINT) AS n
FROM (SELECT resolution_hours AS y, duration_mean AS p, avg(resolution_hours) OVER () AS ybar, avg(ln(1 + resolution_hours)) OVER () AS lybar
      FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0)"""
    ),
)
def v3(spark, sf_dir):
    return V.regression_metrics(load_scored(spark, sf_dir), "resolution_hours", "duration_mean")


_COV = f"""SELECT {r6('avg(CAST(y BETWEEN duration_p10 AND duration_p90 AS DOUBLE))')} AS coverage_80,
  {r6('avg(CAST(y BETWEEN duration_p25 AND duration_p75 AS DOUBLE))')} AS coverage_50
FROM (SELECT *, resolution_hours AS y FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0)"""


@register("v4_interval_coverage", with_scored(_COV))
def v4(spark, sf_dir):
    return V.interval_coverage(load_scored(spark, sf_dir), "resolution_hours", "duration_p10", "duration_p90", "duration_p25", "duration_p75")


@register(
    "v5_tuning_score",
    with_scored(
        f"""SELECT {r6('mae + 10 * greatest(0.0e0, 0.78e0 - coverage_80) + 10 * greatest(0.0e0, 0.48e0 - coverage_50)')} AS tuning_score
FROM (SELECT avg(abs(duration_mean - resolution_hours)) AS mae,
        avg(CAST(resolution_hours BETWEEN duration_p10 AND duration_p90 AS DOUBLE)) AS coverage_80,
        avg(CAST(resolution_hours BETWEEN duration_p25 AND duration_p75 AS DOUBLE)) AS coverage_50
      FROM sc WHERE resolution_hours IS NOT NULL AND resolution_hours > 0)"""
    ),
)
def v5(spark, sf_dir):
    s = load_scored(spark, sf_dir)
    m = V.regression_metrics(s, "resolution_hours", "duration_mean").select("mae").crossJoin(
        V.interval_coverage(s, "resolution_hours", "duration_p10", "duration_p90", "duration_p25", "duration_p75")
    )
    return V.tuning_score(m).select("tuning_score")


@register(
    "m5_best_f1_threshold",
    with_scored(
        f"""SELECT {r6('score')} AS threshold, {r6('prec')} AS precision, {r6('rec')} AS recall, {r6('f1')} AS f1 FROM (
  SELECT score, prec, rec, 2 * prec * rec / (prec + rec + 1e-8) AS f1 FROM (
    SELECT score, tp / (tp + fp) AS prec, tp / P AS rec FROM (
      SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS P FROM (
        SELECT CAST(closure_proba AS DOUBLE) AS score, count(*) FILTER (WHERE road_closure_binary = 1) AS pos,
               count(*) FILTER (WHERE road_closure_binary = 0) AS neg FROM sc GROUP BY 1)
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))
ORDER BY f1 DESC, score ASC LIMIT 1"""
    ),
)
def m5(spark, sf_dir):
    return V.best_f1_threshold(load_scored(spark, sf_dir), "road_closure_binary", "closure_proba")


_DIVERSE = ["public_event", "procession", "construction", "accident", "vehicle_breakdown"]


@register(
    "m9_diverse_sample",
    with_scored(
        f"""SELECT id, event_cause FROM (
  SELECT id, event_cause, row_number() OVER (PARTITION BY event_cause ORDER BY start_us, id) AS rn FROM sc
  WHERE NOT (start_local < TIMESTAMP '{TEST_SPLIT_DATE}') AND event_cause IN ({", ".join(_sq(c) for c in _DIVERSE)})
) WHERE rn = 1"""
    ),
)
def m9(spark, sf_dir):
    """First test event of each of five causes (by start, then id)."""
    return V.diverse_sample(load_scored(spark, sf_dir).where(~split_condition(TEST_SPLIT_DATE)), _DIVERSE).select("id", "event_cause")
