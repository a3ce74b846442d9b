"""Registered streaming queries (ST1–ST4), each drained with ``availableNow`` and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import feedback as FB
from roadpulse.registry.common import i64, r6, register, ts_txt, with_clean, with_scored
from roadpulse.registry.plan_queries import plan_ctes
from roadpulse.sources.incidents import with_pseudo_predictions
from roadpulse.streaming import streams as S


@register(
    "st1_incident_stream",
    with_clean(f"SELECT id, event_cause, {ts_txt('start_datetime')} AS start_datetime, {r6('resolution_hours')} AS resolution_hours FROM clean"),
)
def st1(spark, sf_dir):
    clean = S.incident_stream(S.events_stream(spark, sf_dir))
    out = S.run_available_now(clean.select("id", "event_cause", "start_datetime", "resolution_hours"), "st1")
    return out


_BUCKET6 = "make_timestamp(CAST(floor(epoch_us(start_datetime) / 21600000000) * 21600000000 AS BIGINT))"


@register(
    "st2_tumbling_6h",
    with_clean(
        f"""SELECT {ts_txt(_BUCKET6)} AS window_start, {ts_txt(_BUCKET6 + ' + INTERVAL 6 HOUR')} AS window_end, corridor,
  CAST(count(*) AS BIGINT) AS events FROM clean GROUP BY 1, 2, 3"""
    ),
)
def st2(spark, sf_dir):
    clean = S.incident_stream(S.events_stream(spark, sf_dir))
    return S.run_available_now(S.corridor_pressure(clean, "tumbling"), "st2t", mode="update",
                               keep_latest_by=["window_start", "window_end", "corridor"])


_HOUR = "make_timestamp(CAST(floor(epoch_us(start_datetime) / 3600000000) * 3600000000 AS BIGINT))"


@register(
    "st2_sliding_24h",
    with_clean(
        f"""SELECT {ts_txt('ws')} AS window_start, {ts_txt('ws + INTERVAL 24 HOUR')} AS window_end, corridor, CAST(count(*) AS BIGINT) AS events
FROM (SELECT corridor, {_HOUR} - to_hours(CAST(r.j AS BIGINT)) AS ws FROM clean, range(24) r(j)) GROUP BY ws, corridor"""
    ),
)
def st2s(spark, sf_dir):
    clean = S.incident_stream(S.events_stream(spark, sf_dir))
    return S.run_available_now(S.corridor_pressure(clean, "sliding"), "st2s", mode="update",
                               keep_latest_by=["window_start", "window_end", "corridor"])


@register(
    "st2_session_bursts",
    with_clean(
        f"""SELECT {ts_txt('min(start_datetime)')} AS window_start, {ts_txt('max(start_datetime) + INTERVAL 30 MINUTE')} AS window_end, corridor,
  CAST(count(*) AS BIGINT) AS events
FROM (SELECT *, sum(opens) OVER (PARTITION BY corridor ORDER BY start_datetime ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT corridor, start_datetime, CASE WHEN start_datetime - lag(start_datetime) OVER (PARTITION BY corridor ORDER BY start_datetime)
                   <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM clean))
GROUP BY corridor, session"""
    ),
)
def st2b(spark, sf_dir):
    """Bursts: session windows closing after 30 min without an incident on the corridor; at the end all are closed."""
    clean = S.incident_stream(S.events_stream(spark, sf_dir))
    base = S.sink_dir(spark, "st2b")
    closed = S.run_available_now(S.corridor_pressure(clean, "session"), "st2b", base=base)
    return closed.unionByName(S.open_sessions(spark, base))


@register(
    "st3_stream_plans",
    with_scored(
        f"SELECT id, {i64('alert_level')} AS alert_level, {i64('total_personnel')} AS total_personnel,"
        f" {i64('total_estimated_cost_inr')} AS total_estimated_cost_inr, equipment FROM plf",
        *plan_ctes(),
    ),
)
def st3(spark, sf_dir):
    clean = S.incident_stream(S.events_stream(spark, sf_dir), with_keys=True)
    plans = S.scored_plan_stream(clean).select("id", "alert_level", "total_personnel", "total_estimated_cost_inr", "equipment")
    return S.run_available_now(plans, "st3")


def _joined(spark, sf_dir, how="inner"):
    preds = with_pseudo_predictions(S.incident_stream(S.events_stream(spark, sf_dir), watermark=None, with_keys=True)).select(
        F.col("id").alias("pid"), F.col("start_datetime").alias("predicted_at"), "event_cause", "severity_proba", "duration_mean"
    )
    outs = S.incident_stream(S.events_stream(spark, sf_dir), watermark=None).where(F.col("closed_datetime_combined").isNotNull()).select(
        F.col("id").alias("oid"), F.col("closed_datetime_combined").alias("closed_at"), "resolution_hours", "priority_binary"
    )
    j = S.prediction_outcome_join(preds, outs, how=how).select(
        "pid", "predicted_at", "closed_at", "event_cause", "severity_proba", "duration_mean", "resolution_hours", "priority_binary"
    )
    base = S.sink_dir(spark, "st4")
    with S.rocksdb_state(spark):
        done = S.run_available_now(j, "st4", base=base)
        return done.unionByName(S.open_predictions(spark, base, done)) if how == "left_outer" else done


_ST4 = """SELECT * FROM sc WHERE closed_datetime_combined IS NOT NULL
  AND closed_datetime_combined >= start_datetime AND closed_datetime_combined <= start_datetime + INTERVAL 720 HOUR"""


@register(
    "st4_prediction_outcome_join",
    with_scored(
        f"""SELECT id AS pid, {ts_txt('start_datetime')} AS predicted_at, {ts_txt('closed_datetime_combined')} AS closed_at,
  {r6('severity_proba')} AS severity_proba, {r6('resolution_hours')} AS resolution_hours FROM ({_ST4})"""
    ),
)
def st4(spark, sf_dir):
    return _joined(spark, sf_dir).select("pid", "predicted_at", "closed_at", "severity_proba", "resolution_hours")


@register(
    "st4_outer_join",
    with_scored(
        f"""SELECT id AS pid, {ts_txt('start_datetime')} AS predicted_at, CASE WHEN met THEN {ts_txt('closed_datetime_combined')} END AS closed_at,
  {r6('severity_proba')} AS severity_proba, CASE WHEN met THEN {r6('resolution_hours')} END AS resolution_hours
FROM (SELECT *, closed_datetime_combined >= start_datetime AND closed_datetime_combined <= start_datetime + INTERVAL 720 HOUR AS met FROM sc)"""
    ),
)
def st4o(spark, sf_dir):
    """Every prediction, with its outcome or without."""
    return _joined(spark, sf_dir, "left_outer").select("pid", "predicted_at", "closed_at", "severity_proba", "resolution_hours")


@register(
    "st4_bias_rollup",
    with_scored(
        f"""SELECT event_cause, CAST(count(*) AS BIGINT) AS count, {r6('avg(severity_proba) - avg(priority_binary)')} AS severity_bias,
  {r6('avg(duration_mean) FILTER (WHERE resolution_hours > 0)')} AS predicted_mean_hours,
  {r6('avg(resolution_hours) FILTER (WHERE resolution_hours > 0)')} AS actual_mean_hours
FROM ({_ST4}) GROUP BY event_cause"""
    ),
)
def st4b(spark, sf_dir):
    j = _joined(spark, sf_dir)
    pos = F.col("resolution_hours") > 0
    return j.groupBy("event_cause").agg(
        F.count(F.lit(1)).alias("count"),
        (F.avg("severity_proba") - F.avg("priority_binary")).alias("severity_bias"),
        F.avg(F.when(pos, F.col("duration_mean"))).alias("predicted_mean_hours"),
        F.avg(F.when(pos, F.col("resolution_hours"))).alias("actual_mean_hours"),
    )
