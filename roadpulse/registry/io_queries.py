"""Registered source/sink round trips."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from roadpulse.operators import evaluate as V
from roadpulse.operators import feedback as FB
from roadpulse.operators.clean import clean_incidents
from roadpulse.operators.features import split_condition
from roadpulse.operators.state import FeatureModel
from roadpulse.registry.common import TEST_SPLIT_DATE, load_clean, load_scored, r6, register, ts_txt, with_clean, with_scored
from roadpulse.registry.plan_queries import _COV, CTE_BIAS, _auc_sql, _confusion_sql
from roadpulse.session import checkpoint_dir
from roadpulse.sources import sinks
from roadpulse.sources.incidents import incidents_from_events, read_incidents_csv, read_table


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), "roadpulse", "io", f"{name}-{uuid.uuid4().hex}")


@register(
    "s1_csv_roundtrip",
    with_clean(
        f"SELECT id, event_cause, {ts_txt('start_datetime')} AS start_datetime, {r6('resolution_hours')} AS resolution_hours,"
        f" {r6('endlatitude')} AS endlatitude, priority, corridor FROM clean"
    ),
)
def s1(spark, sf_dir):
    """Raw incidents written as CSV text (NULL tokens, mixed timestamp text), scanned back with the raw contract, cleaned."""
    path = _scratch(spark, "raw-csv")
    raw = incidents_from_events(read_table(spark, sf_dir, "events"))
    raw.write.option("header", "true").option("nullValue", "NULL").csv(path)
    clean = clean_incidents(read_incidents_csv(spark, path))
    return clean.select("id", "event_cause", "start_datetime", "resolution_hours", "endlatitude", "priority", "corridor")


@register(
    "s3_partitioned_clean",
    with_clean("SELECT strftime(CAST(start_local AS DATE), '%Y-%m-%d') AS start_date, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY 1"),
)
def s3(spark, sf_dir):
    path = _scratch(spark, "clean")
    sinks.write_clean(load_clean(spark, sf_dir), path)
    back = sinks.read_clean(spark, path)
    return back.groupBy(F.date_format("start_date", "yyyy-MM-dd").alias("start_date")).agg(F.count(F.lit(1)).alias("n"))


@register("s4_report_roundtrip", with_scored(f"SELECT event_cause, {r6('factor')} AS factor FROM cf", CTE_BIAS))
def s4(spark, sf_dir):
    s = load_scored(spark, sf_dir)
    sev, dur = FB.severity_bias(s), FB.duration_bias(s)
    path = _scratch(spark, "report")
    sinks.write_report({"severity_bias": sev, "duration_bias": dur, "correction_factors": FB.correction_factors(sev, dur)}, path)
    return sinks.read_report(spark, path, "correction_factors")


THRESHOLD = 0.5
TOTAL_FEATURES = 65  # those of the severity model

_METRICS_SQL = f"""SELECT sa.roc_auc AS severity_roc_auc, s.f1 AS severity_f1, s.precision AS severity_precision, s.recall AS severity_recall,
  d.mae_hours, d.rmse_hours, d.r2, d.mae_log, c.coverage_80 AS coverage_80pct, c.coverage_50 AS coverage_50pct,
  ka.roc_auc AS closure_roc_auc, k.f1 AS closure_f1, k.precision AS closure_precision, k.recall AS closure_recall,
  CAST({THRESHOLD} AS DOUBLE) AS threshold, n.training_samples, n.test_samples, CAST({TOTAL_FEATURES} AS BIGINT) AS total_features
FROM ({_confusion_sql("priority_binary", f"severity_proba >= {THRESHOLD}")}) s, ({_auc_sql("priority_binary", "severity_proba")}) sa,
  ({_confusion_sql("road_closure_binary", f"closure_proba >= {THRESHOLD}")}) k, ({_auc_sql("road_closure_binary", "closure_proba")}) ka, ({_COV}) c,
  (SELECT {r6('avg(abs(p - y))')} AS mae_hours, {r6('sqrt(avg((p - y) * (p - y)))')} AS rmse_hours,
     {r6('1 - sum((p - y) * (p - y)) / sum((y - ybar) * (y - ybar))')} AS r2, {r6('avg(abs(ln(1 + p) - ln(1 + y)))')} AS mae_log
   FROM (SELECT resolution_hours AS y, duration_mean AS p, avg(resolution_hours) OVER () AS ybar FROM sc
         WHERE resolution_hours IS NOT NULL AND resolution_hours > 0)) d,
  (SELECT count(*) FILTER (WHERE start_local < TIMESTAMP '{TEST_SPLIT_DATE}') AS training_samples,
     count(*) FILTER (WHERE NOT (start_local < TIMESTAMP '{TEST_SPLIT_DATE}')) AS test_samples FROM sc) n"""


@register("s4_metrics_report", with_scored(_METRICS_SQL))
def s4_metrics(spark, sf_dir):
    """Figures of the three models over the scored table, written as one JSON record and read back."""
    s = load_scored(spark, sf_dir)
    s = s.withColumn("_severe", F.col("severity_proba") >= THRESHOLD).withColumn("_closed", F.col("closure_proba") >= THRESHOLD)
    auc = {k: V.roc_auc(s, label, score) for k, label, score in
           [("s", "priority_binary", "severity_proba"), ("c", "road_closure_binary", "closure_proba")]}
    severity = V.confusion(s, "priority_binary", "_severe").crossJoin(F.broadcast(auc["s"]))
    closure = V.confusion(s, "road_closure_binary", "_closed").crossJoin(F.broadcast(auc["c"])).withColumn("threshold", F.lit(THRESHOLD))
    duration = V.regression_metrics(s, "resolution_hours", "duration_mean").crossJoin(
        F.broadcast(V.interval_coverage(s, "resolution_hours", "duration_p10", "duration_p90", "duration_p25", "duration_p75")))
    early = split_condition(TEST_SPLIT_DATE)
    samples = s.agg(F.count_if(early).alias("training_samples"), F.count_if(~early).alias("test_samples"),
                    F.lit(TOTAL_FEATURES).cast("bigint").alias("total_features"))
    path = _scratch(spark, "metrics")
    sinks.write_report({"final_metrics": V.metrics_report(severity, duration, closure, samples)}, path)
    told = sinks.read_report(spark, path, "final_metrics")
    models = {"severity": ["roc_auc", "f1", "precision", "recall"], "closure": ["roc_auc", "f1", "precision", "recall"]}
    return told.select(
        *[F.col(f"{m}.{c}").alias(f"{m}_{c}") for m, cols in models.items() for c in cols],
        "duration.*", "closure.threshold", "training_samples", "test_samples", "total_features",
    )


@register(
    "s5_state_roundtrip",
    with_clean(
        f"""SELECT corridor, CAST(count(*) AS BIGINT) AS n, {r6('avg(resolution_hours)')} AS mean_resolution
FROM clean WHERE start_local < TIMESTAMP '{TEST_SPLIT_DATE}' GROUP BY corridor"""
    ),
)
def s5(spark, sf_dir):
    """Fitted state saved as parquet tables and loaded into a fresh model."""
    path = _scratch(spark, "state")
    FeatureModel().fit_split(load_clean(spark, sf_dir), TEST_SPLIT_DATE).save(path)
    loaded = FeatureModel.load(spark, path)
    return loaded.state["key_corridor"].select("corridor", "n", "mean_resolution")
