"""Post-event feedback (F1–F8): prediction log, actuals, bias by cause, correction factors.

Everything is a group-by over causes (partial aggregation, so a hot cause is
combined map-side) or a join keyed by event id; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.rounding import py_round
from roadpulse.operators.quantiles import exact_quantiles

LOG_COLUMNS = [
    "event_id", "logged_at", "event_cause", "corridor", "predicted_severity", "predicted_severity_proba",
    "predicted_duration_hours", "predicted_closure", "predicted_closure_proba", "predicted_manpower",
]


def prediction_log(scored: DataFrame, logged_at=None) -> DataFrame:
    """F1: project a scored (and optionally planned) table to the log schema."""
    ts = logged_at if logged_at is not None else F.current_timestamp()
    manpower = F.col("total_personnel") if "total_personnel" in scored.columns else F.lit(None).cast("int")
    return scored.select(
        F.col("id").alias("event_id"),
        ts.alias("logged_at"),
        "event_cause",
        "corridor",
        F.col("severity").alias("predicted_severity"),
        F.col("severity_proba").alias("predicted_severity_proba"),
        F.col("duration_p50").alias("predicted_duration_hours"),
        F.col("closure_needed").alias("predicted_closure"),
        F.col("closure_proba").alias("predicted_closure_proba"),
        manpower.alias("predicted_manpower"),
    )


def append_batch(rows: DataFrame, path: str, batch: str) -> int:
    """F1 sink: adds ``rows`` to the table at ``path`` as the batch of that name; the same batch again replaces itself.

    A batch counts from the moment its line stands in the manifest, so a half-written one is
    never read, and a job that is run again after a failure leaves one copy.  Returns its rows.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/data/batch={batch}")
    n = spark.read.parquet(f"{path}/data/batch={batch}").count()
    line = spark.createDataFrame([(n,)], "rows long").withColumn("appended_at", F.current_timestamp())
    line.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")
    return n


def read_batches(spark, path: str) -> DataFrame:
    """The rows of all complete batches at ``path``."""
    text = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in text}
    for k, v in text.items():  # batch names stay text
        spark.conf.set(k, v)
    try:
        data, manifest = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/manifest")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return data.join(manifest.select("batch"), "batch", "left_semi").drop("batch")


def read_log(spark, path: str, actuals_path: str) -> DataFrame:
    """F2 on read: the prediction log with the latest actual of each event among all actuals appended so far."""
    return update_actuals(read_batches(spark, path), read_batches(spark, actuals_path))


def update_actuals(log: DataFrame, actuals: DataFrame) -> DataFrame:
    """attach the latest actual of each event to the first log entry of that event.

    ``actuals``: ``event_id, actual_severity, actual_duration_hours, actual_closure,
    actual_manpower_deployed, updated_at``.  Later updates win (``max_by`` on
    ``updated_at``); only the first log entry per event id is updated, as in
    the reproduced behaviour.
    """
    latest = actuals.groupBy("event_id").agg(
        *[F.max_by(c, "updated_at").alias(c) for c in
          ["actual_severity", "actual_duration_hours", "actual_closure", "actual_manpower_deployed"]],
        F.max("updated_at").alias("updated_at"),
    )
    first = Window.partitionBy("event_id").orderBy("logged_at")
    ranked = log.withColumn("_first", F.row_number().over(first) == 1)
    joined = ranked.join(latest, on="event_id", how="left")
    acts = ["actual_severity", "actual_duration_hours", "actual_closure", "actual_manpower_deployed", "updated_at"]
    return joined.select(
        *[c for c in ranked.columns if c != "_first"],
        *[F.when(F.col("_first"), F.col(c)).alias(c) for c in acts],
    )


def severity_bias(scored: DataFrame, min_count: int = 5) -> DataFrame:
    """per cause with at least ``min_count`` rows: actual vs mean predicted High rate."""
    g = (
        scored.where(F.col("event_cause").isNotNull())
        .groupBy("event_cause")
        .agg(
            F.avg("priority_binary").alias("_actual"),
            F.avg("severity_proba").alias("_pred"),
            F.count(F.lit(1)).alias("count"),
        )
        .where(F.col("count") >= min_count)
    )
    return g.select(
        "event_cause",
        py_round(F.col("_actual"), 3).alias("actual_high_rate"),
        py_round(F.col("_pred"), 3).alias("predicted_high_rate"),
        py_round(F.col("_pred") - F.col("_actual"), 3).alias("bias"),
        "count",
    )


def duration_bias(scored: DataFrame, min_count: int = 5, pred_col: str = "duration_mean") -> DataFrame:
    """per cause over rows with a positive actual duration: mean actual vs mean predicted."""
    g = (
        scored.where(F.col("resolution_hours").isNotNull() & (F.col("resolution_hours") > 0) & F.col("event_cause").isNotNull())
        .groupBy("event_cause")
        .agg(
            F.avg("resolution_hours").alias("_actual"),
            F.avg(pred_col).alias("_pred"),
            F.count(F.lit(1)).alias("count"),
        )
        .where(F.col("count") >= min_count)
    )
    return g.select(
        "event_cause",
        py_round(F.col("_actual"), 2).alias("actual_mean_hours"),
        py_round(F.col("_pred"), 2).alias("predicted_mean_hours"),
        py_round(F.col("_pred") / F.greatest(F.col("_actual"), F.lit(0.1)), 3).alias("ratio"),
        "count",
    )


def overall_accuracy(scored: DataFrame, pred_col: str = "duration_mean") -> DataFrame:
    """severity/closure accuracy and duration error summary (one aggregate)."""
    valid = F.col("resolution_hours").isNotNull() & (F.col("resolution_hours") > 0)
    err = F.when(valid, F.col(pred_col) - F.col("resolution_hours"))
    sev_pred = (F.col("severity_proba") >= 0.5).cast("int")
    clo_pred = F.coalesce(F.col("closure_needed"), F.lit(False)).cast("int")
    med = exact_quantiles(scored.select(err.alias("_err")), "_err", [0.5], names=["duration_median_error_hours"])
    return scored.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg((sev_pred == F.col("priority_binary")).cast("double")).alias("severity_accuracy"),
        F.avg((clo_pred == F.col("road_closure_binary")).cast("double")).alias("closure_accuracy"),
        F.avg(err).alias("duration_bias_hours"),
        F.avg(F.abs(err)).alias("duration_mae_hours"),
        F.count(err).alias("duration_rows"),
    ).crossJoin(F.broadcast(med))


def correction_factors(sev_bias: DataFrame, dur_bias: DataFrame) -> DataFrame:
    """factor per cause of F3 from the rounded bias, then adjusted by the rounded F4 ratio."""
    b = F.col("bias")
    base = (
        F.when(b < -0.1, py_round(1 + F.abs(b) * 0.5, 2))
        .when(b > 0.1, py_round(F.greatest(F.lit(0.8), 1 - b * 0.3), 2))
        .otherwise(F.lit(1.0))
    )
    r = F.col("ratio")
    adj = F.when(r < 0.7, F.col("_f") * 1.2).when(r > 1.3, F.col("_f") * 0.9).otherwise(F.col("_f"))
    return (
        sev_bias.select("event_cause", "bias", base.alias("_f"))
        .join(dur_bias.select("event_cause", "ratio"), on="event_cause", how="left")
        .select("event_cause", F.when(r.isNull(), F.col("_f")).otherwise(adj).alias("factor"))
    )


def worst_predictions(log_with_actuals: DataFrame, n: int = 10) -> DataFrame:
    """top-n by absolute duration error (a bounded top-k, no global sort)."""
    err = F.abs(F.col("predicted_duration_hours") - F.col("actual_duration_hours"))
    return (
        log_with_actuals.where(err.isNotNull())
        .withColumn("duration_error", err)
        .orderBy(F.desc("duration_error"), "event_id")
        .limit(n)
    )


def top_bias(bias: DataFrame, n: int = 5, col: str = "bias") -> DataFrame:
    """causes with the largest absolute bias (or ``|ratio - 1|``)."""
    key = F.abs(F.col(col) - 1) if col == "ratio" else F.abs(F.col(col))
    return bias.withColumn("_k", key).orderBy(F.desc("_k"), "event_cause").limit(n).drop("_k")


def factor_presentation(factors: DataFrame) -> DataFrame:
    """F8: direction text and signed percentage."""
    f = F.col("factor")
    return factors.withColumns(
        {
            "direction": F.when(f > 1, F.lit("↑ Increase resources")).when(f < 1, F.lit("↓ Decrease resources")).otherwise(
                F.lit("= No change")
            ),
            "impact": F.concat(F.format_string("%+.0f", py_round((f - 1) * 100, 0)), F.lit("% adjustment")),
        }
    )
