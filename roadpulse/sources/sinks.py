"""Sinks (S3–S5) and their read-back.

* S3: the clean table as parquet partitioned by local start date, rows sorted
  within each file by start (``sortWithinPartitions``, no global sort).
* S4: report tables as JSON, read back with an explicit schema.
* S5: fitted feature state and models are saved by :mod:`roadpulse.operators.bundle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.config import DEFAULT, EngineConfig
from roadpulse.functions.timefns import local_time


def write_clean(clean: DataFrame, path: str, cfg: EngineConfig = DEFAULT, mode: str = "overwrite") -> None:
    """S3: ``start_date`` partitions make date filters (X2, A15) prune whole directories."""
    out = clean.withColumn("start_date", F.to_date(local_time(F.col("start_datetime"), cfg.timezone)))
    (
        out.hint("rebalance", "start_date")  # a day that holds most rows is split over tasks
        .sortWithinPartitions("start_datetime", "id")
        .write.mode(mode)
        .partitionBy("start_date")
        .parquet(path)
    )


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


REPORT_SCHEMAS = {
    "severity_bias": "event_cause string, actual_high_rate double, predicted_high_rate double, bias double, count bigint",
    "duration_bias": "event_cause string, actual_mean_hours double, predicted_mean_hours double, ratio double, count bigint",
    "correction_factors": "event_cause string, factor double",
    "final_metrics": "severity struct<roc_auc: double, f1: double, precision: double, recall: double>,"
    " duration struct<mae_hours: double, rmse_hours: double, r2: double, mae_log: double, coverage_80pct: double, coverage_50pct: double>,"
    " closure struct<roc_auc: double, f1: double, precision: double, recall: double, threshold: double>,"
    " training_samples bigint, test_samples bigint, total_features bigint",
}


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """One JSON folder per table (small report tables)."""
    for name, t in tables.items():
        t.write.mode("overwrite").json(f"{path}/{name}")


def read_report(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(T._parse_datatype_string(REPORT_SCHEMAS[name])).json(f"{path}/{name}")
