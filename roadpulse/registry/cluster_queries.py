"""Registered clustering queries (K1–K6)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from roadpulse.operators import clusters as K
from roadpulse.operators.features import split_condition
from roadpulse.config import CAUSE_SEVERITY_RANK
from roadpulse.registry.common import TEST_SPLIT_DATE, load_scored, r6, register, with_scored

_RANK = "CASE event_cause " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in CAUSE_SEVERITY_RANK.items()
) + " ELSE 3 END"
_TP = repr(2 * math.pi)


@register(
    "k1_cluster_scaling",
    with_scored(
        "SELECT "
        + ", ".join(
            f"{r6('avg(' + e + ')')} AS m_{a}, {r6('stddev_pop(' + e + ')')} AS s_{a}"
            for a, e in [
                ("lat", "latitude"), ("lng", "longitude"), ("hsin", f"sin({_TP} * hour / 24)"),
                ("hcos", f"cos({_TP} * hour / 24)"), ("rank", f"CAST({_RANK} AS DOUBLE)"),
            ]
        )
        + " FROM sc"
    ),
)
def k1(spark, sf_dir):
    return K.scaler_stats(K.cluster_inputs(load_scored(spark, sf_dir, dealt=True)))


def _clusters(spark, sf_dir):
    s = load_scored(spark, sf_dir, dealt=True)
    return s, K.dbscan(s)


@register("k2_dbscan_clusters")
def k2(spark, sf_dir):
    """Cluster sizes (noise as -1)."""
    _, lab = _clusters(spark, sf_dir)
    return lab.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


@register("k2_hdbscan_clusters")
def k2h(spark, sf_dir):
    """Sizes of the hierarchical clusters (noise as -1)."""
    lab = K.hdbscan_clusters(load_scored(spark, sf_dir, dealt=True))
    return lab.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


@register("k3_cluster_stats")
def k3(spark, sf_dir):
    s, lab = _clusters(spark, sf_dir)
    return K.cluster_stats(s, lab)


@register("k4_top_hotspots")
def k4(spark, sf_dir):
    s, lab = _clusters(spark, sf_dir)
    return K.hotspots(K.cluster_stats(s, lab), 10)


@register("k5_high_risk_clusters")
def k5(spark, sf_dir):
    s, lab = _clusters(spark, sf_dir)
    return K.high_risk(K.cluster_stats(s, lab), 0.7)


@register("k6_nearest_cluster")
def k6(spark, sf_dir):
    """Clusters fitted on the training slice; test events assigned to the nearest centre."""
    s = load_scored(spark, sf_dir, dealt=True)
    train, test = s.where(split_condition(TEST_SPLIT_DATE)), s.where(~split_condition(TEST_SPLIT_DATE))
    stats = K.cluster_stats(train, K.dbscan(train))
    scaler = K.scaler_stats(K.cluster_inputs(train))
    return K.assign_nearest(test, stats, scaler)
