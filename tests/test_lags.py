"""Bucketed look-back counts equal a naive window, also with one key holding 90 % of rows."""

from pyspark.sql import functions as F

from roadpulse.operators.lags import LagSpec, lookback_counts, lookback_counts_with_history, naive_lookback_counts
from roadpulse.registry.common import load_clean
from tests.conftest import SF_ORACLE


def _assert_same(got, ref, name):
    bad = got.join(ref.withColumnRenamed(name, "ref"), "id").where(F.col(name) != F.col("ref")).count()
    assert bad == 0
    assert got.count() == ref.count()


def test_skewed_key_and_ties(spark):
    clean = load_clean(spark, SF_ORACLE)
    # 90 % of rows on one key; many same-second ties from truncating to the minute.
    skewed = clean.withColumn(
        "hot", F.when(F.abs(F.hash("id")) % 10 != 0, F.lit("HOT")).otherwise(F.col("zone"))
    ).withColumn("start_datetime", F.date_trunc("minute", "start_datetime"))
    specs = [
        LagSpec("hot_6h", "hot", 6),
        LagSpec("hot_7d", "hot", 168),
        LagSpec("city_6h", None, 6, "row_order"),
    ]
    got = lookback_counts(skewed, specs, bucket_seconds=1800)
    for s in specs:
        _assert_same(got.select("id", s.name), naive_lookback_counts(skewed, s), s.name)


def test_history_form_equals_full_form(spark):
    clean = load_clean(spark, SF_ORACLE)
    spec = [LagSpec("c24", "corridor", 24)]
    cut = F.col("start_datetime") < F.lit("2024-01-20").cast("timestamp")
    hist = clean.where(cut)
    scored = clean.where(~cut)
    got = lookback_counts_with_history(scored, hist, spec).select("id", "c24")
    full = naive_lookback_counts(clean, spec[0]).join(scored.select("id"), "id", "left_semi")
    _assert_same(got, full, "c24")
