"""Time buckets follow the event rate: an hour with 90 % of all rows is ranked by many tasks, with the same results."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadpulse.operators.lags import LagSpec, bucket_width, lookback_counts, naive_lookback_counts
from roadpulse.operators.state import point_in_time_means

START = 1_700_000_000 // 86400 * 86400


def _events(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        hot = rnd.random() < 0.9
        at = START + (36_000 + rnd.randrange(3600) if hot else rnd.randrange(5 * 86400)) + rnd.choice([0.0, 0.25, 0.5])
        rows.append((i, at, rnd.choice(["A", "A", "A", "B", None]), float(rnd.randrange(100)) if rnd.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "id long, at double, zone string, v double")
    return df.withColumn("start_datetime", F.timestamp_micros((F.col("at") * 1_000_000).cast("long"))).drop("at")


def test_width_follows_the_hottest_key(spark):
    sec = spark.range(6000).select((F.col("id") % 3600).alias("sec"), F.lit("k").alias("key"))
    assert bucket_width(sec, ["key"], "sec", 3600, 6000) == 3600
    assert bucket_width(sec, ["key"], "sec", 3600, 1500) == 600
    assert bucket_width(sec, [], "sec", 3600, 30) == 10
    assert bucket_width(sec, ["key"], "sec", 86400, 1) == 1
    assert bucket_width(sec.limit(0), ["key"], "sec", 3600, 1) == 3600


def test_lags_of_a_hot_hour(spark):
    events = _events(spark)
    specs = [LagSpec("z2", "zone", 2), LagSpec("z30", "zone", 30), LagSpec("c6", None, 6, "row_order")]
    got = lookback_counts(events, specs, bucket_rows=20).orderBy("id").collect()
    assert len(got) == 3000
    for s in specs:
        want = {r["id"]: r[s.name] for r in naive_lookback_counts(events, s).collect()}
        assert {r["id"]: r[s.name] for r in got} == want


def test_point_in_time_means_of_a_hot_hour(spark):
    events = _events(spark)
    got = {r.id: r.pit_v for r in point_in_time_means(events, "zone", ["v"], bucket_rows=20).collect()}
    key = F.coalesce("zone", F.lit("-"))
    w = Window.partitionBy(key).orderBy(F.unix_micros("start_datetime")).rangeBetween(Window.unboundedPreceding, -1)
    want = {r.id: r.m for r in events.select("id", F.avg("v").over(w).alias("m")).collect()}
    assert set(got) == set(want)
    for i, m in want.items():
        assert (got[i] is None) == (m is None) and (m is None or abs(got[i] - m) < 1e-9)
