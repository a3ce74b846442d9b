"""Wide steps run in tasks of bounded rows, whatever the number of shuffle tasks or splits."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from roadpulse.operators import lags, state
from roadpulse.operators.lags import LagSpec, add_lookback_counts, naive_lookback_counts
from roadpulse.operators.state import STATE_KEYS, FeatureModel
from roadpulse.registry.common import load_clean
from roadpulse.session import TASK_ROWS, materialize, regroup, spread


def test_tasks_follow_the_rows(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert regroup(df, ["k"], 100) is df
    assert regroup(df, ["k"], (shuffle + 3) * TASK_ROWS).rdd.getNumPartitions() == shuffle + 3
    assert spread(df).rdd.getNumPartitions() == shuffle


def test_one_split_is_dealt_before_it_gets_wide(spark):
    assert spark.read.parquet(f"{SF_SMALL}/events.parquet").rdd.getNumPartitions() == 1
    assert load_clean(spark, SF_SMALL, dealt=True).rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_counts_in_many_tasks_equal_the_plain_window(spark, monkeypatch):
    monkeypatch.setattr(lags, "RANK_ROWS", 20)
    monkeypatch.setattr(lags.regroup, "__defaults__", (20,))
    df = spark.range(400).select(
        "id", F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("c"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 9000).alias("start_datetime"),
    )
    specs = [LagSpec("own", "c", 1), LagSpec("all", None, 0.5, "row_order")]
    got = add_lookback_counts(df, specs)
    for s in specs:
        want = {r["id"]: r[s.name] for r in naive_lookback_counts(df, s).collect()}
        assert {r["id"]: r[s.name] for r in got.collect()} == want


def _held_state(spark):
    """Rows of one frequent, one missing and 300 rare junctions, and a state fitted on them."""
    df = spark.range(900).select(
        F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("start_datetime"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("J"), F.col("id"))).alias("junction"),
        *[F.concat(F.lit("v"), F.col("id") % 4).alias(k) for k in STATE_KEYS if k != "junction"],
        (F.col("id") % 10).cast("double").alias("resolution_hours"), (F.col("id") % 2).cast("int").alias("road_closure_binary"),
        (F.col("id") % 3).cast("int").alias("priority_binary"),
    )
    st = {}
    for k in STATE_KEYS:
        st[f"key_{k}"] = df.where(F.col(k).isNotNull()).groupBy(k).agg(F.count("*").alias("n"), F.avg("resolution_hours").alias("mean_resolution"), F.avg("road_closure_binary").alias("closure_rate"), F.avg("priority_binary").alias("priority_rate"))
    st["global"] = df.agg(F.avg("resolution_hours").alias("mean_resolution"), F.avg("priority_binary").alias("priority_rate"), F.avg("road_closure_binary").alias("closure_rate"), F.count("*").alias("n"))
    return df, FeatureModel(state=st)


def test_state_of_many_keys_is_joined_in_tasks_of_bounded_rows(spark, monkeypatch):
    df, model = _held_state(spark)
    want = model._join_state(df)
    names = sorted(want.columns)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    few = model._join_state(df, 900)
    assert "SortMergeJoin" not in plan(few)  # whatever the engine takes the size of the state for
    monkeypatch.setattr(state, "STATE_ROWS", 100)
    monkeypatch.setattr(state, "TASK_ROWS", 30)
    monkeypatch.setattr(state.task_count, "__defaults__", (30,))
    many = model._join_state(df, 900)
    assert plan(many).count("SortMergeJoin") == 1
    assert max(r["count"] for r in many.groupBy(F.spark_partition_id().alias("p")).count().collect()) < 120  # 300 rows have the same key, 300 none
    rows = lambda d: sorted(map(tuple, d.select(*names).collect()), key=str)
    assert rows(few) == rows(want) == rows(many)


def test_keys_without_frequent_or_missing_ones_are_dealt_once(spark, monkeypatch):
    df, model = _held_state(spark)
    df = df.withColumn("junction", F.coalesce(F.concat(F.lit("J"), F.col("id").cast("int") % 300), F.lit("unknown")))  # not null by its type, 3 rows each
    model.state["key_junction"] = df.groupBy("junction").agg(F.count("*").alias("n"), F.avg("resolution_hours").alias("mean_resolution"), F.avg("road_closure_binary").alias("closure_rate"), F.avg("priority_binary").alias("priority_rate"))
    # As after a fit: tables that are read back, so the join alone decides how they are shuffled.
    model.state = {k: materialize(t) for k, t in model.state.items()}
    want = model._join_state(df)
    monkeypatch.setattr(state, "STATE_ROWS", 100)
    monkeypatch.setattr(state, "TASK_ROWS", 30)
    many = model._join_state(df, 900)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1
    assert many.rdd.getNumPartitions() == 30
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x]) == 2  # the rows and the state, once each
    names = sorted(want.columns)
    rows = lambda d: sorted(map(tuple, d.select(*names).collect()), key=str)
    assert rows(many) == rows(want)
