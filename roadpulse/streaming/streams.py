"""Structured Streaming forms (ST1–ST4) of the incident operators.

The batch operators are plain projections, so the same functions clean and
score a stream.  Windows use event time with a watermark; the prediction ⋈
outcome join is a stream-stream interval join with watermarks on both sides
(bounded state: an outcome older than 720 h after its prediction can no longer
match).  Every query writes to a parquet sink with a checkpoint location; given
the same ``base`` folder again, it goes on where it stopped and takes no input
twice.  ``run_available_now`` drains the input and stops (the oracle /
batch-equivalence mode).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.clean import clean_incidents
from roadpulse.operators.features import profile_features, spatial_features, temporal_features
from roadpulse.plans.deployment import recommend
from roadpulse.session import checkpoint_dir, materialize
from roadpulse.sources.incidents import incidents_from_events, with_pseudo_predictions


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """File source over the events table (explicit schema, as streaming requires)."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # A glob matches one file as well as a folder of files; a plain path may only be a folder.
    return r.parquet(f"{sf_dir}/events.parque[t]")


def incident_stream(events: DataFrame, watermark: str | None = "2 hours", with_keys: bool = False) -> DataFrame:
    """ST1: raw binding → clean; with a watermark, duplicates of an id within it are dropped.

    ``watermark=None`` leaves event time unbound for callers that set their own
    (a stream carries one watermark definition per event-time column).
    """
    clean = clean_incidents(incidents_from_events(events, with_keys=with_keys))
    if watermark is None:
        return clean
    return clean.withWatermark("start_datetime", watermark).dropDuplicatesWithinWatermark(["id"])


def corridor_pressure(clean: DataFrame, kind: str = "tumbling", watermark: str | None = None) -> DataFrame:
    """ST2: incidents per corridor in tumbling 6 h, sliding 24 h / 1 h, or session (30 min gap) windows.

    Late rows beyond the stream's watermark (set by :func:`incident_stream`, or
    here when ``watermark`` is given) are dropped by the windowed aggregation.
    """
    d = clean.withWatermark("start_datetime", watermark) if watermark else clean
    if kind == "tumbling":
        w = F.window("start_datetime", "6 hours")
    elif kind == "sliding":
        w = F.window("start_datetime", "24 hours", "1 hour")
    elif kind == "session":
        w = F.session_window("start_datetime", "30 minutes")
    else:
        raise ValueError(kind)
    return d.groupBy(w.alias("w"), "corridor").agg(F.count(F.lit(1)).alias("events")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "corridor", "events"
    )


def scored_plan_stream(clean: DataFrame, state=None, score: Callable[[DataFrame], DataFrame] = with_pseudo_predictions) -> DataFrame:
    """ST3: stream-static scoring: row features, fitted state tables (static side), predictions, plans.

    ``score`` adds the prediction columns row by row; the fixture's predictions by default.
    """
    d = profile_features(spatial_features(temporal_features(clean)))
    if state is not None:
        d = state._join_state(d)
    return recommend(score(d))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started within keep their state (30 days of predictions) off the JVM heap; later ones do not change.

    Applies to new checkpoints; an existing one keeps the provider it was created with.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def prediction_outcome_join(predictions: DataFrame, outcomes: DataFrame, horizon_hours: int = 720, how: str = "inner") -> DataFrame:
    """ST4: each prediction with its outcome closed within ``horizon_hours`` (interval join, bounded state).

    With ``how="left_outer"`` a prediction without an outcome leaves with nulls once the watermark
    has passed its horizon; what is still waiting when a bounded input ends is :func:`open_predictions`.
    """
    p = predictions.withWatermark("predicted_at", f"{horizon_hours} hours").alias("p")
    o = outcomes.withWatermark("closed_at", f"{horizon_hours} hours").alias("o")
    cond = (
        (F.col("p.pid") == F.col("o.oid"))
        & (F.col("o.closed_at") >= F.col("p.predicted_at"))
        & (F.col("o.closed_at") <= F.col("p.predicted_at") + F.expr(f"INTERVAL {horizon_hours} HOURS"))
    )
    return p.join(o, cond, how)


def sink_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "roadpulse", "streams", f"{name}-{uuid.uuid4().hex}")


def run_available_now(df: DataFrame, name: str, mode: str = "append", keep_latest_by: list[str] | None = None,
                      base: str | None = None) -> DataFrame:
    """Drain the stream into a parquet sink and return the sink as a batch table.

    ``base`` is the folder of the sink and its checkpoint, a new one by default; a later run
    with the same folder takes only the input that came since.
    ``mode='update'`` (aggregations) appends every micro-batch's updated groups
    through ``foreachBatch``; the final value of a group is its last update, so
    the read-back keeps the row with the largest batch id per ``keep_latest_by``.
    """
    spark = df.sparkSession
    base = base or sink_dir(spark, name)
    data, ckpt = os.path.join(base, "data"), os.path.join(base, "_checkpoint")
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", data).option("checkpointLocation", ckpt).outputMode("append")
    else:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            # A folder per batch, so that one run again after a failure replaces its rows.
            batch.write.mode("overwrite").parquet(f"{data}/_batch={batch_id}")

        q = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt).outputMode(mode)
    q.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(data)
    if keep_latest_by:
        last = out.groupBy(*keep_latest_by).agg(F.max_by(F.struct(*[c for c in out.columns if c not in keep_latest_by]), "_batch").alias("_r"))
        out = last.select(*keep_latest_by, "_r.*").drop("_batch")
    return out


def run_scored(clean: DataFrame, scorer: Callable[[DataFrame], DataFrame], base: str) -> DataFrame:
    """ST3 with fitted models: each micro-batch of clean incidents is scored by ``scorer`` and written to ``base``.

    Scoring needs joins with itself (look-back counts), so it is a batch job per micro-batch; a batch
    that is run again after a failure replaces its rows.  A :class:`~roadpulse.operators.bundle.BundleScorer`
    takes up a newly saved version with the next micro-batch.
    """
    spark, data = clean.sparkSession, os.path.join(base, "data")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch, "stream-batch")
        scorer(rows).write.mode("overwrite").parquet(f"{data}/_batch={batch_id}")

    q = clean.writeStream.foreachBatch(write_batch).option("checkpointLocation", os.path.join(base, "_checkpoint"))
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(data)


def stateful_operator(spark: SparkSession, base: str, name: str) -> int:
    """The number of the one stateful operator called ``name`` of the stream that was drained into ``base``."""
    meta = spark.read.format("state-metadata").load(os.path.join(base, "_checkpoint"))
    found = [r[0] for r in meta.where(F.col("operatorName") == name).select("operatorId").distinct().collect()]
    if len(found) != 1:
        raise ValueError(f"expected one operator {name} in the state of {base}, found {len(found)}")
    return found[0]


def open_sessions(spark: SparkSession, base: str) -> DataFrame:
    """ST2: the sessions that a drained stream into ``base`` still holds in its state, in the form of its sink.

    At the end of a bounded input nothing can extend them; with them no incident is left out.
    """
    number = stateful_operator(spark, base, "sessionWindowStateStoreSaveExec")
    state = spark.read.format("statestore").option("operatorId", number).load(os.path.join(base, "_checkpoint"))
    return state.select(
        F.col("value.session_window.start").alias("window_start"), F.col("value.session_window.end").alias("window_end"),
        "value.corridor", F.col("value.count").alias("events"),
    )


def open_predictions(spark: SparkSession, base: str, sink: DataFrame, key: str = "pid") -> DataFrame:
    """ST4: predictions that a drained left-outer join into ``base`` still holds without an outcome, in the form of ``sink``.

    The state also keeps predictions that have met their outcome, until the watermark passes them; the
    sink has those.  With these rows the sink holds every prediction, as a batch left join does.
    """
    number = stateful_operator(spark, base, "symmetricHashJoin")
    state = spark.read.format("statestore").option("operatorId", number).option("joinSide", "left").load(os.path.join(base, "_checkpoint"))
    held = state.select("value.*")
    cols = [F.col(c) if c in held.columns else F.lit(None).cast(sink.schema[c].dataType).alias(c) for c in sink.columns]
    return held.select(*cols).join(sink.select(key), key, "left_anti").select(*sink.columns)
