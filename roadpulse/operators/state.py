"""Fitted feature state (L1, L5, E1, G3 counts) and its transform, plus the
point-in-time (L6), leave-one-out (E2) and rare-category (E4) forms.

State is a set of small keyed DataFrames: one grouping-sets aggregate over the
training rows yields every statistic of every key (frequency, mean resolution,
closure/priority rates, target-encoding counts) in a single pass, instead of
sixteen separate group-bys.  State tables are bounded by the number of
distinct keys; those of few keys are broadcast, larger ones meet the rows in
tasks of bounded size.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.config import DEFAULT, EngineConfig
from roadpulse.functions.timefns import epoch_micros
from roadpulse.operators.features import (
    interaction_features,
    profile_features,
    spatial_features,
    split_condition,
    temporal_features,
)
from roadpulse.operators.lags import BUCKET_ROWS, RANK_ROWS, LagSpec, bucket_width, counted, lookback_counts_with_history
from roadpulse.session import TASK_ROWS, materialize, regroup, task_count

STATE_KEYS = ["event_cause", "corridor", "junction", "police_station", "zone", "hex_id"]

STATE_ROWS = 200_000  # keys of a state table that every task may hold

LAG_SPECS = [
    LagSpec(name, key, hours, "strict" if key else "row_order") for name, key, hours in C.LAG_FEATURES
]


class FeatureModel:
    """fit/transform with stored state; ``transform`` refuses to run unfitted."""

    def __init__(self, cfg: EngineConfig = DEFAULT, state: dict[str, DataFrame] | None = None):
        self.cfg = cfg
        self.state = state

    # -- fit -----------------------------------------------------------------
    def fit(self, clean: DataFrame) -> "FeatureModel":
        """All state in one pass: grouping sets over the six keys plus the global set.

        One scan of the (cleaned) training rows feeds every statistic; the small
        result is written once (lineage cut), so the later state joins read a
        few thousand rows instead of re-running the cleaning pipeline per key.
        """
        base = spatial_features(clean, self.cfg).select(
            *STATE_KEYS, "resolution_hours", "road_closure_binary", "priority_binary"
        )
        sets = [[F.col(k)] for k in STATE_KEYS] + [[]]
        agg = base.groupingSets(sets, *STATE_KEYS).agg(
            F.grouping_id().alias("_gid"),
            F.count(F.lit(1)).alias("n"),
            F.avg("resolution_hours").alias("mean_resolution"),
            F.avg("road_closure_binary").alias("closure_rate"),
            F.avg("priority_binary").alias("priority_rate"),
        )
        table = materialize(agg, "feature-state")
        full = (1 << len(STATE_KEYS)) - 1
        st = {}
        for i, k in enumerate(STATE_KEYS):
            gid = full ^ (1 << (len(STATE_KEYS) - 1 - i))  # only key k grouped
            st[f"key_{k}"] = table.where((F.col("_gid") == gid) & F.col(k).isNotNull()).select(
                k, "n", "mean_resolution", "closure_rate", "priority_rate"
            )
        st["global"] = table.where(F.col("_gid") == full).select("mean_resolution", "priority_rate", "closure_rate", "n")
        self.state = st
        return self

    def fit_split(self, clean: DataFrame, split_date: str | None = None) -> "FeatureModel":
        """Leakage-free default: fit on rows before the split; ``fit_scope='all'`` fits on all rows."""
        if self.cfg.fit_scope == "all":
            return self.fit(clean)
        return self.fit(clean.where(split_condition(split_date or self.cfg.split_date, self.cfg)))

    # -- transform -----------------------------------------------------------
    def transform(self, clean: DataFrame, history: DataFrame | None = None) -> DataFrame:
        if self.state is None:
            raise RuntimeError("FeatureModel must be fitted before transform")
        # Look-backs first: they read the clean rows several times, and would repeat the joins of the state.
        events = None
        if history is None:
            df, events = counted(clean, LAG_SPECS, bucket_seconds=self.cfg.lag_bucket_seconds)
        else:
            df = lookback_counts_with_history(clean, history, LAG_SPECS, bucket_seconds=self.cfg.lag_bucket_seconds)
        df = profile_features(spatial_features(temporal_features(df, self.cfg), self.cfg))
        return interaction_features(self._join_state(df, events))

    def _keys(self) -> dict[str, tuple[int, int]]:
        """For each state table its number of keys and the training rows of the most frequent one."""
        each = [self.state[f"key_{k}"].agg(F.lit(k).alias("key"), F.count(F.lit(1)).alias("keys"), F.coalesce(F.max("n"), F.lit(0)).alias("most")) for k in STATE_KEYS]
        return {r["key"]: (r["keys"], r["most"]) for r in reduce(DataFrame.unionByName, each).collect()}

    def _join_state(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """``rows``: the number of rows of ``df``; without it (streams) the joins are left to the engine.

        A state table of at most ``STATE_ROWS`` keys is broadcast, so the wide rows stay where they are.  For a
        larger one they are dealt by key to tasks of about ``TASK_ROWS``, frequent and missing keys over several.
        """
        st = self.state
        keys = self._keys() if rows else {}
        g = st["global"].select(
            F.col("mean_resolution").alias("_g_res"),
            F.col("priority_rate").alias("_g_pri"),
            F.col("closure_rate").alias("_g_clo"),
        )
        # One-row table: a broadcast of proven size.
        df = df.crossJoin(F.broadcast(g))
        m = float(self.cfg.te_smoothing)

        def te(key: str, rate: str, glob: str) -> Column:
            n = F.col(f"{key}__n")
            return F.coalesce((n * F.col(f"{key}__{rate}") + F.lit(m) * F.col(glob)) / (n + F.lit(m)), F.col(glob))

        for key in STATE_KEYS:
            s = st[f"key_{key}"]
            s = s.select(key, *[F.col(c).alias(f"{key}__{c}") for c in s.columns if c != key])
            held, most = keys.get(key, (0, 0))
            if not keys:
                df = df.join(s, on=key, how="left")
            elif held <= STATE_ROWS:
                df = df.join(F.broadcast(s), on=key, how="left")
            else:
                df = self._join_dealt(df, s, key, rows, most)

        df = df.withColumns(
            {
                "corridor_event_frequency": F.coalesce(F.col("corridor__n"), F.lit(0)).cast("double"),
                "junction_event_frequency": F.coalesce(F.col("junction__n"), F.lit(0)).cast("double"),
                "police_station_event_frequency": F.coalesce(F.col("police_station__n"), F.lit(0)).cast("double"),
                "hex_event_count": F.coalesce(F.col("hex_id__n"), F.lit(0)).cast("double"),
                "cause_avg_resolution_hours": F.coalesce(F.col("event_cause__mean_resolution"), F.col("_g_res")),
                "corridor_avg_resolution_hours": F.coalesce(F.col("corridor__mean_resolution"), F.col("_g_res")),
                "cause_historical_closure_rate": F.coalesce(F.col("event_cause__closure_rate"), F.lit(0.0)),
                "junction_historical_closure_rate": F.coalesce(F.col("junction__closure_rate"), F.lit(0.0)),
                "cause_historical_priority_rate": F.coalesce(F.col("event_cause__priority_rate"), F.lit(0.5)),
            }
        )
        for key in C.TARGET_ENCODING_KEYS:
            df = df.withColumns(
                {
                    f"{key}_te_priority_binary": te(key, "priority_rate", "_g_pri"),
                    f"{key}_te_road_closure_binary": te(key, "closure_rate", "_g_clo"),
                }
            )
        drop = [c for c in df.columns if "__" in c or c.startswith("_g_")]
        return df.drop(*drop)

    @staticmethod
    def _join_dealt(df: DataFrame, s: DataFrame, key: str, rows: int, most: int) -> DataFrame:
        """Left join with many keys: those of more than ``TASK_ROWS`` training rows, at most one a ``TASK_ROWS``, have copies in several tasks."""
        tasks = task_count(df, rows, TASK_ROWS)
        copies = min(tasks, -(-most // TASK_ROWS))
        hot = [r[0] for r in s.where(F.col(f"{key}__n") > TASK_ROWS).select(key).collect()]
        place = F.xxhash64("id", "start_datetime")
        # Of a column in any case: a literal would leave the join's keys, and the dealt rows would be shuffled again to a fixed number of tasks.
        salt = F.pmod(place, F.when(F.col(key).isNull(), tasks).when(F.col(key).isin(hot), max(1, copies)).otherwise(1))
        s = s.withColumn("_salt", F.explode(F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(max(1, copies) - 1))).otherwise(F.array(F.lit(0)))))
        df = df.withColumn("_salt", salt.cast("int")).repartition(tasks, key, "_salt")
        return df.join(s.hint("merge"), on=[key, "_salt"], how="left").drop("_salt")

    # -- persistence (S5) ----------------------------------------------------
    def save(self, path: str) -> None:
        for name, table in self.state.items():
            table.write.mode("overwrite").parquet(os.path.join(path, name))

    @classmethod
    def load(cls, spark: SparkSession, path: str, cfg: EngineConfig = DEFAULT) -> "FeatureModel":
        names = [f"key_{k}" for k in STATE_KEYS] + ["global"]
        return cls(cfg, {n: spark.read.parquet(os.path.join(path, n)) for n in names})


def build_features(clean: DataFrame, cfg: EngineConfig = DEFAULT, split_date: str | None = None) -> DataFrame:
    """Fit on the training slice (or all rows with ``fit_scope='all'``) and transform every row."""
    return FeatureModel(cfg).fit_split(clean, split_date).transform(clean)


# ---------------------------------------------------------------------------
# Point-in-time means (only strictly earlier events of the key)
# ---------------------------------------------------------------------------


def point_in_time_means(
    df: DataFrame, key: str | None, values: list[str], id_col: str = "id", ts_col: str = "start_datetime",
    bucket_seconds: int = 86400, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(id, pit_<value>...)``: mean of each value over the key's strictly earlier events.

    Hot keys are split by time: per (key, bucket) sums and counts are accumulated
    over buckets on a small table and enter each (key, bucket) partition as one carry
    row.  Buckets last a day (``bucket_seconds``) at most and shrink until none holds
    more than ``bucket_rows`` events of a key, down to one second.
    """
    kcol = F.coalesce(F.col(key).cast("string"), F.lit("\u0000null")) if key else F.lit("")
    us = epoch_micros(F.col(ts_col))
    narrow = df.where(F.col(ts_col).isNotNull()).select(
        F.col(id_col).alias("rid"), kcol.alias("key"), us.alias("us"), F.floor(us / 1_000_000).alias("sec"),
        *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)],
    )
    narrow = materialize(narrow, "pit-events")
    width = bucket_width(narrow, ["key"], "sec", bucket_seconds, bucket_rows)
    rows = narrow.withColumn("bkt", F.floor(F.col("sec") / width)).drop("sec")
    sums = rows.groupBy("key", "bkt").agg(
        *[F.sum(f"v{i}").alias(f"s{i}") for i in range(len(values))],
        *[F.count(f"v{i}").alias(f"c{i}") for i in range(len(values))],
    )
    before = Window.partitionBy("key").orderBy("bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        F.lit(None).cast(rows.schema["rid"].dataType).alias("rid"), "key",
        F.lit(-1).cast("bigint").alias("us"), "bkt",
        *[F.coalesce(F.sum(f"s{i}").over(before), F.lit(0.0)).alias(f"v{i}") for i in range(len(values))],
        *[F.coalesce(F.sum(f"c{i}").over(before), F.lit(0)).alias(f"n{i}") for i in range(len(values))],
        F.lit(True).alias("is_carry"),
    )
    data = rows.select(
        "rid", "key", "us", "bkt", *[f"v{i}" for i in range(len(values))],
        *[F.when(F.col(f"v{i}").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(f"n{i}") for i in range(len(values))],
        F.lit(False).alias("is_carry"),
    )
    w = Window.partitionBy("key", "bkt").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    out = regroup(data.unionByName(carry), ["key", "bkt"], narrow.count(), RANK_ROWS).select(
        "rid", "is_carry",
        *[
            (F.sum(f"v{i}").over(w) / F.when(F.sum(f"n{i}").over(w) > 0, F.sum(f"n{i}").over(w))).alias(f"pit_{v}")
            for i, v in enumerate(values)
        ],
    )
    return out.where(~F.col("is_carry")).select(F.col("rid").alias(id_col), *[f"pit_{v}" for v in values])


# ---------------------------------------------------------------------------
# E2 / E4
# ---------------------------------------------------------------------------


def leave_one_out_encoding(df: DataFrame, key: str, target: str, smoothing: float = C.TARGET_ENCODING_SMOOTHING) -> DataFrame:
    """Smoothed encoding of ``key`` that excludes the row's own target.

    Key totals come from a partial aggregation (hot keys are combined map-side)
    joined back, rather than a window over the key.
    """
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(target).alias("_s"), F.count(target).alias("_n")
    )
    glob = df.agg(F.avg(target).alias("_g"))
    y = F.col(target)
    loo = (F.col("_s") - y + F.lit(float(smoothing)) * F.col("_g")) / (F.col("_n") - 1 + F.lit(float(smoothing)))
    return (
        df.join(totals, on=key, how="left")
        .crossJoin(F.broadcast(glob))
        .withColumn(f"{key}_loo_{target}", F.coalesce(loo, F.col("_g")))
        .drop("_s", "_n", "_g")
    )


def group_rare(df: DataFrame, key: str, min_count: int = 5, other: str = "others") -> DataFrame:
    """Values seen fewer than ``min_count`` times become ``other``."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"))
    return (
        df.join(counts, on=key, how="left")
        .withColumn(key, F.when(F.col("_cnt") < min_count, F.lit(other)).otherwise(F.col(key)))
        .drop("_cnt")
    )
