"""Exact look-back counts (L2, L3, L4, L7) that stay bounded under key skew.

A look-back count "events of the same key with ``t - W <= t' < t``" equals
``C(t) - C(t - W)`` where ``C(x)`` is the number of the key's events before
``x``.  Both terms are rank lookups, so the whole operator is one window pass:

* every event becomes a *data* row in its time bucket ``floor(sec / B)``;
* every (event, window) becomes a *probe* row at ``sec - W`` in the bucket of
  that instant;
* every (key, bucket) gets one *carry* row holding the number of the key's
  events in all earlier buckets (a prefix sum over a table of bucket counts,
  whose size is bounded by the number of buckets, not rows).

A running sum over ``(family, key, bucket)`` ordered by time then yields
``C(x)`` for data and probe rows alike.  Partitions hold one key's events of
one bucket whatever the window length, so a key holding a third of all rows is
split into many tasks.  ``B`` is an hour at most and follows the event rate:
it shrinks until no key has more than ``bucket_rows`` events in a bucket, down
to one second.  The narrow input (id, keys, time) is written once and read for
all of this.
All families (corridor, zone, station, city-wide) share one shuffle.

Tie rules, in whole epoch seconds:

* ``"strict"`` (grouped counts): ``t - W <= t' < t``;
* ``"row_order"`` (city-wide count): earlier rows in (time, id) order with
  ``t' >= t - W`` — same-second events before the row count too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.timefns import epoch_micros, epoch_seconds
from roadpulse.session import materialize, regroup

NULL_KEY = "\u0000null"
BUCKET_ROWS = 1_000_000  # events of one key that a task ranks at once
RANK_ROWS = 400_000  # narrow rows of all its groups that a task ranks
WIDTHS = (86400, 3600, 600, 60, 10, 1)  # seconds; each divides the one before


@dataclass(frozen=True)
class LagSpec:
    name: str
    key: str | None  # None = one city-wide group
    hours: float
    ties: str = "strict"  # or "row_order"

    @property
    def seconds(self) -> int:
        return int(round(self.hours * 3600))


def bucket_width(rows: DataFrame, keys: list[str], sec: str, widest: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """The widest bucket, in seconds, of which none holds more than ``bucket_rows`` rows of one value of any of ``keys``.

    ``rows`` is read once for each width that is tried, with partial aggregation; the driver gets one number.
    """
    tries = [int(widest), *[w for w in WIDTHS if w < widest]]
    entries = [F.struct(F.lit(i).alias("fam"), F.col(k).alias("key")) for i, k in enumerate(keys)] or [
        F.struct(F.lit(-1).alias("fam"), F.lit("").alias("key"))
    ]
    for width in tries[:-1]:
        held = rows.select(F.floor(F.col(sec) / width).alias("bkt"), F.explode(F.array(*entries)).alias("e"))
        most = held.groupBy("e.fam", "e.key", "bkt").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= bucket_rows:
            return width
    return tries[-1]


def lookback_counts(
    df: DataFrame,
    specs: list[LagSpec],
    id_col: str = "id",
    ts_col: str = "start_datetime",
    bucket_seconds: int = 3600,
    scored_col: str | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Return ``(id, <spec.name>...)`` with one bigint count per spec.

    ``bucket_seconds`` is the widest time bucket; hot hours get narrower ones by ``bucket_rows``.
    ``scored_col`` (optional boolean column) limits output rows to the scored
    events while every row still counts as history (L7).
    """
    return _counts(df, specs, id_col, ts_col, bucket_seconds, scored_col, bucket_rows)[0]


def _counts(df, specs, id_col="id", ts_col="start_datetime", bucket_seconds=3600, scored_col=None, bucket_rows=BUCKET_ROWS) -> tuple[DataFrame, int]:
    """The counts and the number of events that they were taken over."""
    families = sorted({s.key or "" for s in specs})
    fam_index = {f: i for i, f in enumerate(families)}
    sel = [F.col(id_col).alias("_id"), epoch_seconds(F.col(ts_col)).alias("_sec"), epoch_micros(F.col(ts_col)).alias("_us")]
    sel += [F.coalesce(F.col(f).cast("string"), F.lit(NULL_KEY)).alias(f"_k{fam_index[f]}") for f in families if f]
    sel.append((F.col(scored_col) if scored_col else F.lit(True)).alias("_scored"))
    base = materialize(df.where(F.col(ts_col).isNotNull()).select(*sel), "lag-events")
    events = base.count()
    # The city-wide family holds every event of a second, so its rate bounds that of every key.
    keys = [] if "" in families else [f"_k{fam_index[f]}" for f in families]
    B = F.lit(bucket_width(base, keys, "_sec", bucket_seconds, bucket_rows))

    def key_of(fam: str) -> Column:
        return F.col(f"_k{fam_index[fam]}") if fam else F.lit("")

    # Every event yields one data row per key family and one probe row per spec,
    # generated from a single scan (one Generate, no self-union).
    sec, us, rid = F.col("_sec"), F.col("_us"), F.col("_id")
    entries = []
    for fam in families:
        entries.append(
            F.struct(
                F.lit(fam_index[fam]).alias("fam"), key_of(fam).alias("key"), sec.alias("sec"),
                us.alias("us"), F.lit(1).alias("kind"), F.lit(-1).alias("spec"),
                F.lit(1).cast("bigint").alias("w"), F.col("_scored").alias("scored"),
            )
        )
    for i, s in enumerate(specs):
        fam = s.key or ""
        entries.append(
            F.when(
                F.col("_scored"),
                F.struct(
                    F.lit(fam_index[fam]).alias("fam"), key_of(fam).alias("key"), (sec - F.lit(s.seconds)).alias("sec"),
                    F.lit(None).cast("bigint").alias("us"), F.lit(0).alias("kind"), F.lit(i).alias("spec"),
                    F.lit(0).cast("bigint").alias("w"), F.lit(True).alias("scored"),
                ),
            )
        )
    exploded = (
        base.select(rid.alias("rid"), F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e").isNotNull())
        .select("rid", "e.*")
        .withColumn("bkt", F.floor(F.col("sec") / B))
    )

    # Prefix counts per (family, key, bucket): small table (buckets, not rows).
    bucket_counts = exploded.groupBy("fam", "key", "bkt").agg(F.sum("w").alias("n"))
    before = Window.partitionBy("fam", "key").orderBy("bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = bucket_counts.select(
        F.lit(None).cast(exploded.schema["rid"].dataType).alias("rid"),
        "fam", "key",
        (F.col("bkt") * B - 1).alias("sec"),
        F.lit(None).cast("bigint").alias("us"),
        F.lit(-1).alias("kind"),
        F.lit(-1).alias("spec"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("w"),
        F.lit(False).alias("scored"),
        "bkt",
    )

    rows = regroup(exploded.unionByName(carry), ["fam", "key", "bkt"], events * (len(families) + len(specs)), RANK_ROWS)
    part = Window.partitionBy("fam", "key", "bkt")
    strict = part.orderBy("sec").rangeBetween(Window.unboundedPreceding, -1)
    ordered = part.orderBy("sec", "kind", "us", "rid").rowsBetween(Window.unboundedPreceding, -1)
    need_order = any(s.ties == "row_order" for s in specs)
    ranked = _rank(rows, strict, ordered, need_order)

    aggs = []
    for i, s in enumerate(specs):
        fam = fam_index[s.key or ""]
        own = F.col("c_order") if s.ties == "row_order" else F.col("c_strict")
        contrib = (
            F.when((F.col("kind") == 1) & (F.col("fam") == fam), own)
            .when((F.col("kind") == 0) & (F.col("spec") == i), -F.col("c_strict"))
            .otherwise(F.lit(0))
        )
        aggs.append(F.sum(contrib).cast("bigint").alias(s.name))
    named = ranked.where(F.col("scored")).withColumnRenamed("rid", id_col)
    return regroup(named, [id_col], events).groupBy(id_col).agg(*aggs), events


def _rank(rows: DataFrame, strict, ordered, need_order: bool) -> DataFrame:
    with_counts = rows.select(
        "fam", "rid", "kind", "spec", "scored",
        F.coalesce(F.sum("w").over(strict), F.lit(0)).alias("c_strict"),
        (F.coalesce(F.sum("w").over(ordered), F.lit(0)) if need_order else F.lit(0).cast("bigint")).alias("c_order"),
    )
    return with_counts.where(F.col("kind") >= 0)


def add_lookback_counts(df: DataFrame, specs: list[LagSpec], id_col: str = "id", **kw) -> DataFrame:
    """Join the counts back to the events (one shuffle on id)."""
    return counted(df, specs, id_col, **kw)[0]


def counted(df: DataFrame, specs: list[LagSpec], id_col: str = "id", **kw) -> tuple[DataFrame, int]:
    """:func:`add_lookback_counts` and the number of events counted."""
    counts, events = _counts(df, specs, id_col=id_col, **kw)
    return regroup(df, [id_col], events).join(counts, on=id_col, how="left").fillna(0, subset=[s.name for s in specs]), events


def lookback_counts_with_history(scored: DataFrame, history: DataFrame, specs: list[LagSpec], id_col: str = "id", **kw) -> DataFrame:
    """Counts for ``scored`` events that also see ``history`` events (history rows are not emitted).

    Only history within the longest window before the first scored event and up to the last one is read.
    """
    ts = kw.get("ts_col", "start_datetime")
    cols = sorted({id_col, ts} | {s.key for s in specs if s.key})
    longest = max(s.seconds for s in specs) + 1  # windows count whole seconds
    reach = scored.agg((F.min(ts) - F.make_dt_interval(secs=F.lit(longest))).alias("low"), (F.max(ts) + F.make_dt_interval(secs=F.lit(1))).alias("high"))
    inside = (F.col(ts) >= reach.select("low").scalar()) & (F.col(ts) <= reach.select("high").scalar())
    hist = history.select(*cols).where(inside).join(scored.select(id_col), on=id_col, how="left_anti")
    both = scored.select(*cols).withColumn("_scored", F.lit(True)).unionByName(
        hist.withColumn("_scored", F.lit(False))
    )
    counts, events = _counts(both, specs, id_col=id_col, scored_col="_scored", **kw)
    return regroup(scored, [id_col], events).join(counts, on=id_col, how="left").fillna(0, subset=[s.name for s in specs])


def naive_lookback_counts(df: DataFrame, spec: LagSpec, id_col: str = "id", ts_col: str = "start_datetime") -> DataFrame:
    """Naive form for tests: an unbucketed window (one partition per key)."""
    sec = epoch_seconds(F.col(ts_col))
    key = F.coalesce(F.col(spec.key).cast("string"), F.lit(NULL_KEY)) if spec.key else F.lit("")
    d = df.select(F.col(id_col).alias(id_col), sec.alias("_sec"), epoch_micros(F.col(ts_col)).alias("_us"), key.alias("_key"))
    if spec.ties == "strict":
        w = Window.partitionBy("_key").orderBy("_sec").rangeBetween(-spec.seconds, -1)
        return d.select(id_col, F.count(F.lit(1)).over(w).cast("bigint").alias(spec.name))
    w_range = Window.partitionBy("_key").orderBy("_sec").rangeBetween(-spec.seconds, -1)
    w_tie = Window.partitionBy("_key", "_sec").orderBy("_us", id_col)
    return d.select(
        id_col,
        (F.count(F.lit(1)).over(w_range) + F.row_number().over(w_tie) - 1).cast("bigint").alias(spec.name),
    )
