"""Analytics tables behind the charts.

Each is a group-by (partial aggregation first), a pivot with explicit values
(one pass, no value discovery job), a small spine join for zero-filling, or a
bounded top-k.  Shares use a window over the *aggregated* table, never over rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.operators.quantiles import exact_quantiles
from roadpulse.session import materialize


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def cause_counts(df: DataFrame) -> DataFrame:
    """A1: events per cause."""
    return counts_by(df, "event_cause")


def cause_type_crosstab(df: DataFrame) -> DataFrame:
    """A1: cause × event type (planned / unplanned), zero-filled."""
    return df.groupBy("event_cause").pivot("event_type", ["planned", "unplanned"]).agg(F.count(F.lit(1))).fillna(0)


def hour_weekday_matrix(df: DataFrame, high_only: bool = False) -> DataFrame:
    """A2: hour × weekday (0 = Monday) counts, zero-filled; optionally High priority only."""
    d = df.where(F.col("priority") == "High") if high_only else df
    names = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
    p = d.groupBy("hour").pivot("day_of_week", list(range(7))).agg(F.count(F.lit(1))).fillna(0)
    return p.select("hour", *[F.col(str(i)).alias(n) for i, n in enumerate(names)])


def _hour_spine(df: DataFrame, *keys: str) -> DataFrame:
    spine = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    return df.select(*keys).distinct().select(*keys, spine) if keys else df.sparkSession.range(1).select(spine)


def hourly_series(df: DataFrame, by: str | None = None, top: int | None = None) -> DataFrame:
    """A3: events per local hour, 24 hours zero-filled; per ``by`` value (optionally its top-n values)."""
    if by is None:
        return _hour_spine(df).join(counts_by(df, "hour"), "hour", "left").fillna(0, ["n"])
    d = df
    if top:
        keep = top_values(df, by, top)
        d = df.join(keep, by, "left_semi")
    spine = _hour_spine(d, by)
    return spine.join(counts_by(d, by, "hour"), [by, "hour"], "left").fillna(0, ["n"])


def top_values(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of ``key`` (ties by value) — a bounded top-k of the counts."""
    return counts_by(df.where(F.col(key).isNotNull()), key).orderBy(F.desc("n"), key).limit(n).select(key)


def weekday_counts(df: DataFrame) -> DataFrame:
    """A4."""
    return counts_by(df, "day_of_week")


def top_corridors(df: DataFrame, n: int = 15) -> DataFrame:
    """A5."""
    return counts_by(df, "corridor").orderBy(F.desc("n"), "corridor").limit(n)


def corridor_high_rate(df: DataFrame, min_count: int = 10, n: int = 15) -> DataFrame:
    """High share per corridor with at least ``min_count`` events (HAVING), top ``n``."""
    g = df.groupBy("corridor").agg(F.avg("priority_binary").alias("high_rate"), F.count(F.lit(1)).alias("n"))
    return g.where(F.col("n") >= min_count).orderBy(F.desc("high_rate"), "corridor").limit(n)


def row_share(df: DataFrame, row: str, col: str) -> DataFrame:
    """Crosstab normalised by row: share of each ``col`` value within ``row``."""
    c = counts_by(df, row, col)
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def histogram(df: DataFrame, value: str, bins: int, group: str | None = None) -> DataFrame:
    """Equal-width histogram between the (group's) min and max; the max falls in the last bin.

    Every bin appears (a ``sequence`` spine), empty ones with 0.
    """
    keys = [group] if group else []
    d = df.where(F.col(value).isNotNull())
    rng = d.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    ).cast("int")
    # One row per group: broadcast only the global (one-row) case; per-group ranges join by key.
    joined = d.join(rng, keys, "inner") if keys else d.crossJoin(F.broadcast(rng))
    counts = joined.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = rng.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def valid_durations(df: DataFrame) -> DataFrame:
    """Rows with 0 < resolution_hours < 200 and their ``log1p`` (the A8/A9 population)."""
    h = F.col("resolution_hours")
    return df.where(h.isNotNull() & (h > 0) & (h < 200)).withColumn("log_hours", F.log1p(h))


def box_stats(df: DataFrame, value: str, group: str, top: int = 8) -> DataFrame:
    """Quartiles and 1.5·IQR whiskers per group (top groups by count).

    The raw rows are aggregated once to ``(group, value) → count`` (written once);
    top groups, quartiles, whiskers and outlier counts all come from that table.
    """
    counts = materialize(
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group, F.col(value).cast("double").alias(value))
        .agg(F.count(F.lit(1)).alias("_c")),
        "box-counts",
    )
    keep = counts.groupBy(group).agg(F.sum("_c").alias("_n")).orderBy(F.desc("_n"), group).limit(top).select(group)
    d = counts.join(keep, group, "left_semi")
    q = exact_quantiles(d, value, [0.25, 0.5, 0.75], group, names=["q1", "median", "q3"], count_col="_c")
    j = d.join(q, group, "inner")
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v, c = F.col(value), F.col("_c")
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo_fence, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_fence, v)).alias("whisker_hi"),
        F.sum(F.when((v < lo_fence) | (v > hi_fence), c).otherwise(F.lit(0))).alias("outliers"),
        F.sum(c).alias("n"),
    )


def closure_rate_by_cause(df: DataFrame) -> DataFrame:
    """A10: closure rate per cause, causes with a rate above 0."""
    g = df.groupBy("event_cause").agg(F.avg("road_closure_binary").alias("closure_rate"), F.count(F.lit(1)).alias("n"))
    return g.where(F.col("closure_rate") > 0)


def daily_closures(df: DataFrame, local_col: str = "start_local") -> DataFrame:
    """A10: closures per local day."""
    return df.where(F.col("road_closure_binary") == 1).groupBy(F.to_date(local_col).alias("day")).agg(
        F.count(F.lit(1)).alias("closures")
    )


def zone_stats(df: DataFrame) -> DataFrame:
    """Events and High share per zone, unknown excluded."""
    return df.where(F.col("zone") != C.UNKNOWN).groupBy("zone").agg(
        F.count(F.lit(1)).alias("n"), F.avg("priority_binary").alias("high_rate")
    )


def planned_vs_unplanned(df: DataFrame, top: int = 8) -> DataFrame:
    """Per type, the cause share within the type (top causes per type) and closure rate."""
    g = df.groupBy("event_type", "event_cause").agg(
        F.count(F.lit(1)).alias("n"), F.avg("road_closure_binary").alias("closure_rate")
    )
    t = Window.partitionBy("event_type")
    ranked = g.withColumns(
        {"share": F.col("n") / F.sum("n").over(t), "rank": F.row_number().over(t.orderBy(F.desc("n"), "event_cause"))}
    )
    return ranked.where(F.col("rank") <= top)


def kpis(df: DataFrame) -> DataFrame:
    """Headline numbers in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum("is_planned").alias("planned_events"),
        F.avg("priority_binary").alias("high_share"),
        F.sum("road_closure_binary").alias("closures"),
        F.count_distinct("event_cause").alias("distinct_causes"),
        F.count_distinct("corridor").alias("distinct_corridors"),
    )


def filtered_slice(df: DataFrame, causes=None, priorities=None, types=None) -> DataFrame:
    """Optional predicates (pushed down to the scan) and four KPIs."""
    d = df
    if causes:
        d = d.where(F.col("event_cause").isin(list(causes)))
    if priorities:
        d = d.where(F.col("priority").isin(list(priorities)))
    if types:
        d = d.where(F.col("event_type").isin(list(types)))
    return d.agg(
        F.count(F.lit(1)).alias("events"),
        F.avg("priority_binary").alias("high_share"),
        F.avg("road_closure_binary").alias("closure_rate"),
        F.avg("resolution_hours").alias("mean_resolution_hours"),
    )


def map_sample(df: DataFrame, n: int = 3000, seed: int = 42) -> DataFrame:
    """At most ``n`` points, a deterministic hash-ordered top-k (same rows on every run)."""
    h = F.md5(F.concat(F.col("id").cast("string"), F.lit(f"#{seed}")))
    return df.withColumn("_h", h).orderBy("_h", "id").limit(n).drop("_h")
