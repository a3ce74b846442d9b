"""Data-driven estimator (D1–D8): per-cause statistics and formula estimates for a
batch of incidents, corridor defaults, representative coordinates and spillover.

Statistics tables have one row per cause / corridor and are left-joined without
a hint (adaptive execution broadcasts them when their measured size allows).
The spillover search is an equi-join on 15 km grid cells, their width fitted to the
latitude — candidates are the corridor centroids of the neighbouring cells, never a
cross product, and none is missed at any place on the globe.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.functions.geo import haversine_km
from roadpulse.functions.rounding import py_round
from roadpulse.operators.quantiles import exact_quantiles

RUSH_HOURS = C.RUSH_HOURS_MORNING + C.RUSH_HOURS_EVENING


def cause_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per cause severity and closure rate; mean/median/p10/p90 of positive durations.

    ``approx=True`` uses ``percentile_approx`` (one pass, bounded memory per group)
    instead of the exact distributed quantiles.
    """
    rates = df.where(F.col("event_cause").isNotNull()).groupBy("event_cause").agg(
        F.avg("priority_binary").alias("severity_rate"),
        F.avg("road_closure_binary").alias("closure_rate"),
    )
    valid = df.where(F.col("resolution_hours").isNotNull() & (F.col("resolution_hours") > 0) & F.col("event_cause").isNotNull())
    means = valid.groupBy("event_cause").agg(F.avg("resolution_hours").alias("avg_duration"))
    if approx:
        pa = F.percentile_approx("resolution_hours", [0.5, 0.1, 0.9], 10000)
        qs = valid.groupBy("event_cause").agg(pa.alias("_q")).select(
            "event_cause", *[F.col("_q")[i].alias(n) for i, n in enumerate(["median_duration", "p10_duration", "p90_duration"])]
        )
    else:
        qs = exact_quantiles(valid, "resolution_hours", [0.5, 0.1, 0.9], "event_cause",
                             names=["median_duration", "p10_duration", "p90_duration"])
    return rates.join(means, "event_cause", "left").join(qs, "event_cause", "left")


def corridor_stats(df: DataFrame) -> DataFrame:
    """Severity rate per corridor."""
    return df.where(F.col("corridor").isNotNull()).groupBy("corridor").agg(
        F.avg("priority_binary").alias("corridor_severity_rate")
    )


def rush_stats(df: DataFrame, hour_col: str = "hour") -> DataFrame:
    """Severity rate in rush hours vs outside (one row)."""
    rush = F.col(hour_col).isin(RUSH_HOURS)
    return df.agg(
        F.avg(F.when(rush, F.col("priority_binary"))).alias("rush_severity_rate"),
        F.avg(F.when(~rush, F.col("priority_binary"))).alias("nonrush_severity_rate"),
    )


def estimate(incidents: DataFrame, history: DataFrame) -> DataFrame:
    """D3–D5 for every incident of ``incidents`` from statistics of ``history``.

    ``incidents`` needs ``event_cause, corridor, is_rush_hour, is_weekend,
    requires_road_closure``; ``history`` is a clean table with ``hour``.
    """
    cs = cause_stats(history)
    cor = corridor_stats(history)
    rs = rush_stats(history)
    df = incidents.join(cs, "event_cause", "left").join(cor, "corridor", "left").crossJoin(F.broadcast(rs))
    rush = F.coalesce(F.col("is_rush_hour"), F.lit(0)) != 0
    weekend = F.coalesce(F.col("is_weekend"), F.lit(0)) != 0
    req = F.coalesce(F.col("requires_road_closure").cast("boolean"), F.lit(False))

    base = F.lit(0.6) * F.coalesce(F.col("severity_rate"), F.lit(0.5)) + F.lit(0.25) * F.coalesce(
        F.col("corridor_severity_rate"), F.lit(0.5)
    )
    rush_sev = F.coalesce(F.col("rush_severity_rate"), F.lit(0.65))
    nonrush_sev = F.coalesce(F.col("nonrush_severity_rate"), F.lit(0.55))
    boost = F.greatest(F.lit(0.0), rush_sev - nonrush_sev)
    s1 = F.when(rush, base + F.lit(0.15) * (boost / F.greatest(nonrush_sev, F.lit(0.01)))).otherwise(base)
    s2 = F.when(weekend, s1 * F.lit(0.95)).otherwise(s1)
    s3 = F.when(req, F.least(F.lit(0.99), s2 + F.lit(0.1))).otherwise(s2)
    sev = F.greatest(F.lit(0.01), F.least(F.lit(0.99), s3))

    med = F.coalesce(F.col("median_duration"), F.lit(1.5))
    p10 = F.coalesce(F.col("p10_duration"), F.lit(0.3))
    p90 = F.coalesce(F.col("p90_duration"), F.lit(10.0))
    p50 = med * F.when(rush, F.lit(1.25)).otherwise(F.lit(1.0)) * F.when(weekend, F.lit(0.9)).otherwise(F.lit(1.0))
    p10a = p10 * F.when(rush, F.lit(1.15)).otherwise(F.lit(1.0))
    p90a = p90 * F.when(rush, F.lit(1.3)).otherwise(F.lit(1.0))

    crate = F.coalesce(F.col("closure_rate"), F.lit(0.1))
    c1 = F.when(req, F.greatest(crate, F.lit(0.85))).otherwise(crate)
    cp = F.when(rush, F.least(F.lit(0.99), c1 * F.lit(1.15))).otherwise(c1)

    out = df.withColumns(
        {
            "severity_proba": sev,
            "duration_mean": F.coalesce(F.col("avg_duration"), F.lit(2.0)),
            "duration_p50": p50,
            "duration_p10": p10a,
            "duration_p90": p90a,
            "closure_proba": cp,
        }
    )
    out = out.withColumns(
        {
            "severity": F.when(F.col("severity_proba") > 0.5, F.lit("High")).otherwise(F.lit("Low")),
            "duration_p25": F.col("duration_p10") * F.lit(1.5),
            "duration_p75": F.col("duration_p90") * F.lit(0.6),
            "closure_needed": req | (F.col("closure_proba") > 0.5),
        }
    )
    drop = ["severity_rate", "closure_rate", "avg_duration", "median_duration", "p10_duration", "p90_duration",
            "corridor_severity_rate", "rush_severity_rate", "nonrush_severity_rate"]
    return out.drop(*drop)


def _mode_by(df: DataFrame, key: str, value: str, exclude: list[str] | None = None) -> DataFrame:
    """Most frequent ``value`` per ``key`` (ties: smaller value first)."""
    d = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    if exclude:
        d = d.where(~F.col(value).isin(exclude))
    counts = d.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(key).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(value))
    return best


def corridor_defaults(df: DataFrame) -> DataFrame:
    """Per corridor, the most common zone and the most common known junction."""
    zone = _mode_by(df, "corridor", "zone").withColumnRenamed("zone", "default_zone")
    junction = _mode_by(df, "corridor", "junction", [C.UNKNOWN]).withColumnRenamed("junction", "default_junction")
    return zone.join(junction, "corridor", "left").fillna({"default_junction": C.UNKNOWN})


def representative_coords(df: DataFrame, keys: list[str] = ("corridor", "junction")) -> DataFrame:
    """First non-null coordinate per key in time order (ties by id)."""
    keys = list(keys)
    d = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    first = F.min_by(F.struct("latitude", "longitude"), F.struct("start_datetime", "id"))
    return d.groupBy(*keys).agg(first.alias("_c")).select(*keys, F.col("_c.latitude").alias("rep_lat"), F.col("_c.longitude").alias("rep_lng"))


CENTROID_DIGITS = 9


def corridor_centroids(df: DataFrame) -> DataFrame:
    """Corridor centres for spillover (unknown and Non-corridor excluded).

    A distributed average's last bits depend on how rows were partitioned; the
    centres are quantised to 1e-9 degrees (0.1 mm) so distances and delays are
    the same on every cluster layout and in every engine.
    """
    return (
        df.where(~F.col("corridor").isin("Non-corridor", C.UNKNOWN) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy("corridor")
        .agg(F.avg("latitude").alias("c_lat"), F.avg("longitude").alias("c_lng"))
        .select("corridor", py_round(F.col("c_lat"), CENTROID_DIGITS).alias("c_lat"),
                py_round(F.col("c_lng"), CENTROID_DIGITS).alias("c_lng"))
    )


_KM_PER_DEG = math.pi * C.EARTH_RADIUS_KM / 180.0


def _band(lat: Column, max_km: float) -> Column:
    """Latitude band, a little higher than ``max_km``."""
    return F.floor(lat / F.lit(max_km / _KM_PER_DEG * 1.001)).cast("bigint")


def _band_cells(band: Column, max_km: float) -> Column:
    """How many equal cells go around a band: each at least ``max_km`` wide at the largest latitude
    of the band and its two neighbours, and one cell where a pole is that near."""
    height = max_km / _KM_PER_DEG * 1.001
    widest = F.least(F.lit(90.0), F.greatest(F.abs((band - 1) * F.lit(height)), F.abs((band + 2) * F.lit(height))))
    reach = F.lit(math.sin(max_km / (2 * C.EARTH_RADIUS_KM))) / F.greatest(F.cos(F.radians(widest)), F.lit(1e-9))
    width = F.degrees(2 * F.asin(F.least(F.lit(1.0), reach))) * F.lit(1.001)
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) / width)).cast("bigint")


def _cell(lng: Column, cells: Column) -> Column:
    """Cell of a longitude, counted around the globe."""
    return F.pmod(F.floor(F.pmod(lng, F.lit(360.0)) / (F.lit(360.0) / cells)).cast("bigint"), cells)


def spillover(incidents: DataFrame, centroids: DataFrame, top_n: int = 5, max_km: float = 15.0, min_delay: float = 3.0) -> DataFrame:
    """Delay on neighbouring corridors: ``proba·hours·30 / (km + 1)``; keep ≥ 3 min, ≤ 15 km, top 5.

    ``incidents``: ``id, corridor, latitude, longitude, severity_proba, duration_p50``.
    """
    around = centroids.select(
        F.col("corridor").alias("spill_corridor"), "c_lat", "c_lng",
        F.explode(F.array(*[_band(F.col("c_lat"), max_km) + dy for dy in (-1, 0, 1)])).alias("cy"),
    ).withColumn("cells", _band_cells(F.col("cy"), max_km))
    # Distinct: the cells of a band that has fewer than three coincide.
    near = F.array_distinct(F.array(*[F.pmod(_cell(F.col("c_lng"), F.col("cells")) + dx, F.col("cells")) for dx in (-1, 0, 1)]))
    cen = around.select("spill_corridor", "c_lat", "c_lng", "cy", F.explode(near).alias("cx"))
    inc = incidents.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "id", "corridor", "latitude", "longitude", "severity_proba", "duration_p50", _band(F.col("latitude"), max_km).alias("cy"),
    ).withColumn("cx", _cell(F.col("longitude"), _band_cells(F.col("cy"), max_km)))
    pairs = inc.join(cen, on=["cy", "cx"], how="inner").where(F.col("spill_corridor") != F.coalesce(F.col("corridor"), F.lit("")))
    dist = haversine_km(F.col("latitude"), F.col("longitude"), F.col("c_lat"), F.col("c_lng"))
    pairs = pairs.withColumn("distance_km", dist).withColumn(
        "delay_mins", F.col("severity_proba") * F.col("duration_p50") * F.lit(30.0) / (F.col("distance_km") + 1.0)
    )
    keep = pairs.where((F.col("delay_mins") >= min_delay) & (F.col("distance_km") <= max_km))
    w = Window.partitionBy("id").orderBy(F.desc("delay_mins"), "spill_corridor")
    return keep.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n).select(
        "id", "spill_corridor", "distance_km", "delay_mins", "rank"
    )


def spillover_rollup(spill: DataFrame) -> DataFrame:
    """D8 roll-up per incident: impacted corridors, max delay, total network delay."""
    return spill.groupBy("id").agg(
        F.count(F.lit(1)).alias("impacted_corridors"),
        F.max("delay_mins").alias("max_delay_mins"),
        F.sum("delay_mins").alias("total_network_delay_mins"),
    )

