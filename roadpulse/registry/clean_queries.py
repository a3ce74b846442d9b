"""Registered queries for sources and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators.clean import impute_coords_by_group, quality_summary
from roadpulse.registry.common import i64, load_clean, r6, register, ts_txt, with_clean
from roadpulse.sources.incidents import read_table


@register(
    "s2_scan_events_pruned",
    """SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total_value
       FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
)
def s2_scan(spark, sf_dir):
    """Parquet scan with pushed filter and pruned columns (ReadSchema: user_id, event_type, value)."""
    ev = read_table(spark, sf_dir, "events")
    return (
        ev.where(F.col("event_type") == "purchase")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))
    )


@register(
    "c1_parse_timestamps",
    with_clean(
        f"""SELECT id, {ts_txt('start_datetime')} AS start_datetime, {ts_txt('end_datetime')} AS end_datetime,
       {ts_txt('created_date')} AS created_date, {ts_txt('modified_datetime')} AS modified_datetime,
       {ts_txt('closed_datetime')} AS closed_datetime, {ts_txt('resolved_datetime')} AS resolved_datetime
FROM clean"""
    ),
)
def c1(spark, sf_dir):
    return load_clean(spark, sf_dir).select(
        "id", "start_datetime", "end_datetime", "created_date", "modified_datetime", "closed_datetime",
        "resolved_datetime",
    )


@register("c2_normalize_causes", with_clean("SELECT id, event_cause FROM clean"))
def c2(spark, sf_dir):
    return load_clean(spark, sf_dir).select("id", "event_cause")


@register(
    "c3_flag_bbox",
    with_clean(
        "SELECT CAST(valid_start AS BIGINT) AS valid_start, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY 1"
    ),
)
def c3(spark, sf_dir):
    return load_clean(spark, sf_dir).groupBy("valid_start").agg(F.count(F.lit(1)).alias("n"))


@register(
    "c4_clean_end_coords",
    with_clean(f"SELECT id, {r6('endlatitude')} AS endlatitude, {r6('endlongitude')} AS endlongitude FROM clean"),
)
def c4(spark, sf_dir):
    return load_clean(spark, sf_dir).select("id", "endlatitude", "endlongitude")


@register(
    "c5_fill_missing",
    with_clean("SELECT id, corridor, zone, police_station, junction, veh_type, description, priority FROM clean"),
)
def c5(spark, sf_dir):
    return load_clean(spark, sf_dir).select(
        "id", "corridor", "zone", "police_station", "junction", "veh_type", "description", "priority"
    )


@register(
    "c6_impute_coords",
    with_clean(
        f"""SELECT c.id, {r6('coalesce(c.latitude, m.mlat)')} AS latitude, {r6('coalesce(c.longitude, m.mlng)')} AS longitude
FROM clean c LEFT JOIN (SELECT corridor, avg(latitude) AS mlat, avg(longitude) AS mlng FROM clean GROUP BY corridor) m
  ON c.corridor = m.corridor"""
    ),
)
def c6(spark, sf_dir):
    return impute_coords_by_group(load_clean(spark, sf_dir)).select("id", "latitude", "longitude")


@register(
    "c7_durations",
    with_clean(
        f"""SELECT id, {ts_txt('closed_datetime_combined')} AS closed_datetime_combined,
       {r6('resolution_hours')} AS resolution_hours, {r6('planned_duration_hours')} AS planned_duration_hours,
       {r6('response_delay_minutes')} AS response_delay_minutes
FROM clean"""
    ),
)
def c7(spark, sf_dir):
    return load_clean(spark, sf_dir).select(
        "id", "closed_datetime_combined", "resolution_hours", "planned_duration_hours", "response_delay_minutes"
    )


@register(
    "c8_targets",
    with_clean(
        f"""SELECT id, {i64('priority_binary')} AS priority_binary, {i64('road_closure_binary')} AS road_closure_binary,
       {i64('is_planned')} AS is_planned, {i64('has_vehicle')} AS has_vehicle, {i64('status_encoded')} AS status_encoded
FROM clean"""
    ),
)
def c8(spark, sf_dir):
    return load_clean(spark, sf_dir).select(
        "id", "priority_binary", "road_closure_binary", "is_planned", "has_vehicle", "status_encoded"
    )


@register(
    "c9_extent",
    with_clean(
        f"""SELECT id, {i64('description_length')} AS description_length, {i64('has_extent')} AS has_extent,
       {r6('event_extent_km')} AS event_extent_km FROM clean"""
    ),
)
def c9(spark, sf_dir):
    return load_clean(spark, sf_dir).select("id", "description_length", "has_extent", "event_extent_km")


@register(
    "c10_quality_summary",
    with_clean(
        f"""SELECT CAST(count(*) AS BIGINT) AS total_records,
  {ts_txt('min(start_datetime)')} AS first_start, {ts_txt('max(start_datetime)')} AS last_start,
  CAST(sum(is_planned) AS BIGINT) AS planned_events, CAST(count(*) FILTER (WHERE is_planned = 0) AS BIGINT) AS unplanned_events,
  CAST(sum(priority_binary) AS BIGINT) AS high_priority, {r6('avg(priority_binary)')} AS high_priority_rate,
  CAST(sum(road_closure_binary) AS BIGINT) AS road_closures, {r6('avg(road_closure_binary)')} AS road_closure_rate,
  {r6('quantile_cont(resolution_hours, 0.5)')} AS median_resolution_hours, {r6('avg(resolution_hours)')} AS mean_resolution_hours,
  CAST(sum(has_vehicle) AS BIGINT) AS events_with_vehicle,
  CAST(count(DISTINCT corridor) AS BIGINT) AS unique_corridors, CAST(count(DISTINCT junction) AS BIGINT) AS unique_junctions,
  CAST(count(DISTINCT police_station) AS BIGINT) AS unique_police_stations,
  CAST(count(*) FILTER (WHERE NOT valid_start) AS BIGINT) AS outside_bbox
FROM clean"""
    ),
)
def c10(spark, sf_dir):
    return quality_summary(load_clean(spark, sf_dir))
