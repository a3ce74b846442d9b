"""Registered queries for features, look-back counts and fitted state (T, G, P, L, I, E, X)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.config import DEFAULT
from roadpulse.functions.geo import hex_scales
from roadpulse.operators.features import profile_features, spatial_features, split_condition, temporal_features
from roadpulse.operators.lags import LagSpec, add_lookback_counts, lookback_counts_with_history
from roadpulse.operators.state import (
    LAG_SPECS,
    FeatureModel,
    group_rare,
    leave_one_out_encoding,
    point_in_time_means,
)
from roadpulse.registry.common import TEST_SPLIT_DATE, hav, i64, load_clean, r6, register, with_clean

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def load_features(spark, sf_dir):
    clean = load_clean(spark, sf_dir, dealt=True)
    return FeatureModel(DEFAULT).fit_split(clean, TEST_SPLIT_DATE).transform(clean)


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------


def dlit(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def case_map(col: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


def in_list(col: str, values: list) -> str:
    return f"{col} IN (" + ", ".join(f"'{v}'" for v in values) + ")"


_KY, _KX = hex_scales(DEFAULT.hex_size_km)
_S3 = math.sqrt(3) / 3
_HEX = f"""(
  SELECT CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -r - s ELSE q END AS BIGINT) AS VARCHAR) || ':' ||
         CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN r WHEN dr > ds THEN -q - s ELSE r END AS BIGINT) AS VARCHAR)
  FROM (SELECT q, r, s, abs(q - qf) AS dq, abs(r - rf) AS dr, abs(s - sf) AS ds
        FROM (SELECT round_even(qf, 0) AS q, round_even(rf, 0) AS r, round_even(sf, 0) AS s, qf, rf, sf
              FROM (SELECT qf, rf, -qf - rf AS sf
                    FROM (SELECT {dlit(_S3)} * (longitude * {dlit(_KX)}) - {dlit(1.0 / 3)} * (latitude * {dlit(_KY)}) AS qf,
                                 {dlit(2.0 / 3)} * (latitude * {dlit(_KY)}) AS rf))))
)"""

_TWO_PI = dlit(2 * math.pi)
_PERIOD = "CASE " + " ".join(f"WHEN {cond} THEN '{label}'" for label, cond in C.TIME_PERIODS) + " ELSE 'other' END"


def _word_count(col: str) -> str:
    return f"CASE WHEN trim({col}) = '' THEN 0 ELSE len(string_split_regex(trim({col}), '\\s+')) END"


def _desc_flags(col: str) -> str:
    return ",\n    ".join(
        f"CAST(coalesce(regexp_matches(lower({col}), '{pat}'), false) AS INTEGER) AS {name}"
        for name, pat in C.DESC_PATTERNS.items()
    )


CTE_FEATURES = f"""
f1 AS (
  SELECT c.*,
    hour(start_local) AS hour, minute(start_local) AS minute, isodow(start_local) - 1 AS day_of_week,
    dayofmonth(start_local) AS day_of_month, month(start_local) AS month, week(start_local) AS week_of_year,
    epoch_us(start_datetime) // 1000000 AS sec,
    (start_local < TIMESTAMP '{TEST_SPLIT_DATE}') AS is_train,
    {hav('latitude', 'longitude', dlit(C.CITY_CENTER[0]), dlit(C.CITY_CENTER[1]))} AS dist_to_center_km,
    CAST(corridor NOT IN ('Non-corridor', 'unknown') AS INTEGER) AS is_major_corridor,
    round_even(latitude * 100, 0) / 100 AS lat_grid,
    round_even(longitude * 100, 0) / 100 AS lng_grid,
    {_HEX} AS hex_id,
    {case_map('event_cause', C.CAUSE_SEVERITY_RANK, C.CAUSE_SEVERITY_DEFAULT)} AS cause_severity_rank,
    CAST({in_list('event_cause', C.PLANNED_CAUSES)} AS INTEGER) AS is_planned_cause,
    CAST({in_list('event_cause', C.INFRASTRUCTURE_CAUSES)} AS INTEGER) AS is_infrastructure_cause,
    CAST({in_list('event_cause', C.VEHICLE_CAUSES)} AS INTEGER) AS is_vehicle_cause,
    CAST({in_list('event_cause', C.NATURE_CAUSES)} AS INTEGER) AS is_nature_cause,
    {case_map('veh_type', C.VEHICLE_SEVERITY, C.VEHICLE_SEVERITY_DEFAULT)} AS vehicle_severity,
    {_desc_flags('description')},
    {_word_count('description')} AS desc_word_count
  FROM clean c
),
f2 AS (
  SELECT *,
    CAST(day_of_week >= 5 AS INTEGER) AS is_weekend,
    CAST(hour IN (8, 9, 10) AS INTEGER) AS is_morning_rush,
    CAST(hour IN (17, 18, 19, 20) AS INTEGER) AS is_evening_rush,
    CAST(hour IN (8, 9, 10, 17, 18, 19, 20) AS INTEGER) AS is_rush_hour,
    CAST(hour >= 22 OR hour < 6 AS INTEGER) AS is_night,
    sin({_TWO_PI} * hour / 24) AS hour_sin, cos({_TWO_PI} * hour / 24) AS hour_cos,
    sin({_TWO_PI} * day_of_week / 7) AS dow_sin, cos({_TWO_PI} * day_of_week / 7) AS dow_cos,
    sin({_TWO_PI} * month / 12) AS month_sin, cos({_TWO_PI} * month / 12) AS month_cos,
    {_PERIOD} AS time_period,
    count(*) OVER (PARTITION BY corridor ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS events_same_corridor_24h,
    count(*) OVER (PARTITION BY zone ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING) AS events_same_zone_7d,
    count(*) OVER (PARTITION BY police_station ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS events_same_ps_24h,
    count(*) OVER (ORDER BY sec RANGE BETWEEN 21600 PRECEDING AND 1 PRECEDING)
      + row_number() OVER (PARTITION BY sec ORDER BY start_us, id) - 1 AS total_events_last_6h
  FROM f1
),
g AS (
  SELECT avg(resolution_hours) AS g_res, avg(priority_binary) AS g_pri, avg(road_closure_binary) AS g_clo
  FROM f1 WHERE is_train
),
""" + ",\n".join(
    f"""ks_{k} AS (
  SELECT {k}, count(*) AS n, avg(resolution_hours) AS mres, avg(road_closure_binary) AS clo, avg(priority_binary) AS pri
  FROM f1 WHERE is_train AND {k} IS NOT NULL GROUP BY {k}
)"""
    for k in ["event_cause", "corridor", "junction", "police_station", "zone", "hex_id"]
) + f""",
feat AS (
  SELECT f2.*,
    CAST(coalesce(ks_corridor.n, 0) AS DOUBLE) AS corridor_event_frequency,
    CAST(coalesce(ks_junction.n, 0) AS DOUBLE) AS junction_event_frequency,
    CAST(coalesce(ks_police_station.n, 0) AS DOUBLE) AS police_station_event_frequency,
    CAST(coalesce(ks_hex_id.n, 0) AS DOUBLE) AS hex_event_count,
    coalesce(ks_event_cause.mres, g.g_res) AS cause_avg_resolution_hours,
    coalesce(ks_corridor.mres, g.g_res) AS corridor_avg_resolution_hours,
    coalesce(ks_event_cause.clo, 0.0e0) AS cause_historical_closure_rate,
    coalesce(ks_junction.clo, 0.0e0) AS junction_historical_closure_rate,
    coalesce(ks_event_cause.pri, 0.5e0) AS cause_historical_priority_rate,
""" + ",\n".join(
    f"""    coalesce((ks_{k}.n * ks_{k}.pri + 10 * g.g_pri) / (ks_{k}.n + 10), g.g_pri) AS {k}_te_priority_binary,
    coalesce((ks_{k}.n * ks_{k}.clo + 10 * g.g_clo) / (ks_{k}.n + 10), g.g_clo) AS {k}_te_road_closure_binary"""
    for k in C.TARGET_ENCODING_KEYS
) + """
  FROM f2 CROSS JOIN g
""" + "\n".join(
    f"  LEFT JOIN ks_{k} ON f2.{k} = ks_{k}.{k}"
    for k in ["event_cause", "corridor", "junction", "police_station", "zone", "hex_id"]
) + """
),
featx AS (
  SELECT *,
    is_rush_hour * road_closure_binary AS rush_x_closure,
    is_planned * is_major_corridor AS planned_x_major_corridor,
    cause_severity_rank * is_rush_hour AS severity_x_rush,
    is_weekend * is_planned_cause AS weekend_x_planned_cause,
    is_night * is_vehicle_cause AS night_x_vehicle,
    dist_to_center_km * cause_severity_rank AS dist_x_severity,
    events_same_corridor_24h * cause_severity_rank AS concurrent_x_severity,
    junction_event_frequency * junction_historical_closure_rate AS junction_freq_x_closure
  FROM feat
)"""

INT_FEATURES = {
    "hour", "minute", "day_of_week", "day_of_month", "month", "week_of_year", "is_weekend", "is_morning_rush",
    "is_evening_rush", "is_rush_hour", "is_night", "is_major_corridor", "is_planned", "has_vehicle",
    "road_closure_binary", "cause_severity_rank", "is_planned_cause", "is_infrastructure_cause", "is_vehicle_cause",
    "is_nature_cause", "vehicle_severity", "description_length", "desc_has_traffic_slow", "desc_has_road_closed",
    "desc_has_accident", "desc_word_count", "has_extent", "events_same_corridor_24h", "events_same_zone_7d",
    "events_same_ps_24h", "total_events_last_6h", "rush_x_closure", "planned_x_major_corridor", "severity_x_rush",
    "weekend_x_planned_cause", "night_x_vehicle", "concurrent_x_severity",
}


def sql_cols(cols: list[str]) -> str:
    return ", ".join(f"{i64(c)} AS {c}" if c in INT_FEATURES else (c if c in ("id", "time_period", "hex_id") else f"{r6(c)} AS {c}") for c in cols)


def feature_sql(cols: list[str], where: str = "") -> str:
    return with_clean(f"SELECT id, {sql_cols(cols)} FROM featx {where}", CTE_FEATURES)


def feature_query(name: str, cols: list[str], build=None):
    """``build`` makes the features from clean rows alone; without it they need the fitted state."""

    @register(name, feature_sql(cols))
    def q(spark, sf_dir):
        rows = build(load_clean(spark, sf_dir)) if build else load_features(spark, sf_dir)
        return rows.select("id", *cols)

    return q


def lookbacks(name: str):
    return lambda clean: add_lookback_counts(clean, [s for s in LAG_SPECS if s.name == name])


feature_query("t1_calendar_parts", ["hour", "minute", "day_of_week", "day_of_month", "month", "week_of_year", "is_weekend"], temporal_features)
feature_query("t2_rush_night_flags", ["is_morning_rush", "is_evening_rush", "is_rush_hour", "is_night"], temporal_features)
feature_query("t3_cyclical_encoding", ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"], temporal_features)
feature_query("t4_time_period", ["time_period"], temporal_features)
feature_query("g1_haversine_extent", ["event_extent_km"], lambda clean: clean)
feature_query("g2_distance_to_center", ["dist_to_center_km"], spatial_features)
feature_query("g3_hex_event_count", ["hex_id", "hex_event_count"])
feature_query("g4_lat_lng_grid", ["lat_grid", "lng_grid"], spatial_features)
feature_query("g5_major_corridor", ["is_major_corridor"], spatial_features)
feature_query("p1_cause_severity_rank", ["cause_severity_rank"], profile_features)
feature_query("p2_cause_groups", ["is_planned_cause", "is_infrastructure_cause", "is_vehicle_cause", "is_nature_cause"], profile_features)
feature_query("p3_vehicle_severity", ["vehicle_severity"], profile_features)
feature_query("p4_description_flags", list(C.DESC_PATTERNS), profile_features)
feature_query("p5_description_word_count", ["desc_word_count"], profile_features)
feature_query("l1_key_frequency", ["corridor_event_frequency", "junction_event_frequency", "police_station_event_frequency"])
feature_query("l2_rolling_corridor_24h", ["events_same_corridor_24h"], lookbacks("events_same_corridor_24h"))
feature_query("l2_rolling_zone_7d", ["events_same_zone_7d"], lookbacks("events_same_zone_7d"))
feature_query("l2_rolling_station_24h", ["events_same_ps_24h"], lookbacks("events_same_ps_24h"))
feature_query("l3_rolling_global_6h", ["total_events_last_6h"], lookbacks("total_events_last_6h"))
feature_query(
    "l5_historical_means",
    ["cause_avg_resolution_hours", "corridor_avg_resolution_hours", "cause_historical_closure_rate",
     "junction_historical_closure_rate", "cause_historical_priority_rate"],
)
feature_query("i1_interactions", list(C.INTERACTION_FEATURES))
feature_query("e1_target_encoding", list(C.ENCODED_FEATURES))
feature_query("x1_feature_table", list(C.ALL_FEATURES))


# L4: several windows over one key, one shared shuffle.
_L4_HOURS = C.LAG_WINDOWS_HOURS


@register(
    "l4_multi_window_corridor",
    with_clean(
        "SELECT id, "
        + ", ".join(
            f"CAST(count(*) OVER (PARTITION BY corridor ORDER BY sec RANGE BETWEEN {h * 3600} PRECEDING AND 1 PRECEDING) AS BIGINT) AS corridor_last_{h}h"
            for h in _L4_HOURS
        )
        + " FROM f1",
        CTE_FEATURES.split("f2 AS (")[0].rstrip().rstrip(","),
    ),
)
def l4(spark, sf_dir):
    specs = [LagSpec(f"corridor_last_{h}h", "corridor", h) for h in _L4_HOURS]
    clean = load_clean(spark, sf_dir, dealt=True)
    return add_lookback_counts(clean, specs).select("id", *[s.name for s in specs])


@register(
    "l6_point_in_time_cause_means",
    with_clean(
        f"""SELECT id, {r6('pit_resolution_hours')} AS pit_resolution_hours, {r6('pit_road_closure_binary')} AS pit_road_closure_binary,
       {r6('pit_priority_binary')} AS pit_priority_binary
FROM (SELECT id,
  avg(resolution_hours) OVER w AS pit_resolution_hours,
  avg(road_closure_binary) OVER w AS pit_road_closure_binary,
  avg(priority_binary) OVER w AS pit_priority_binary
FROM clean
WINDOW w AS (PARTITION BY event_cause ORDER BY start_us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
    ),
)
def l6(spark, sf_dir):
    clean = load_clean(spark, sf_dir, dealt=True)
    return point_in_time_means(clean, "event_cause", ["resolution_hours", "road_closure_binary", "priority_binary"])


@register(
    "l7_history_aware_lags",
    feature_sql(["events_same_corridor_24h", "events_same_zone_7d", "events_same_ps_24h", "total_events_last_6h"], "WHERE NOT is_train"),
)
def l7(spark, sf_dir):
    """Score the test slice alone, with the training slice supplied as history."""
    clean = load_clean(spark, sf_dir, dealt=True)
    train = clean.where(split_condition(TEST_SPLIT_DATE))
    test = clean.where(~split_condition(TEST_SPLIT_DATE))
    out = lookback_counts_with_history(test, train, LAG_SPECS)
    return out.select("id", *[s.name for s in LAG_SPECS])


@register(
    "e2_leave_one_out_encoding",
    with_clean(
        f"""SELECT id, {r6('coalesce((s - priority_binary + 10 * g) / (n - 1 + 10), g)')} AS event_cause_loo_priority_binary
FROM (SELECT id, priority_binary, sum(priority_binary) OVER (PARTITION BY event_cause) AS s,
             count(priority_binary) OVER (PARTITION BY event_cause) AS n, avg(priority_binary) OVER () AS g FROM clean)"""
    ),
)
def e2(spark, sf_dir):
    clean = load_clean(spark, sf_dir)
    return leave_one_out_encoding(clean, "event_cause", "priority_binary").select("id", "event_cause_loo_priority_binary")


@register(
    "e4_rare_hex_grouping",
    with_clean(
        """SELECT hex_id, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN count(*) OVER (PARTITION BY hex_id) < 5 THEN 'others' ELSE hex_id END AS hex_id FROM f1
) GROUP BY hex_id""",
        CTE_FEATURES.split("f2 AS (")[0].rstrip().rstrip(","),
    ),
)
def e4(spark, sf_dir):
    df = spatial_features(load_clean(spark, sf_dir))
    return group_rare(df, "hex_id", 5).groupBy("hex_id").agg(F.count(F.lit(1)).alias("n"))


@register(
    "x2_temporal_split",
    with_clean(
        "SELECT CAST(is_train AS BIGINT) AS is_train, CAST(count(*) AS BIGINT) AS n FROM f1 GROUP BY 1",
        CTE_FEATURES.split("f2 AS (")[0].rstrip().rstrip(","),
    ),
)
def x2(spark, sf_dir):
    clean = load_clean(spark, sf_dir)
    return clean.groupBy(split_condition(TEST_SPLIT_DATE).alias("is_train")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "entry_corridor_pressure",
    with_clean(
        f"""SELECT corridor, CAST(count(*) AS BIGINT) AS events,
       {r6('avg(events_same_corridor_24h)')} AS mean_corridor_24h,
       {r6('avg(total_events_last_6h)')} AS mean_city_6h,
       CAST(max(events_same_corridor_24h) AS BIGINT) AS max_corridor_24h
FROM f2 GROUP BY corridor ORDER BY mean_corridor_24h DESC, corridor LIMIT 10""",
        CTE_FEATURES.split("g AS (")[0].rstrip().rstrip(","),
    ),
)
def entry_corridor_pressure(spark, sf_dir):
    """Flagship: clean incidents → bucketed look-back counts → top-10 corridors by mean 24 h pressure."""
    specs = [s for s in LAG_SPECS if s.name in ("events_same_corridor_24h", "total_events_last_6h")]
    df = add_lookback_counts(load_clean(spark, sf_dir, dealt=True), specs)
    return (
        df.groupBy("corridor")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg("events_same_corridor_24h").alias("mean_corridor_24h"),
            F.avg("total_events_last_6h").alias("mean_city_6h"),
            F.max("events_same_corridor_24h").alias("max_corridor_24h"),
        )
        .orderBy(F.desc("mean_corridor_24h"), "corridor")
        .limit(10)
    )
