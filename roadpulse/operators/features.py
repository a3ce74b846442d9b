"""Row-local feature operators: temporal (T1–T4), spatial (G1, G2, G4, G5, hex id of G3),
event profile (P1–P5) and interactions (I1), plus the temporal split (X2).

All are narrow projections that stay inside whole-stage codegen; lookups of the
config-sized tables are literal maps, so no join is needed at all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.config import DEFAULT, EngineConfig
from roadpulse.functions.geo import grid, haversine_km, hex_cell
from roadpulse.functions.text import contains_any, word_count
from roadpulse.functions.timefns import local_time


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def temporal_features(df: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """T1–T4 on the local wall clock of ``start_datetime``."""
    local = local_time(F.col("start_datetime"), cfg.timezone)
    df = df.withColumn("start_local", local)
    hour = F.hour("start_local")
    dow = F.weekday("start_local")  # 0 = Monday
    month = F.month("start_local")
    df = df.withColumns(
        {
            "hour": hour,
            "minute": F.minute("start_local"),
            "day_of_week": dow,
            "day_of_month": F.dayofmonth("start_local"),
            "month": month,
            "week_of_year": F.weekofyear("start_local"),
        }
    )
    h, d, m = F.col("hour"), F.col("day_of_week"), F.col("month")
    morning = h.isin(C.RUSH_HOURS_MORNING)
    evening = h.isin(C.RUSH_HOURS_EVENING)
    two_pi = 2 * math.pi
    period = None
    for label, cond in C.TIME_PERIODS:
        period = (F.when(F.expr(cond), F.lit(label)) if period is None else period.when(F.expr(cond), F.lit(label)))
    return df.withColumns(
        {
            "is_weekend": (d >= 5).cast("int"),
            "is_morning_rush": F.coalesce(morning, F.lit(False)).cast("int"),
            "is_evening_rush": F.coalesce(evening, F.lit(False)).cast("int"),
            "is_rush_hour": F.coalesce(morning | evening, F.lit(False)).cast("int"),
            "is_night": F.coalesce((h >= C.NIGHT_START) | (h < C.NIGHT_END), F.lit(False)).cast("int"),
            "hour_sin": F.sin(F.lit(two_pi) * h / 24),
            "hour_cos": F.cos(F.lit(two_pi) * h / 24),
            "dow_sin": F.sin(F.lit(two_pi) * d / 7),
            "dow_cos": F.cos(F.lit(two_pi) * d / 7),
            "month_sin": F.sin(F.lit(two_pi) * m / 12),
            "month_cos": F.cos(F.lit(two_pi) * m / 12),
            "time_period": period.otherwise(F.lit("other")),
        }
    )


def spatial_features(df: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """G2, G4, G5 and the hex id of G3 (counts per hex come from fitted state)."""
    lat0, lng0 = C.CITY_CENTER
    return df.withColumns(
        {
            "dist_to_center_km": haversine_km(F.col("latitude"), F.col("longitude"), lat0, lng0),
            "is_major_corridor": F.coalesce(~F.col("corridor").isin("Non-corridor", C.UNKNOWN), F.lit(True)).cast("int"),
            "lat_grid": grid(F.col("latitude")),
            "lng_grid": grid(F.col("longitude")),
            "hex_id": hex_cell(F.col("latitude"), F.col("longitude"), cfg.hex_size_km),
        }
    )


def profile_features(df: DataFrame) -> DataFrame:
    """P1–P5."""
    cause = F.col("event_cause")
    return df.withColumns(
        {
            "cause_severity_rank": F.coalesce(
                F.element_at(literal_map(C.CAUSE_SEVERITY_RANK), cause), F.lit(C.CAUSE_SEVERITY_DEFAULT)
            ),
            "is_planned_cause": F.coalesce(cause.isin(C.PLANNED_CAUSES), F.lit(False)).cast("int"),
            "is_infrastructure_cause": F.coalesce(cause.isin(C.INFRASTRUCTURE_CAUSES), F.lit(False)).cast("int"),
            "is_vehicle_cause": F.coalesce(cause.isin(C.VEHICLE_CAUSES), F.lit(False)).cast("int"),
            "is_nature_cause": F.coalesce(cause.isin(C.NATURE_CAUSES), F.lit(False)).cast("int"),
            "vehicle_severity": F.coalesce(
                F.element_at(literal_map(C.VEHICLE_SEVERITY), F.col("veh_type")), F.lit(C.VEHICLE_SEVERITY_DEFAULT)
            ),
            **{name: contains_any(F.col("description"), pat) for name, pat in C.DESC_PATTERNS.items()},
            "desc_word_count": word_count(F.col("description")),
        }
    )


def interaction_features(df: DataFrame) -> DataFrame:
    """Eight products of earlier features."""
    c = F.col
    return df.withColumns(
        {
            "rush_x_closure": c("is_rush_hour") * c("road_closure_binary"),
            "planned_x_major_corridor": c("is_planned") * c("is_major_corridor"),
            "severity_x_rush": c("cause_severity_rank") * c("is_rush_hour"),
            "weekend_x_planned_cause": c("is_weekend") * c("is_planned_cause"),
            "night_x_vehicle": c("is_night") * c("is_vehicle_cause"),
            "dist_x_severity": c("dist_to_center_km") * c("cause_severity_rank"),
            "concurrent_x_severity": c("events_same_corridor_24h") * c("cause_severity_rank"),
            "junction_freq_x_closure": c("junction_event_frequency") * c("junction_historical_closure_rate"),
        }
    )


def split_condition(split_date: str, cfg: EngineConfig = DEFAULT) -> Column:
    """True for training rows: local start before ``split_date`` (local midnight)."""
    return local_time(F.col("start_datetime"), cfg.timezone) < F.to_timestamp(F.lit(split_date))


def temporal_split(df: DataFrame, split_date: str | None = None, cfg: EngineConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(train, test) by one literal; both are filters that prune partitions on a date-partitioned table."""
    cond = split_condition(split_date or cfg.split_date, cfg)
    return df.where(cond), df.where(~cond)


def feature_sets() -> dict[str, list[str]]:
    """The three model feature lists."""
    allf = list(C.ALL_FEATURES)
    return {
        "all": allf,
        "severity": [f for f in allf if f not in C.SEVERITY_EXCLUDE],
        "duration": allf,
        "closure": [f for f in allf if f not in C.CLOSURE_EXCLUDE],
    }
