"""Shared pieces of the query registry: output normalisation and the DuckDB oracle CTEs.

Registered queries return tidy tables: integers as ``bigint``, doubles rounded
to 6 places, instants as UTC text, booleans as 0/1, arrays joined to text.
The oracle SQL applies the same conventions so results compare value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.session import configure, spread, task_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Doubles are compared at 6 places.  Values that sit exactly on a rounding tie
# (durations are multiples of 1/3600 h) would round either way depending on the
# engine's summation order; a common nudge far above float noise (1e-15) and far
# below the rounding unit (1e-6) makes both engines round them the same way.
TIE_NUDGE = 1e-9

# Fixture parameters (FIXTURES.md): split date of the test tables, local offset.
TEST_SPLIT_DATE = "2024-01-22"


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return tidy(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def tidy(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double") + F.lit(TIE_NUDGE), 6)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.ArrayType):
            c = F.concat_ws("|", c.cast("array<string>"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# SQL helpers for the DuckDB oracle
# ---------------------------------------------------------------------------


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE) + {TIE_NUDGE}, 6)"


def i64(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def ts_txt(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def hav(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lng2}) - radians({lng1})) / 2), 2)"
    )
    return f"(2 * 6371.0e0 * asin(sqrt(least(1.0e0, {a}))))"


def _list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


CLEAN_CAUSES = [
    "vehicle_breakdown", "accident", "tree_fall", "water_logging", "construction", "public_event",
    "procession", "vip_movement", "protest", "congestion", "pot_holes", "road_conditions",
    "debris", "fog_low_visibility", "others",
]
CLEAN_VEHICLES = [
    "heavy_vehicle", "truck", "private_bus", "bmtc_bus", "ksrtc_bus", "lcv", "others",
    "private_car", "taxi", "auto", "unknown",
]
CLEAN_DESCRIPTIONS = ["Slow traffic near junction", "Road closed, barricades placed", "Two vehicle  collision", "", ""]
STATUSES = ["active", "resolved", "closed", "other"]

_LAT = "(12.80e0 + 0.47e0 * ((u * 37) % 150) / 150 + k * 0.0001e0)"
_LNG = "(77.30e0 + 0.47e0 * ((u * 71) % 150) / 150 + k * 0.0001e0)"
_ELAT = "(12.81e0 + 0.47e0 * ((u * 37) % 150) / 150)"
_ELNG = "(77.32e0 + 0.47e0 * ((u * 71) % 150) / 150)"

CTE_INCIDENTS = f"""
ev AS (
  SELECT event_id, user_id AS u, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         ts AS t0, event_type AS etype, value
  FROM events
),
ev2 AS (
  SELECT *,
    CASE WHEN k % 7 = 0 THEN NULL
         WHEN k % 11 = 0 THEN t0 - INTERVAL 60 SECOND
         WHEN k = 13 THEN t0 + INTERVAL 2600000 SECOND
         ELSE t0 + to_seconds(floor(value * 360)) END AS resolved_datetime,
    t0 + to_minutes(CAST(k * 20 - 60 AS BIGINT)) AS created_date,
    CASE WHEN etype NOT IN ('signup', 'purchase') THEN NULL
         WHEN k % 17 = 0 THEN t0 - INTERVAL 1 HOUR
         ELSE t0 + to_hours(CAST(k % 30 + 1 AS BIGINT)) END AS end_datetime
  FROM ev
),
inc AS (
  SELECT
    CAST(event_id AS VARCHAR) AS id, u, k,
    CASE WHEN etype IN ('signup', 'purchase') THEN 'planned' ELSE 'unplanned' END AS event_type,
    {_LAT} AS latitude,
    {_LNG} AS longitude,
    CASE WHEN k % 3 = 2 THEN {_ELAT} END AS endlatitude,
    CASE WHEN k % 3 = 2 THEN {_ELNG} END AS endlongitude,
    {_list(CLEAN_CAUSES)}[k % 15 + 1] AS event_cause,
    ((u * 7 + k) % 12 = 0) AS requires_road_closure,
    t0 AS start_datetime,
    end_datetime,
    created_date,
    created_date AS modified_datetime,
    CASE WHEN k % 5 = 0 THEN NULL ELSE resolved_datetime END AS closed_datetime,
    resolved_datetime,
    {_list(STATUSES)}[k % 4 + 1] AS status,
    CASE WHEN k = 99 THEN 'Low' WHEN (u + k) % 10 < 6 THEN 'High' ELSE 'Low' END AS priority,
    {_list(CLEAN_DESCRIPTIONS)}[k % 5 + 1] AS description,
    CASE WHEN u % 23 = 0 THEN 'unknown' WHEN u % 23 = 1 THEN 'Non-corridor' ELSE 'C' || CAST(u % 23 AS VARCHAR) END AS corridor,
    'Z' || CAST(u % 8 AS VARCHAR) AS zone,
    'PS' || CAST(u % 40 AS VARCHAR) AS police_station,
    CASE WHEN u % 50 = 0 THEN 'unknown' ELSE 'J' || CAST(u AS VARCHAR) END AS junction,
    {_list(CLEAN_VEHICLES)}[k % 11 + 1] AS veh_type,
    coalesce(CASE WHEN k % 5 = 0 THEN NULL ELSE resolved_datetime END, resolved_datetime) AS closed_datetime_combined,
    (epoch_us(coalesce(CASE WHEN k % 5 = 0 THEN NULL ELSE resolved_datetime END, resolved_datetime)) - epoch_us(t0)) / 3600000000.0e0 AS _res,
    (epoch_us(end_datetime) - epoch_us(t0)) / 3600000000.0e0 AS _plan,
    (epoch_us(created_date) - epoch_us(t0)) / 60000000.0e0 AS _resp,
    epoch_us(t0) AS start_us,
    t0 + INTERVAL 330 MINUTE AS start_local
  FROM ev2
),
clean AS (
  SELECT *,
    CASE WHEN _res >= 0 AND _res <= 720 THEN _res END AS resolution_hours,
    CASE WHEN _plan >= 0 THEN _plan END AS planned_duration_hours,
    CASE WHEN _resp >= 0 AND _resp <= 1440 THEN _resp END AS response_delay_minutes,
    (latitude BETWEEN 12.80e0 AND 13.27e0 AND longitude BETWEEN 77.30e0 AND 77.77e0) AS valid_start,
    CAST(priority = 'High' AS INTEGER) AS priority_binary,
    CAST(requires_road_closure AS INTEGER) AS road_closure_binary,
    CAST(event_type = 'planned' AS INTEGER) AS is_planned,
    CAST(veh_type <> 'unknown' AS INTEGER) AS has_vehicle,
    CASE status WHEN 'active' THEN 0 WHEN 'resolved' THEN 1 WHEN 'closed' THEN 2 ELSE 0 END AS status_encoded,
    length(description) AS description_length,
    CAST(k % 3 = 2 AS INTEGER) AS has_extent,
    CASE WHEN k % 3 = 2 THEN {hav('latitude', 'longitude', 'endlatitude', 'endlongitude')} ELSE 0.0e0 END AS event_extent_km
  FROM inc
)"""


def with_clean(body: str, *extra_ctes: str) -> str:
    ctes = [CTE_INCIDENTS.strip()] + [c.strip() for c in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def load_clean(spark: SparkSession, sf_dir: str, with_keys: bool = False, dealt: bool = False) -> DataFrame:
    """``dealt``: over many tasks before the rows become wide; a scan may have a single one for millions of narrow rows."""
    from roadpulse.operators.clean import clean_incidents
    from roadpulse.sources.incidents import incidents_from_events, read_table

    events = read_table(spark, sf_dir, "events")
    if dealt:
        events = spread(events, task_count(events, events.count()))
    return clean_incidents(incidents_from_events(events, with_keys=with_keys))


def load_scored(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Clean incidents + local calendar parts + deterministic pseudo-predictions (FIXTURES §6)."""
    from roadpulse.operators.features import temporal_features
    from roadpulse.sources.incidents import with_pseudo_predictions

    return with_pseudo_predictions(temporal_features(load_clean(spark, sf_dir, with_keys=True, dealt=dealt)))


CTE_SCORED = """
t AS (
  SELECT clean.*,
    hour(start_local) AS hour, isodow(start_local) - 1 AS day_of_week, month(start_local) AS month,
    CAST(hour(start_local) IN (8, 9, 10, 17, 18, 19, 20) AS INTEGER) AS is_rush_hour,
    CAST(isodow(start_local) - 1 >= 5 AS INTEGER) AS is_weekend
  FROM clean
),
sc0 AS (
  SELECT t.*,
    least(0.99e0, ((u * 13 + k * 7) % 100) / 100 * (0.4e0 + 0.1e0 * (k % 15))
                  + CASE WHEN k % 15 = 14 THEN 0.3e0 ELSE 0.0e0 END) AS severity_proba,
    ((u * 5 + k * 11) % 100) / 100 AS closure_proba,
    ((u * 5 + k * 11) % 100) > 50 AS closure_needed,
    ((k * 17 + u) % 300) / 20 AS duration_p50
  FROM t
),
sc AS (
  SELECT sc0.*,
    CASE WHEN severity_proba > 0.5 THEN 'High' ELSE 'Low' END AS severity,
    duration_p50 * (0.2e0 + 0.1e0 * (k % 15)) AS duration_mean,
    duration_p50 * 0.2e0 AS duration_p10, duration_p50 * 0.5e0 AS duration_p25,
    duration_p50 * 1.6e0 AS duration_p75, duration_p50 * 2.5e0 AS duration_p90
  FROM sc0
)"""


def with_scored(body: str, *extra_ctes: str) -> str:
    return with_clean(body, CTE_SCORED, *extra_ctes)
