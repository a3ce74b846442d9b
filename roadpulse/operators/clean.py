"""Cleaning operators C1–C10: raw incident records → the clean incident table.

Every operator is a narrow projection (no shuffle) except the summary (C10,
one aggregate) and the opt-in coordinate imputation (C6, one small group-by
joined back by broadcast of a table bounded by the number of corridors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.config import DEFAULT, EngineConfig
from roadpulse.functions.geo import haversine_km
from roadpulse.functions.text import strip_all
from roadpulse.functions.timefns import hours_between, minutes_between

# Non-ISO layouts are rewritten to ISO order before one cast-style parse: a first number
# above 12 is a day, else mixed text is read month first; "YYYY/MM/DD ..." and the compact
# "YYYYMMDD", alone or before a time.  The ISO forms a plain cast accepts (space or T,
# fraction, Z or ±hh:mm offset) pass through unchanged.
_DATE = (
    r"^\s*(?:(?:(1[3-9]|2\d|3[01])[-/.](\d{1,2})|(\d{1,2})[-/.](\d{1,2}))[-/.](\d{4})"
    r"|(\d{4})/(\d{1,2})/(\d{1,2})|(\d{4})(\d{2})(\d{2})(?=\D|$|\d{6}$))"
)
_LAYOUTS = [
    (_DATE, "$5$6$9-$2$3$7$10-$1$4$8$11"),  # groups of the layouts not matched are empty
    (r"(?<=-\d\d)T?(\d{2})(\d{2})(\d{2})$", " $1:$2:$3"),
]
# Rewritten text, month names, and times of day with AM or PM; each part in brackets is optional.
_PARTS = (
    "[yyyy-M-d][MMM d, yyyy][MMMM d, yyyy][MMM d yyyy][d MMM yyyy][d MMMM yyyy][d-MMM-yyyy]"
    "[ h:mm:ss a][ h:mm a][ H:mm:ss][ H:mm]['T'H:mm:ss]['T'H:mm][.SSSSSS][XXX]"
)


def parse_timestamp(c: Column) -> Column:
    """Mixed-format text → UTC instant; unparseable text → null (never an error).

    Text without a zone is read as UTC (session zone), text with an offset is
    converted.  The layout rewrite and its parse are reached only by rows that failed
    the plain one; each value appears once in them, which matters once the optimizer
    copies the expression into pushed-down filters.
    """
    text = c.cast("string")
    rewritten = text
    for pattern, repl in _LAYOUTS:
        rewritten = F.regexp_replace(rewritten, pattern, repl)
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(F.when(F.trim(text) != "", F.trim(rewritten)), F.lit(_PARTS)))


def parse_timestamps(df: DataFrame, cols: list[str] = C.TIMESTAMP_COLUMNS) -> DataFrame:
    """C1."""
    return df.withColumns({c: parse_timestamp(F.col(c)) for c in cols if c in df.columns})


def normalize_causes(df: DataFrame, mapping: dict[str, str] = C.CAUSE_NORMALIZATION) -> DataFrame:
    """Strip all whitespace, then exact (case-sensitive) replacement."""
    stripped = strip_all(F.col("event_cause"))
    mapped = F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), stripped)
    return df.withColumn("event_cause", F.coalesce(mapped, stripped))


def flag_bbox(df: DataFrame, box: dict = C.BBOX) -> DataFrame:
    """Rows are kept; ``valid_start`` marks a start point inside the box (inclusive)."""
    inside = (
        F.col("latitude").between(box["min_lat"], box["max_lat"])
        & F.col("longitude").between(box["min_lng"], box["max_lng"])
    )
    return df.withColumn("valid_start", F.coalesce(inside, F.lit(False)))


def clean_end_coords(df: DataFrame) -> DataFrame:
    """C4: text → double (bad text → null); zero end coordinates → null."""
    out = {}
    for c in ["endlatitude", "endlongitude", "resolved_at_latitude", "resolved_at_longitude"]:
        if c in df.columns:
            v = F.expr(f"try_cast(`{c}` AS double)")
            out[c] = F.nullif(v, F.lit(0.0)) if c.startswith("end") else v
    return df.withColumns(out)


def fill_missing(df: DataFrame) -> DataFrame:
    """Categoricals → 'unknown', description → '', priority → 'Low'."""
    fills = {c: C.UNKNOWN for c in C.CATEGORICAL_FILL if c in df.columns}
    fills["description"] = ""
    fills["priority"] = "Low"
    return df.fillna(fills)


def impute_coords_by_group(df: DataFrame, key: str = "corridor") -> DataFrame:
    """C6 (opt-in): missing start coordinates ← the key's mean coordinates.

    The means table has one row per key value; it is joined without a hint so
    the planner broadcasts it only when its measured size allows.
    """
    means = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg("latitude").alias("_mlat"), F.avg("longitude").alias("_mlng"))
    )
    return (
        df.join(means, on=key, how="left")
        .withColumn("latitude", F.coalesce("latitude", "_mlat"))
        .withColumn("longitude", F.coalesce("longitude", "_mlng"))
        .drop("_mlat", "_mlng")
    )


def _within(value: Column, least: float, most: float | None = None) -> Column:
    """``value`` inside the bounds, else null; the value's expression (two parses of text) appears only once."""
    return F.get(F.filter(F.array(value), lambda v: (v >= least) & (v <= most) if most is not None else v >= least), F.lit(0))


def derive_durations(df: DataFrame) -> DataFrame:
    """Resolution / planned duration / response delay with the validity caps."""
    closed = F.coalesce(F.col("closed_datetime"), F.col("resolved_datetime"))
    res = hours_between(closed, F.col("start_datetime"))
    plan = hours_between(F.col("end_datetime"), F.col("start_datetime"))
    resp = minutes_between(F.col("created_date"), F.col("start_datetime"))
    return df.withColumns(
        {
            "closed_datetime_combined": closed,
            "resolution_hours": _within(res, 0, 720),
            "planned_duration_hours": _within(plan, 0),
            "response_delay_minutes": _within(resp, 0, 1440),
        }
    )


def derive_targets(df: DataFrame) -> DataFrame:
    """0/1 targets and flags, null-safe (a null comparison counts as false)."""
    closure = F.col("requires_road_closure")
    closure_bool = closure if dict(df.dtypes).get("requires_road_closure") == "boolean" else (
        F.lower(F.trim(closure.cast("string"))).isin("true", "1", "yes", "t")
    )
    status = F.element_at(F.create_map(*[F.lit(x) for kv in C.STATUS_CODES.items() for x in kv]), F.col("status"))
    return df.withColumns(
        {
            "requires_road_closure": F.coalesce(closure_bool, F.lit(False)),
            "priority_binary": F.coalesce(F.col("priority") == "High", F.lit(False)).cast("int"),
            "road_closure_binary": F.coalesce(closure_bool, F.lit(False)).cast("int"),
            "is_planned": F.coalesce(F.col("event_type") == "planned", F.lit(False)).cast("int"),
            "has_vehicle": F.coalesce(F.col("veh_type") != C.UNKNOWN, F.lit(True)).cast("int"),
            "status_encoded": F.coalesce(status, F.lit(0)).cast("int"),
        }
    )


def derive_extent(df: DataFrame) -> DataFrame:
    """Description length, extent flag, start→end haversine (0 without an end point)."""
    has_extent = F.col("endlatitude").isNotNull() & F.col("endlongitude").isNotNull()
    dist = haversine_km(F.col("latitude"), F.col("longitude"), F.col("endlatitude"), F.col("endlongitude"))
    return df.withColumns(
        {
            "description_length": F.length("description").cast("int"),
            "has_extent": has_extent.cast("int"),
            "event_extent_km": F.when(has_extent, F.coalesce(dist, F.lit(0.0))).otherwise(F.lit(0.0)),
        }
    )


def clean_incidents(raw: DataFrame, cfg: EngineConfig = DEFAULT, impute_coords: bool = False) -> DataFrame:
    """Raw records → clean table, all in one projection chain (Catalyst collapses it)."""
    df = raw.drop("_corrupt_record") if "_corrupt_record" in raw.columns else raw
    df = parse_timestamps(df)
    df = normalize_causes(df)
    df = flag_bbox(df)
    df = clean_end_coords(df)
    df = derive_durations(df)
    df = fill_missing(df)
    df = derive_targets(df)
    df = derive_extent(df)
    if impute_coords:
        df = impute_coords_by_group(df)
    return df


def quality_summary(clean: DataFrame, approx: bool = False) -> DataFrame:
    """One-row table summary (a single aggregate with partial aggregation)."""
    from roadpulse.operators.quantiles import exact_quantiles

    distinct = F.approx_count_distinct if approx else F.count_distinct
    if approx:
        med = clean.agg(F.percentile_approx("resolution_hours", 0.5, 10000).alias("median_resolution_hours"))
    else:
        med = exact_quantiles(clean, "resolution_hours", [0.5], names=["median_resolution_hours"])
    return clean.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("start_datetime").alias("first_start"),
        F.max("start_datetime").alias("last_start"),
        F.sum("is_planned").cast("bigint").alias("planned_events"),
        F.count_if(F.col("is_planned") == 0).alias("unplanned_events"),
        F.sum("priority_binary").cast("bigint").alias("high_priority"),
        F.avg("priority_binary").alias("high_priority_rate"),
        F.sum("road_closure_binary").cast("bigint").alias("road_closures"),
        F.avg("road_closure_binary").alias("road_closure_rate"),
        F.avg("resolution_hours").alias("mean_resolution_hours"),
        F.sum("has_vehicle").cast("bigint").alias("events_with_vehicle"),
        distinct("corridor").alias("unique_corridors"),
        distinct("junction").alias("unique_junctions"),
        distinct("police_station").alias("unique_police_stations"),
        F.count_if(~F.col("valid_start")).alias("outside_bbox"),
    ).crossJoin(F.broadcast(med))
