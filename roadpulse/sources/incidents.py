"""Incident sources.

* :func:`read_incidents_csv` — raw CSV with an explicit schema (S1).
* :func:`read_table` — parquet scan of a processed table (S2).
* :func:`incidents_from_events` — the test binding that turns the driver's
  ``events`` table into raw incident records (text timestamps in mixed formats,
  ``NULL`` strings, zeros), so that every cleaning rule is exercised on data
  whose size grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import config as C
from roadpulse.sources.csv_split import read_csv_split

_DOUBLE_RAW = {"latitude", "longitude"}

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c in _DOUBLE_RAW else T.StringType(), True) for c in C.RAW_COLUMNS]
    + [T.StructField("_corrupt_record", T.StringType(), True)]
)

# Tokens that the CSV reader of the reproduced behaviour reads as missing.
NULL_TOKENS = ["", "NULL", "NA", "N/A", "NaN", "nan", "null", "None", "<NA>", "#N/A", "n/a", "-NaN", "-nan"]


def read_incidents_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw incident CSV with the 46-column contract; bad rows kept in ``_corrupt_record``.

    A file is read by as many tasks as it has splits, line ends inside quoted fields included.
    """
    options = {"nullValue": "NULL", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    df = read_csv_split(spark, path, RAW_SCHEMA, options)
    # One nullValue is all the reader takes; the other missing-value tokens become null here.
    fixed = [
        F.when(F.col(c).isin(NULL_TOKENS), F.lit(None)).otherwise(F.col(c)).alias(c)
        if isinstance(RAW_SCHEMA[c].dataType, T.StringType)
        else F.col(c)
        for c in C.RAW_COLUMNS
    ]
    return df.select(*fixed, "_corrupt_record")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list) -> Column:
    """element ``index`` (0-based) of a fixed list; list entries may be None."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index + 1).cast("int"))


def _ts_text(ts: Column, style: Column) -> Column:
    """Render an instant (NTZ, UTC wall clock) as text in one of three styles.

    0: ``yyyy-MM-dd HH:mm:ss.SSSSSS`` (UTC, no zone), 1: ISO ``T`` with ``Z``,
    2: local wall clock with an explicit ``+05:30`` offset.
    """
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    local = ts + F.expr("INTERVAL 330 MINUTES")
    return (
        F.when(style == 0, F.date_format(ts, micros))
        .when(style == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .otherwise(F.concat(F.date_format(local, micros), F.lit("+05:30")))
    )


CAUSE_CYCLE = [
    "vehicle_breakdown", "accident", "tree_fall", "water_logging", "construction", "public_event",
    "procession", "vip_movement", "protest", "congestion", "pot_holes", "road_conditions",
    "Debris", "Fog / Low Visibility", "test_demo",
]
VEHICLE_CYCLE = [
    "heavy_vehicle", "truck", "private_bus", "bmtc_bus", "ksrtc_bus", "lcv", "others",
    "private_car", "taxi", "auto", None,
]
DESCRIPTION_CYCLE = ["Slow traffic near junction", "Road closed, barricades placed", "Two vehicle  collision", "", None]
STATUS_CYCLE = ["active", "resolved", "closed", "other"]


def incidents_from_events(events: DataFrame, with_keys: bool = False) -> DataFrame:
    """Raw incident records derived row-by-row from ``events`` (a narrow projection, no shuffle).

    ``with_keys`` also keeps the binding's two generator keys (``_u``, ``_k``)
    so deterministic pseudo-predictions can be derived without a join.
    """
    u = F.col("user_id")
    k = F.regexp_extract(F.col("props"), r"([0-9]+)", 1).cast("bigint")
    ts = F.col("ts").cast("timestamp_ntz")
    style = F.col("event_id") % 3

    base = events.select(
        F.col("event_id"), u.alias("u"), k.alias("k"), ts.alias("t0"), F.col("event_type").alias("etype"),
        F.col("value"),
    )
    u, k, t0 = F.col("u"), F.col("k"), F.col("t0")

    cause = _pick(k % 15, CAUSE_CYCLE)
    cause = F.when(u % 10 == 0, F.concat(F.lit(" "), cause)).otherwise(cause)
    planned = F.col("etype").isin("signup", "purchase")
    corridor = (
        F.when(u % 23 == 0, F.lit(None).cast("string"))
        .when(u % 23 == 1, F.lit("Non-corridor"))
        .otherwise(F.concat(F.lit("C"), (u % 23).cast("string")))
    )
    lat = F.lit(12.80) + F.lit(0.47) * ((u * 37) % 150) / F.lit(150) + k * F.lit(0.0001)
    lng = F.lit(77.30) + F.lit(0.47) * ((u * 71) % 150) / F.lit(150) + k * F.lit(0.0001)
    end_lat = F.lit(12.81) + F.lit(0.47) * ((u * 37) % 150) / F.lit(150)
    end_lng = F.lit(77.32) + F.lit(0.47) * ((u * 71) % 150) / F.lit(150)

    def end_text(v: Column) -> Column:
        return F.when(k % 3 == 0, F.lit("NULL")).when(k % 3 == 1, F.lit("0")).otherwise(v.cast("string"))

    def minutes(n: Column) -> Column:
        return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))

    def seconds(n: Column) -> Column:
        return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))

    created = t0 + minutes(k * 20 - 60)
    end_ts = (
        F.when(~planned, F.lit(None).cast("timestamp_ntz"))
        .when(k % 17 == 0, t0 - minutes(F.lit(60)))
        .otherwise(t0 + minutes((k % 30 + 1) * 60))
    )
    resolved = (
        F.when(k % 7 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(k % 11 == 0, t0 - seconds(F.lit(60)))
        .when(k == 13, t0 + seconds(F.lit(2_600_000)))
        .otherwise(t0 + seconds(F.floor(F.col("value") * 360)))
    )
    closed = F.when(k % 5 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(resolved)

    def ts_or_null(v: Column) -> Column:
        return F.when(v.isNull(), F.lit("NULL")).otherwise(_ts_text(v, style))

    derived = {
        "id": F.col("event_id").cast("string"),
        "event_type": F.when(planned, F.lit("planned")).otherwise(F.lit("unplanned")),
        "latitude": lat,
        "longitude": lng,
        "endlatitude": end_text(end_lat),
        "endlongitude": end_text(end_lng),
        "event_cause": cause,
        "requires_road_closure": F.when((u * 7 + k) % 12 == 0, F.lit("TRUE")).otherwise(F.lit("FALSE")),
        "start_datetime": _ts_text(t0, style),
        "end_datetime": ts_or_null(end_ts),
        "status": _pick(k % 4, STATUS_CYCLE),
        "modified_datetime": ts_or_null(created),
        "description": _pick(k % 5, DESCRIPTION_CYCLE),
        "veh_type": _pick(k % 11, VEHICLE_CYCLE),
        "corridor": corridor,
        "priority": F.when(k == 99, F.lit(None).cast("string"))
        .when((u + k) % 10 < 6, F.lit("High"))
        .otherwise(F.lit("Low")),
        "created_date": ts_or_null(created),
        "police_station": F.concat(F.lit("PS"), (u % 40).cast("string")),
        "closed_datetime": ts_or_null(closed),
        "resolved_datetime": ts_or_null(resolved),
        "zone": F.concat(F.lit("Z"), (u % 8).cast("string")),
        "junction": F.when(u % 50 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("J"), u.cast("string"))),
    }
    cols = [
        derived.get(c, F.lit(None).cast(RAW_SCHEMA[c].dataType)).cast(RAW_SCHEMA[c].dataType).alias(c)
        for c in C.RAW_COLUMNS
    ]
    if with_keys:
        cols += [u.alias("_u"), k.alias("_k")]
    return base.select(*cols)


def with_pseudo_predictions(df: DataFrame) -> DataFrame:
    """Deterministic stand-in predictions from the binding keys (FIXTURES §6).

    They give the plan, feedback and metric operators exact oracles without a
    trained model: ``severity_proba``, ``closure_proba``/``closure_needed`` and
    the duration quantiles ``duration_mean/p10/p25/p50/p75/p90``.
    """
    u, k = F.col("_u"), F.col("_k")
    sev = F.least(
        F.lit(0.99),
        ((u * 13 + k * 7) % 100) / F.lit(100) * (F.lit(0.4) + F.lit(0.1) * (k % 15))
        + F.when(k % 15 == 14, F.lit(0.3)).otherwise(F.lit(0.0)),
    )
    p50 = ((k * 17 + u) % 300) / F.lit(20)
    return df.withColumns(
        {
            "severity_proba": sev,
            "closure_proba": ((u * 5 + k * 11) % 100) / F.lit(100),
            "closure_needed": ((u * 5 + k * 11) % 100) > 50,
            "duration_p50": p50,
        }
    ).withColumns(
        {
            "severity": F.when(F.col("severity_proba") > 0.5, F.lit("High")).otherwise(F.lit("Low")),
            "duration_mean": F.col("duration_p50") * (F.lit(0.2) + F.lit(0.1) * (k % 15)),
            "duration_p10": F.col("duration_p50") * F.lit(0.2),
            "duration_p25": F.col("duration_p50") * F.lit(0.5),
            "duration_p75": F.col("duration_p50") * F.lit(1.6),
            "duration_p90": F.col("duration_p50") * F.lit(2.5),
        }
    )
