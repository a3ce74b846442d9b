"""Mixed timestamp layouts are read, and what is no timestamp becomes null."""

import pytest
from pyspark.sql import functions as F

from roadpulse.operators.clean import parse_timestamp

CASES = {
    "2024-03-05 10:00:00": "2024-03-05 10:00:00",
    "2024-03-05T10:00:00Z": "2024-03-05 10:00:00",
    "2024-03-05 10:00:00+05:30": "2024-03-05 04:30:00",
    "25/12/2024 10:00:00": "2024-12-25 10:00:00",
    "25.12.2024": "2024-12-25 00:00:00",
    "3/5/2024 2:30 PM": "2024-03-05 14:30:00",
    "3-5-2024 14:30": "2024-03-05 14:30:00",
    "Mar 5, 2024 10:00": "2024-03-05 10:00:00",
    "March 5, 2024 4:05:06 PM": "2024-03-05 16:05:06",
    "5 March 2024": "2024-03-05 00:00:00",
    "3/5/2024 14:30:01.25": "2024-03-05 14:30:01",
    "2024/03/05T10:00:00+05:30": "2024-03-05 04:30:00",
    "20240305": "2024-03-05 00:00:00",
    "20240305T101112": "2024-03-05 10:11:12",
    "20240305101112": "2024-03-05 10:11:12",
    "2024-03-05 10:00:00 AM": "2024-03-05 10:00:00",
    "2024/03/05 12:15 AM": "2024-03-05 00:15:00",
    "NULL": None, "": None, "   ": None, "13/13/2024": None, "soon": None,
}


def test_layouts(spark):
    df = spark.createDataFrame([*((t,) for t in CASES), (None,)], "t string")
    got = {r.t: r.p for r in df.select("t", F.date_format(parse_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("p")).collect()}
    assert got == {**CASES, None: None}
