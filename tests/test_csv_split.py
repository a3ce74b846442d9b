"""Quoted CSV read by several tasks equals the reader that takes a file as one task."""

import random

import pytest
from pyspark.sql import types as T

from roadpulse.sources.csv_split import _inside_after, read_csv_split

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c", "_corrupt_record")])
OPTIONS = {"nullValue": "NULL", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def _field(rng):
    plain = ["x", "NULL", "", "12.5", "5 ft 6", "naïve", 'in 5" pipe', "a b"]
    if rng.random() < 0.6:
        return rng.choice(plain)
    inner = "".join(rng.choice(["line", "\n", "\n\n", '""', ",", " ", "7", '"",""', "long text " * rng.choice([1, 40])]) for _ in range(rng.randrange(1, 8)))
    return f'"{inner}"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_multiline_reader(spark, tmp_path, end):
    rng = random.Random(4)
    for f in range(3):
        rows = [",".join([str(i), _field(rng), _field(rng)]) for i in range(500 if f < 2 else 0)]
        rows[100:100] = ["", ""]  # empty lines between records
        body = end.join(["a,b,c", *rows]) + (end if f else "")
        (tmp_path / f"f{f}.csv").write_bytes(body.encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    want = spark.read.schema(SCHEMA).options(**OPTIONS, header="true", multiLine="true", escape='"').csv(str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_csv_split(spark, str(tmp_path), SCHEMA, OPTIONS)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        rows = sorted(map(tuple, got.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == sorted(map(tuple, want.collect()), key=str) and len(rows) >= 1000


def test_quote_states():
    assert not _inside_after('a,"b",c', False, ",") and _inside_after('a,"b', False, ",")
    assert not _inside_after('a,5" pipe', False, ",")  # a quote inside a bare field opens nothing
    assert _inside_after('b""c', True, ",") and not _inside_after('b"",c",d', True, ",")
    assert _inside_after("text", True, ",") and _inside_after('","', True, ",")
