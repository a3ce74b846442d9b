"""Quoted CSV read by several tasks a file (S1), embedded line ends included.

Spark's ``multiLine`` reader takes a file as one task, since a task that starts in the middle cannot
tell whether it is inside a quoted field.  Here the file is scanned as lines, split as usual:

1. for each split, a task notes whether it ends inside a quoted field, for both cases at its start;
2. these pairs (one row a split) are composed in file order, which gives every split its true start;
3. splits then cut their lines into records; only the pieces of records that cross a split are
   shuffled, joined in order, and every record is parsed by Spark's own CSV expression.

A quote opens a field only at its start, and a doubled quote inside stands for itself.  Line ends
inside a field are read as ``\\n``, as the ``multiLine`` reader does; empty lines between records
are skipped; a file that ends inside a quoted field yields the rest of it as its last record.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Task functions travel by value, so executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WHOLE, _FIRST, _MIDDLE, _LAST = 0, 1, 2, 3
BATCH_RECORDS = 10_000


def _inside_after(line: str, inside: bool, sep: str) -> bool:
    """Whether the line ends inside a quoted field."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside or line.startswith('"', at):
            at += not inside
            while True:  # to the closing quote
                at = line.find('"', at) + 1
                if not at:
                    return True
                if not line.startswith('"', at):
                    break
                at += 1
            inside = False
        at = line.find(sep, at) + 1
        if not at:
            return False


def _ends(sep: str):
    """Per split: is its end inside a field, when its start is outside, and when it is inside."""

    def run(batches):
        ends: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for line, *split in zip(*(c.to_pylist() for c in batch.columns)):
                own = ends.setdefault(tuple(split), [False, True])
                if '"' in line:
                    own[:] = [_inside_after(line, x, sep) for x in own]
        files, starts = zip(*ends) if ends else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(starts, pa.int64()), *(pa.array([e[i] for e in ends.values()], pa.bool_()) for i in (0, 1))],
            names=["file", "start", "from_out", "from_in"],
        )

    return run


def _records(inside_at: set[tuple[str, int]], sep: str, header: bool):
    """Whole records, and the pieces of those that cross a split."""

    def run(batches):
        out: list[tuple] = []
        split, kind, held, inside = None, _WHOLE, [], False

        def piece(how: int, lines: list[str]) -> None:
            out.append((*split, how, "\n".join(lines)))

        def flush():
            rows, out[:] = list(zip(*out)) or [[]] * 4, []
            return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                                              names=["file", "start", "kind", "text"])

        for batch in batches:
            for line, *where in zip(*(c.to_pylist() for c in batch.columns)):
                if tuple(where) != split:
                    if held:
                        piece(_MIDDLE if kind == _LAST else _FIRST, held)
                    split, held = tuple(where), []
                    inside = split in inside_at
                    kind = _LAST if inside else _WHOLE
                    skip = header and split[1] == 0
                if not held and not inside and not line:
                    continue
                held.append(line)
                inside = _inside_after(line, inside, sep)
                if not inside:
                    if skip:
                        skip = False
                    else:
                        piece(kind, held)
                    held, kind = [], _WHOLE
            if len(out) >= BATCH_RECORDS:
                yield flush()
        if held:
            piece(_MIDDLE if kind == _LAST else _FIRST, held)
        yield flush()

    return run


def csv_records(spark: SparkSession, path, sep: str = ",", header: bool = True) -> DataFrame:
    """One row (``text``) per record of the quoted CSV files at ``path``."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    ends = lines.mapInArrow(_ends(sep), "file string, start long, from_out boolean, from_in boolean")
    inside, file, at = set(), None, False
    for r in ends.orderBy("file", "start").toLocalIterator():  # one row a split
        at = at and r["file"] == file
        file = r["file"]
        if at:
            inside.add((file, r["start"]))
        at = r["from_in"] if at else r["from_out"]
    cut = lines.mapInArrow(_records(inside, sep, header), "file string, start long, kind int, text string")
    whole = cut.where(F.col("kind") == _WHOLE).select("text")
    if not inside:
        return cut.where(F.col("kind").isin(_WHOLE, _FIRST)).select("text")
    # In a split, the end of an earlier record comes before the beginning of a later one.
    order = Window.partitionBy("file").orderBy("start", F.when(F.col("kind") == _FIRST, 1).otherwise(0))
    parts = cut.where(F.col("kind") != _WHOLE).withColumn("record", F.sum((F.col("kind") == _FIRST).cast("int")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("start", "text")))
    joined = parts.groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(joined.select("text"))


def read_csv_split(spark: SparkSession, path, schema: T.StructType, options: dict[str, str], sep: str = ",", header: bool = True) -> DataFrame:
    """The columns of ``schema`` parsed from the records of quoted CSV files, each file read by as many tasks as it has splits."""
    parsed = F.from_csv("text", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), {**options, "sep": sep, "escape": '"', "multiLine": "true"})
    return csv_records(spark, path, sep, header).select(parsed.alias("r")).select("r.*")
