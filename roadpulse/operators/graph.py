"""Connected components of an edge table."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import materialize


# Task functions travel by value, so executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOCAL_EDGES = 500_000  # edges whose components a task finds at a time


def _stars(batches):
    """A part's edges (keys, hi, lo) replaced by one edge from each node to the smallest node of its component."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def out(schema):
        found = [(*x[:-1], x[-1], r[-1]) for x, r in ((x, find(x)) for x in list(root)) if x != r]
        root.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(schema)], schema=schema)

    held, schema = 0, None
    for batch in batches:
        schema, (*ks, hi, lo) = batch.schema, [c.to_pylist() for c in batch.columns]
        for *key, a, b in zip(*ks, hi, lo):
            a, b = (*key, a), (*key, b)
            root.setdefault(a, a)
            root.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        held += batch.num_rows
        if held >= LOCAL_EDGES:
            yield out(schema)
            held = 0
    if schema is not None:
        yield out(schema)


def components(edges: DataFrame, a: str, b: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Smallest member of each connected component, per value of ``keys``: rows (*keys, node, root).

    Alternating large-star and small-star rounds until the edges stay the same: every round
    is a grouped minimum and an equi-join, written to the shared folder, so that
    lineage stays short and no component is gathered anywhere.  Each task first replaces
    the edges it holds by stars of its own components, a bounded number at a time, which
    leaves fewer edges and rounds.  Nodes without an edge to another node are left out;
    nulls are no nodes.  At most ``LOCAL_EDGES`` edges that are left are the work of one task.
    """
    ks = list(keys)
    cur = edges.select(*ks, F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo")
    schema = cur.schema
    cur = materialize(cur.mapInArrow(_stars, schema).distinct(), "components")
    members = lambda: cur.select(*ks, F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        cur.select(*ks, F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
    if cur.count() <= LOCAL_EDGES:
        cur = materialize(cur.coalesce(1).mapInArrow(_stars, schema), "components")
        return members()
    while True:
        # Done when the edges are stars: every node has one smaller neighbour or only larger ones.
        ends = F.explode(F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("up")), F.struct(F.col("lo").alias("node"), F.lit(0).alias("up"))))
        tangled = cur.select(*ks, ends.alias("e")).groupBy(*ks, "e.node").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("low"))
        if not tangled.where("ups > 1 or ups = 1 and low = 0").limit(1).count():
            return members()
        low = cur.groupBy(*ks, F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        # Large star: a node's larger neighbours point at its smallest neighbour.
        large = (
            cur.join(low.withColumnRenamed("u", "lo"), [*ks, "lo"], "left")
            .select(*ks, "hi", F.coalesce("m", "lo").alias("lo")).distinct()
        )
        # Small star: a node's smaller neighbours, and the node itself, point at the smallest of them.
        low = large.groupBy(*ks, "hi").agg(F.min("lo").alias("m"))
        pairs = F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct("hi", F.col("m").alias("lo")))
        both = large.join(low, [*ks, "hi"]).select(*ks, F.explode(pairs).alias("e"))
        cur = materialize(both.select(*ks, "e.hi", "e.lo").where("hi <> lo").distinct().mapInArrow(_stars, schema), "components")
