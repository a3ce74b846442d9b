"""Pairs of tiles compare only points that can gain, and the forms for few points give the same as those for many."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadpulse.operators import graph as G
from roadpulse.operators import hdbscan as H
from tests.test_hdbscan import _points, _run, plain


def _compared(monkeypatch):
    sizes, whole = [], H._distances
    monkeypatch.setattr(H, "_distances", lambda a, b: sizes.append((len(a), len(b))) or whole(a, b))
    return sizes


def _lists(rows, kinds):
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=[f"c{c}" for c in range(len(kinds))])


def test_edges_of_a_pair_compare_points_near_the_other_box(monkeypatch):
    sizes = _compared(monkeypatch)
    a, b = np.stack([np.arange(100.0), np.zeros(100)], axis=1), np.stack([np.arange(102.5, 202.5), np.zeros(100)], axis=1)
    core, order = np.ones(100), np.arange(100)
    row = (0, 1, list(range(100)), list(range(100)), list(range(200, 300)), a.tobytes(), core.tobytes(), b.tobytes(), core.tobytes(), order.tobytes(), order.tobytes())
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, *[pa.binary()] * 6]
    got = list(H._least_edges(2, 5.0)(iter([_lists([row], kinds)])))[0].to_pydict()
    assert sizes == [(2, 2)]  # of 100 and 100 points
    assert got["comp"] == [98, 99] and got["weight"] == [4.5, 3.5] and got["hi"] == [1 << 10] * 2


def test_core_distances_of_a_pair_compare_points_near_the_other_box(monkeypatch):
    sizes = _compared(monkeypatch)
    a, b = np.stack([np.arange(50.0), np.zeros(50)], axis=1), np.stack([np.arange(51.0, 101.0), np.zeros(50)], axis=1)
    weights, core = np.ones(50, np.int64), np.full(50, 3.0)
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
    rows = [(0, 1, a.tobytes(), core.tobytes(), b.tobytes(), weights.tobytes()), (0, 2, a.tobytes(), core.tobytes(), (b + 99).tobytes(), weights.tobytes())]
    got = list(H._nearest(2, 4)(iter([_lists(rows, kinds)])))[0].to_pydict()
    assert sizes == [(1, 1)] and got["n"] == [50]  # the last point and the first; the far tile is not compared
    d = np.frombuffer(got["d"][0]).reshape(50, -1)
    assert d[49, 0] == 2.0 and np.isinf(d[:49]).all()


def test_forms_for_many_points_equal_plain(spark, monkeypatch):
    x = _points(11, [150, 120, 60, 20], extra=120)
    for module, name in ((H, "BROADCAST_POINTS"), (H, "TREE_CLUSTERS"), (G, "LOCAL_EDGES")):
        monkeypatch.setattr(module, name, 1)
    monkeypatch.setattr(H.select_clusters, "__defaults__", (1,))
    ids, got = _run(spark, x, tile_rows=64, piece_edges=150)
    assert got == plain(spark, ids, x)


def test_selection_in_one_task_equals_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(0, None, None)] + [(i, int(rng.integers(0, i)), float(rng.integers(1, 9))) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "sym long, parent long, stability double")
    one, many = ({r.sym: r.label for r in H.select_clusters(df, most).collect()} for most in (1000, 0))
    assert one == many and len(one) == 300 and len(set(one.values())) > 10


def test_few_edges_are_joined_in_one_task(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") * 7 % 401).alias("a"), (F.col("id") * 7 % 401 + F.col("id") % 3).alias("b")).repartition(8)
    few = {tuple(r) for r in G.components(df, "a", "b").collect()}
    monkeypatch.setattr(G, "LOCAL_EDGES", 1)
    assert few == {tuple(r) for r in G.components(df, "a", "b").collect()} and len(few) > 100
