"""Distributed DBSCAN equals a brute-force DBSCAN on the small fixture."""

import collections

import numpy as np
import pytest

from roadpulse.config import EngineConfig
from roadpulse.operators import clusters as K
from roadpulse.operators.graph import components
from roadpulse.registry.common import load_scored
from tests.conftest import SF_SMALL


def _brute(ids, X, eps=0.5, min_samples=5, min_size=15):
    nb = ((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = nb.sum(axis=1) >= min_samples
    comp = -np.ones(len(X), dtype=int)
    c = 0
    for i in range(len(X)):
        if core[i] and comp[i] < 0:
            stack, comp[i] = [i], c
            while stack:
                j = stack.pop()
                for k in np.nonzero(nb[j] & core)[0]:
                    if comp[k] < 0:
                        comp[k] = c
                        stack.append(k)
            c += 1
    name = {}
    for i in range(len(X)):
        if comp[i] >= 0:
            name[comp[i]] = min(name.get(comp[i], ids[i]), ids[i])
    label = {}
    for i in range(len(X)):
        if core[i]:
            label[ids[i]] = name[comp[i]]
        else:
            adj = [name[comp[k]] for k in np.nonzero(nb[i] & core)[0]]
            label[ids[i]] = min(adj) if adj else None
    groups = collections.defaultdict(list)
    for i, lab in label.items():
        if lab is not None:
            groups[lab].append(i)
    out = {i: "-1" for i in ids}
    for mem in groups.values():
        if len(mem) >= min_size:
            for i in mem:
                out[i] = min(mem)
    return out


@pytest.mark.parametrize("min_size", [1, 15])
def test_dbscan_equals_brute_force(spark, min_size):
    s = load_scored(spark, SF_SMALL)
    pts = K.cluster_inputs(s)
    z = K.scale(pts, K.scaler_stats(pts)).toPandas()
    X = z[[f"z_{a}" for a in K._AXES]].to_numpy()
    ref = _brute(z["id"].tolist(), X, min_size=min_size)
    got = {r.id: r.cluster_id for r in K.dbscan(s, EngineConfig(min_cluster_size=min_size)).collect()}
    assert got == ref
    assert len(set(ref.values())) > 2


def test_dense_cell_and_near_misses_equal_brute_force(spark):
    """Half of the events in one cell, and groups whose gaps lie just below and above the radius."""
    rng = np.random.default_rng(11)
    base = [(0.0, 0.0)] * 40 + [tuple(x) for x in rng.normal(0, 0.004, (300, 2))]
    base += [(0.3 + 0.01 * a, 0.02 * b) for a in range(12) for b in range(9)]
    base += [tuple(x) for x in rng.uniform(-0.5, 0.9, (150, 2))]
    rows = [(f"{i:04d}", float(12.9 + a), float(77.5 + b), 8 if i % 4 else 9, "accident" if i % 5 else None) for i, (a, b) in enumerate(base)]
    df = spark.createDataFrame(rows, "id string, latitude double, longitude double, hour int, event_cause string").repartition(4)
    pts = K.cluster_inputs(df)
    z = K.scale(pts, K.scaler_stats(pts)).toPandas()
    ids, x = z["id"].tolist(), z[[f"z_{a}" for a in K._AXES]].to_numpy()
    found = set()
    for eps, near in ((0.12, 5), (0.5, 20)):
        got = {r.id: r.cluster_id for r in K.dbscan(df, EngineConfig(dbscan_eps=eps, dbscan_min_samples=near, min_cluster_size=1)).collect()}
        assert got == _brute(ids, x, eps, near, 1)
        found |= set(got.values())
    assert len(found) > 4


def test_components_of_chains_and_keys(spark):
    edges = [("a", i, i + 1) for i in range(200)] + [("a", 500, 400), ("a", 500, 450), ("b", 7, 9), ("b", 9, 300), ("b", 3, 3)]
    got = components(spark.createDataFrame(edges, "k string, u long, v long").repartition(6), "u", "v", ("k",))
    want = {("a", i): 0 for i in range(201)} | {("a", i): 400 for i in (400, 450, 500)} | {("b", i): 7 for i in (7, 9, 300)}
    assert {(r.k, r.node): r.root for r in got.collect()} == want and got.count() == len(want)
