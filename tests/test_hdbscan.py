"""Distributed HDBSCAN equals a plain one: spanning tree by Kruskal over all pairs, condensed tree, excess of mass."""

import collections

import numpy as np
from pyspark.sql import functions as F

from roadpulse.operators import hdbscan as H


def plain(spark, ids, x, min_size=15, min_samples=5):
    n, reps = len(x), {}
    for i, p in zip(ids, map(tuple, x)):
        reps[p] = min(reps.get(p, i), i)
    named = spark.createDataFrame([(r,) for r in reps.values()], "rep string").select("rep", F.xxhash64("rep").alias("o"))
    hashed = {r.rep: r.o for r in named.collect()}
    order = np.array([hashed[reps[tuple(p)]] for p in x])
    d = np.sqrt(sum((x[:, None, c] - x[None, :, c]) ** 2 for c in range(x.shape[1])))
    core = np.sort(d, axis=1)[:, min(min_samples, n - 1)]
    w = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    # all pairs by (weight, ends' hashes), copies of a point first
    i, j = np.triu_indices(n, 1)
    least, most = np.minimum(order[i], order[j]), np.maximum(order[i], order[j])
    edges = [(w[i[e], j[e]], i[e], j[e]) for e in np.lexsort((most, least, order[i] != order[j], w[i, j]))]
    up, members, cluster = list(range(n)), [[i] for i in range(n)], [None] * n
    parent, birth, mass, count, home = {}, {}, collections.defaultdict(float), collections.Counter(), {}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    new = 0
    for weight, a, b in edges:
        a, b = find(a), find(b)
        if a == b:
            continue
        lam = 1 / weight if weight > 0 else np.inf
        large = [c for c in (a, b) if cluster[c] is not None]
        own = None
        if len(large) == 2:
            own, new = new, new + 1
            for c in large:
                parent[cluster[c]], birth[cluster[c]] = own, lam
                mass[own] += lam * len(members[c])
                count[own] += len(members[c])
        elif large or len(members[a]) + len(members[b]) >= min_size:
            own = cluster[large[0]] if large else new
            new += not large
            for c in (a, b):
                if cluster[c] is None:
                    for i in members[c]:
                        home[i] = own
                        mass[own] += lam
                        count[own] += 1
        up[b], members[a], cluster[a] = a, members[a] + members[b], own
    kids = collections.defaultdict(list)
    for c, p in parent.items():
        kids[p].append(c)
    chosen = {}

    def value(c):
        below = sum(map(value, kids[c]))
        s = mass[c] - birth[c] * count[c] if c in parent else -1.0
        chosen[c] = c in parent and s >= below
        return max(s, below)

    for c in set(mass) - set(parent):
        value(c)
    label = {}
    for i in range(n):
        c, top = home.get(i), None
        while c is not None:
            top = c if chosen[c] else top
            c = parent.get(c)
        label[ids[i]] = top
    least = {}
    for i, t in label.items():
        if t is not None:
            least[t] = min(least.get(t, i), i)
    return {i: least.get(t, "-1") for i, t in label.items()}


def _points(seed, sizes, extra=0, dims=2):
    rng = np.random.default_rng(seed)
    x = [rng.normal(rng.uniform(-8, 8, dims), rng.uniform(0.05, 1.0), (k, dims)) for k in sizes]
    return np.concatenate([*x, rng.uniform(-10, 10, (extra, dims))])


def _run(spark, x, **options):
    ids = [f"{i:05d}" for i in range(len(x))]
    axes = [f"x{c}" for c in range(x.shape[1])]
    rows = [(i, *map(float, p)) for i, p in zip(ids, x)]
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"{a} double" for a in axes)).repartition(4)
    return ids, {r.id: r.cluster_id for r in H.hdbscan(df, axes, **options).collect()}


def test_equals_plain_on_2000_points(spark):
    x = _points(3, [400, 350, 300, 250, 200, 60, 40, 20, 16], extra=364)
    ids, got = _run(spark, x, tile_rows=64, piece_edges=400)
    want = plain(spark, ids, x)
    assert got == want and len(set(want.values())) > 4


def test_nested_densities_and_copies(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(0, s, (60, 3)) + c for s, c in ((0.01, 0), (0.02, 1), (0.3, 0.5), (2, 0), (0.05, 6), (0.05, 6.6))])
    x = np.concatenate([x, x[:4], x[:4], np.tile(x[70], (3, 1)), np.full((40, 3), 9.0)])  # copies of points, and 40 events at one place
    ids, got = _run(spark, x, tile_rows=50, piece_edges=60)
    assert got == plain(spark, ids, x)


def test_few_events(spark):
    assert _run(spark, np.zeros((1, 2)))[1] == {"00000": "-1"}
    assert set(_run(spark, np.zeros((40, 2)))[1].values()) == {"-1"}  # the root is never selected
    empty = spark.createDataFrame([], "id string, x0 double")
    assert H.hdbscan(empty, ["x0"]).collect() == []


def test_selection_in_a_long_chain(spark):
    """A caterpillar of 40 splits, whose value must run up the whole chain."""
    rows, s = [(0, None, None)], {}
    rng = np.random.default_rng(1)
    for i in range(40):
        for k, c in ((2 * i + 1, False), (2 * i + 2, True)):
            s[k] = float(rng.integers(1, 9)) * (1 if c else 0.3)
            rows.append((k, 2 * i if i else 0, s[k]))
    kids = collections.defaultdict(list)
    for k, p, _ in rows:
        if p is not None:
            kids[p].append(k)
    chosen = {}

    def value(c):
        below = sum(map(value, kids[c]))
        chosen[c] = c != 0 and s[c] >= below
        return max(s.get(c, 0.0), below)

    value(0)
    want, stack = {0: None}, [0]
    while stack:
        c = stack.pop()
        for k in kids[c]:
            want[k] = want[c] if want[c] is not None else (k if chosen[k] else None)
            stack.append(k)
    df = spark.createDataFrame(rows, "sym long, parent long, stability double")
    assert {r.sym: r.label for r in H.select_clusters(df).collect()} == want
