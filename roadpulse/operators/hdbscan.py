"""Exact hierarchical density clustering (K2): HDBSCAN with excess-of-mass selection.

No table of point pairs is written, and nothing that grows with the data reaches the driver or one task:

1. Identical points are merged into weighted points, ordered along a space-filling curve and
   cut into *tiles* of at most ``TILE_ROWS`` points, one packed row each.  Tiles near each
   other are found by an equi-join of their boxes on a grid with one level per box size.
2. Core distances (to the ``min_samples``-th other event): a tile looks at itself, then at
   tiles in rings of growing radius, until no box can hold a nearer neighbour.
3. The minimum spanning tree of mutual reachability grows by Boruvka rounds: every component but
   the largest finds its least edge, again in tiles within a growing radius; tiles inside one component are
   skipped, and a pair of tiles yields one edge per component.
   Of a pair of tiles only the points that can still gain from the other tile's box are compared.
4. The tree's edges, in order of (weight, smaller end, larger end), are cut into buckets.
   Halving the range of buckets, the lighter half's components become vertices of the heavier
   half, so each bucket ends as an independent piece for one task.  A piece records which
   points join which cluster and which clusters merge; clusters of lighter buckets are
   referred to by component and resolved by pointer jumping.
5. Stabilities are sums per cluster; the selection is a tree maximum by leaf removal and
   composition of chains, the labels follow by pointer jumping: both in logarithmically many rounds.

Defined results: the label of a cluster is its smallest member id; events outside all
selected clusters get −1; the root is never selected, so events without two clusters among them
are all noise; ends are compared by a hash of their ids, so equal weights merge in an order that
does not depend on partitions; fewer events than
``min_samples`` + 1 use the farthest; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.graph import components
from roadpulse.session import materialize, spread

# Task functions travel by value, so executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOISE = "-1"
TILE_ROWS = 512
PIECE_EDGES = 200_000
BROADCAST_POINTS = 500_000  # points whose tiles are broadcast (64 bytes each on five axes)
TREE_CLUSTERS = 200_000  # clusters whose tree one task selects from
_POS = 10  # bits of a point's number that give its place in its tile
_SYM = 44  # bits of a cluster's number below its bucket


# --- tiles


def _coded(axes: list[str], low: list[float], high: list[float]):
    """Adds the place of each point on a Z-order curve over all axes."""
    bits = 60 // max(len(axes), 1)

    def run(batches):
        for batch in batches:
            code = np.zeros(batch.num_rows, np.int64)
            for a, (axis, lo, hi) in enumerate(zip(axes, low, high)):
                x = batch.column(batch.schema.get_field_index(axis)).to_numpy(zero_copy_only=False)
                q = np.minimum((x - lo) / (hi - lo or 1.0) * (1 << bits), (1 << bits) - 1).astype(np.int64)
                for b in range(bits):
                    code |= ((q >> b) & 1) << (b * len(axes) + a)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])

    return run


def _tiled(axes: list[str], rows: int):
    """Consecutive points as packed tiles."""

    def tile(number: int, part: pa.Table) -> pa.RecordBatch:
        part = part.sort_by("ord")  # so the first of equal weights is the smallest end
        x = np.stack([part[a].to_numpy() for a in axes], axis=1)
        w = part["w"].to_numpy().astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]), pa.array([len(x)]), pa.array([x.min(axis=0).tolist()]), pa.array([x.max(axis=0).tolist()]),
                pa.array([x.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary()), pa.array([part["rep"].to_pylist()], pa.list_(part["rep"].type)),
                pa.array([part["ord"].to_numpy().tobytes()], pa.binary()),
            ],
            names=["tile", "n", "lo", "hi", "x", "w", "reps", "ord"],
        )

    def run(batches):
        number, held = TaskContext.get().partitionId() << 20, None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            held = got if held is None else pa.concat_tables([held, got])
            while held.num_rows >= rows:
                yield tile(number, held.slice(0, rows))
                number, held = number + 1, held.slice(rows)
        if held is not None and held.num_rows:
            yield tile(number, held)

    return run


def build_tiles(points: DataFrame, axes: list[str], rows: int = TILE_ROWS) -> DataFrame:
    """Tiles of distinct points (``axes``, ``w``, ``rep``)."""
    ends = points.agg(*[f(a) for a in axes for f in (F.min, F.max)]).first()
    low, high = list(ends[0::2]), list(ends[1::2])
    kind = points.schema["rep"].dataType.simpleString()
    coded = points.select(*axes, "w", "rep", F.xxhash64("rep").alias("ord")).mapInArrow(
        _coded(axes, low, high), ", ".join(f"{a} double" for a in axes) + f", w long, rep {kind}, ord long, code long"
    )
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.repartitionByRange(n, "code").sortWithinPartitions("code", *axes)
    return materialize(
        dealt.mapInArrow(
            _tiled(axes, rows), f"tile long, n long, lo array<double>, hi array<double>, x binary, w binary, reps array<{kind}>, ord binary"
        ),
        "hdbscan-tiles",
    )


def _box_gap2(width: int):
    gaps = [F.greatest(F.col("b_lo")[i] - F.col("a_hi")[i], F.col("a_lo")[i] - F.col("b_hi")[i], F.lit(0.0)) ** 2 for i in range(width)]
    return sum(gaps)


def _extent(tiles: DataFrame, width: int) -> float:
    """Longest side of all points' box on the axes of the grid."""
    sides = [F.max(F.col("hi")[i]) - F.min(F.col("lo")[i]) for i in range(min(width, 2))]
    return max(tiles.agg(*sides).first())


def near_tiles(active: DataFrame, tiles: DataFrame, least: float, radius: float, width: int, extent: float) -> DataFrame:
    """Rows (i, j, gap): tiles of ``active`` and tiles whose boxes are from ``least`` to below ``radius`` apart.

    Each tile stands on the grid level of its own size (at least that of the radius) in the few
    cells that it touches; a tile looks on its own and all coarser levels, and finer tiles find it.
    """
    side = F.greatest(*[F.col("hi")[i] - F.col("lo")[i] for i in range(min(width, 2))], F.lit(radius))
    level = F.ceil(F.log2(side) - 1e-9).cast("int")
    box = lambda df: df.select("tile", "lo", "hi", level.alias("level"))
    active, tiles = box(active), box(tiles)
    coarsest = math.ceil(math.log2(max(extent, radius))) + 1

    def cells(df: DataFrame, reach: float) -> DataFrame:
        for i in range(min(width, 2)):
            size = F.pow(F.lit(2.0), F.col("on"))
            at = [F.floor((F.col(c)[i] + s * reach) / size).cast("long") for c, s in (("lo", -1), ("hi", 1))]
            df = df.withColumn(f"c{i}", F.explode(F.sequence(*at)))
        return df

    keys = ["on", *[f"c{i}" for i in range(min(width, 2))]]
    upper = F.sequence(F.col("level"), F.greatest(F.col("level"), F.lit(coarsest)))
    # Pairs seen from the finer tile; the coarser one may be the active one.
    ask = lambda df: cells(spread(df).withColumn("on", F.explode(upper)), radius)
    stand = lambda df: cells(df.withColumn("on", F.col("level")), 0.0)
    named = lambda df, p: df.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in ("tile", "lo", "hi")])
    forth = named(ask(active), "a").join(named(stand(tiles), "b"), keys)
    back = named(stand(active), "a").join(named(ask(tiles), "b"), keys)
    gap = F.sqrt(_box_gap2(width))
    pick = lambda df: df.select(F.col("a_tile").alias("i"), F.col("b_tile").alias("j"), gap.alias("gap"))
    return pick(forth).unionByName(pick(back)).where((F.col("gap") >= least) & (F.col("gap") < radius)).distinct()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for c in range(a.shape[1]):
        out += (a[:, c, None] - b[None, :, c]) ** 2
    return np.sqrt(out)


def _matrix(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw).reshape(-1, width)


def _to_box(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Distances of points to the box of others; never above a distance that ``_distances`` finds, as it rounds alike."""
    low, high, out = of.min(axis=0), of.max(axis=0), np.zeros(len(x))
    for c in range(x.shape[1]):
        out += np.maximum(np.maximum(low[c] - x[:, c], x[:, c] - high[c]), 0.0) ** 2
    return np.sqrt(out)


# --- core distances


def _nearest(width: int, k: int):
    """Of a pair of tiles: the distances and weights of the k nearest points of the second, for each point of the first.

    Points whose known core distance the second tile's box cannot lower get an empty list."""

    def run(batches):
        for batch in batches:
            out = []
            for i, j, ax, core, bx, bw in zip(*(batch.column(c).to_pylist() for c in range(6))):
                a, b, weights = _matrix(ax, width), _matrix(bx, width), np.frombuffer(bw, np.int64)
                n, rows = len(a), np.arange(len(a))
                if core is not None:
                    core = np.frombuffer(core)
                    rows = np.flatnonzero(_to_box(a, b) < core)
                    if not len(rows):
                        continue
                    held = _to_box(b, a[rows]) < core[rows].max()
                    b, weights = b[held], weights[held]
                    if not len(b):
                        continue
                d = _distances(a[rows], b)
                near = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
                at = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
                d, w = np.take_along_axis(d, at, 1), weights[at]
                if i == j:  # a point is no neighbour of its own, its copies are
                    w = w - (at == np.arange(len(at))[:, None])
                dist, weight = np.full((n, d.shape[1]), np.inf), np.zeros((n, d.shape[1]), np.int64)
                dist[rows], weight[rows] = d, w
                out.append((i, n, d.shape[1], dist.tobytes(), weight.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=["tile", "n", "k", "d", "w"])

    return run


def _closest(k: int):
    """Merges a tile's lists of nearest distances; k lists of one are enough to know the k-th neighbour."""

    def run(rows: pa.Table) -> pa.Table:
        n = rows["n"][0].as_py()
        d = np.concatenate([np.frombuffer(x).reshape(n, -1) for x in rows["d"].to_pylist()], axis=1)
        w = np.concatenate([np.frombuffer(x, np.int64).reshape(n, -1) for x in rows["w"].to_pylist()], axis=1)
        at = np.argsort(d, axis=1, kind="stable")
        d, w = np.take_along_axis(d, at, 1), np.take_along_axis(w, at, 1)
        upto = np.cumsum(w, axis=1)
        enough = upto >= k
        first = np.where(enough.any(axis=1), enough.argmax(axis=1), d.shape[1] - 1)
        core = np.where(enough.any(axis=1), d[np.arange(n), first], np.inf)
        held = min(k + 1, d.shape[1])
        return pa.table({"tile": rows["tile"][:1], "n": rows["n"][:1], "k": pa.array([held]), "d": pa.array([d[:, :held].tobytes()], pa.binary()),
                         "w": pa.array([w[:, :held].tobytes()], pa.binary()), "core": pa.array([core.tobytes()], pa.binary()), "most": pa.array([float(core.max())])})

    return run


_LISTS = "tile long, n long, k long, d binary, w binary"


def core_distances(tiles: DataFrame, width: int, min_samples: int) -> DataFrame:
    """Rows (tile, core): the packed distances of a tile's points to their ``min_samples``-th other event."""
    total = int(tiles.select("w").mapInArrow(_weigh, "w long").agg(F.sum("w")).first()[0])
    k = min(min_samples, total - 1)
    x = tiles.select("tile", "x", "w")
    small = tiles.agg(F.sum("n")).first()[0] <= BROADCAST_POINTS
    cores = lambda active: active.select(F.col("tile").alias("i"), "core")
    sides = [(x.select(F.col("tile").alias("i"), F.col("x").alias("ax")), "i"), (x.select(F.col("tile").alias("j"), F.col("x").alias("bx"), F.col("w").alias("bw")), "j")]
    listed = lambda pairs, active: meet(
        pairs.select("i", "j"), [(cores(active), "i"), *sides], small
    ).select("i", "j", "ax", "core", "bx", "bw").mapInArrow(_nearest(width, k + 1), _LISTS)
    merge = lambda rows: rows.groupBy("tile").applyInArrow(_closest(k), _LISTS + ", core binary, most double")
    own = tiles.select(F.col("tile").alias("i"), F.col("tile").alias("j"))
    state = materialize(merge(listed(own, tiles.select("tile", F.lit(None).cast("binary").alias("core")))), "hdbscan-core")
    extent = _extent(tiles, width)
    finite = state.where("most < double('inf')").select(F.percentile_approx("most", 0.5)).first()[0]
    least, radius = 0.0, finite or 1.0
    while True:
        active = state.where(F.col("most") > least).select("tile", "most")
        if not active.limit(1).count():
            return state.select("tile", "core")
        box = tiles.select("tile", "lo", "hi")
        pairs = near_tiles(box.join(active.select("tile"), "tile"), box, least, radius, width, extent).where("i <> j")
        pairs = pairs.join(active.withColumnRenamed("tile", "i"), "i").where("gap < most")
        # Lists are merged in two steps, so a tile with very many neighbours is no single group of all their lists.
        more = listed(pairs, state.select("tile", "core")).withColumn("salt", F.pmod(F.xxhash64("d"), F.lit(64)))
        more = more.groupBy("tile", "salt").applyInArrow(_closest(k), _LISTS + ", core binary, most double").select(*state.columns[:5])
        state = materialize(merge(state.select(*state.columns[:5]).unionByName(more)), "hdbscan-core")
        least, radius = radius, radius * 4


def meet(pairs: DataFrame, sides: list[tuple[DataFrame, str]], small: bool) -> DataFrame:
    """Pairs of tiles with what ``sides`` say of either tile, dealt evenly: a pair is a small row and much work.

    Sides of few points go to the pairs, so the wide rows are not shuffled."""
    out = spread(pairs) if small else pairs
    for side, key in sides:
        out = out.join(F.broadcast(side) if small else side, key)
    return out if small else spread(out)


def _weigh(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(x, np.int64).sum()) for x in batch.column(0).to_pylist()], pa.int64())], names=["w"])


# --- spanning tree


_EDGE = ["weight", "first", "last", "lo", "hi"]  # first and last: the ends' hashes, which order equal weights


def _least_edges(width: int, radius: float):
    """Of a pair of tiles: the least edge below ``radius`` of each component that looks for one, from the first tile to another component in the second.

    Points too far from the other tile's box, or from those that look, are left out."""

    def run(batches):
        for batch in batches:
            out = [[np.zeros(0, t)] for t in (np.int64, np.float64, np.int64, np.int64, np.int64, np.int64)]
            for row in zip(*batch.columns):
                i, j = row[0].as_py(), row[1].as_py()
                places, aq, bq = (v.values.to_numpy() for v in row[2:5])
                ax, ac, bx, bc = (np.frombuffer(v.as_buffer()) for v in row[5:9])
                ax, bx = ax.reshape(-1, width), bx.reshape(-1, width)
                p = places[(ac[places] < radius) & (_to_box(ax[places], bx) < radius)]
                if not len(p):
                    continue
                ax, ac, aq = ax[p], ac[p], aq[p]
                q = np.flatnonzero((bc < radius) & (_to_box(bx, ax) < radius))
                bq = bq[q]
                if not len(q) or (aq[0] == bq[0] and (aq == aq[0]).all() and (bq == bq[0]).all()):
                    continue
                w = np.maximum(np.maximum(_distances(ax, bx[q]), ac[:, None]), bc[q][None, :])
                w[aq[:, None] == bq[None, :]] = np.inf
                at = w.argmin(axis=1)
                w = w[np.arange(len(at)), at]
                o1, o2 = (np.frombuffer(v.as_buffer(), np.int64) for v in row[9:11])
                o1, o2 = o1[p], o2[q][at]
                p, q = (i << _POS) + p, (j << _POS) + q[at]
                first, last = np.minimum(o1, o2), np.maximum(o1, o2)
                order = np.lexsort((last, first, w, aq))
                order = order[w[order] < radius]
                best = order[np.r_[True, aq[order][1:] != aq[order][:-1]]] if len(order) else order
                for held, x in zip(out, (aq, w, first, last, np.minimum(p, q), np.maximum(p, q))):
                    held.append(x[best])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["comp", *_EDGE])

    return run


def spanning_tree(tiles: DataFrame, cores: DataFrame, width: int) -> DataFrame:
    """Rows (weight, first, last, lo, hi): the minimum spanning tree of mutual reachability over the distinct points."""
    comp = materialize(
        tiles.select(F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda p: F.shiftleft("tile", _POS) + p)).alias("pid"))
        .withColumn("comp", F.col("pid")), "hdbscan-comps",
    )
    least_core = cores.mapInArrow(_middle, "core double").agg(F.percentile_approx("core", 0.9)).first()[0] or 0.0
    start, tree = (least_core if 0 < least_core < math.inf else 1.0), None
    box, extent, small = tiles.select("tile", "lo", "hi"), _extent(tiles, width), comp.count() <= BROADCAST_POINTS
    while True:
        sizes = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
        n_comps, giant = sizes.agg(F.count(F.lit(1)), F.max_by("comp", F.struct("n", "comp"))).first()
        if n_comps < 2:
            break
        # All components but the largest find their edge, and so all of them merge.
        state = (
            comp.groupBy(F.shiftright("pid", _POS).alias("tile"))
            .agg(F.sort_array(F.collect_list(F.struct("pid", "comp"))).alias("m"))
            .select("tile", F.col("m.comp").alias("comps"), F.array_min("m.comp").alias("c0"), F.array_max("m.comp").alias("c1"))
        )
        state = materialize(tiles.select("tile", "x", "ord").join(cores, "tile").join(state, "tile"), "hdbscan-state")
        best, radius = None, start
        while True:
            open_ = comp.where(F.col("comp") != giant)
            if best is not None:
                open_ = open_.join(best.select("comp"), "comp", "left_anti")
            # Points that look for an edge, by tile.  A wider radius looks at near tiles anew, for the few that are left.
            asks = materialize(
                open_.groupBy(F.shiftright("pid", _POS).alias("i"))
                .agg(F.sort_array(F.collect_list(F.col("pid").bitwiseAND((1 << _POS) - 1))).alias("places")), "hdbscan-asks",
            )
            pairs = near_tiles(box.join(asks.select(F.col("i").alias("tile")), "tile"), box, 0.0, radius, width, extent)
            side = lambda p, t: state.select(F.col("tile").alias(t), *[F.col(c).alias(f"{p}_{c}") for c in ("x", "core", "ord", "comps", "c0", "c1")])
            met = meet(pairs.select("i", "j"), [(asks, "i"), (side("a", "i"), "i"), (side("b", "j"), "j")], small)
            sides = ["places", "a_comps", "b_comps", "a_x", "a_core", "b_x", "b_core", "a_ord", "b_ord"]
            edges = met.where("not (a_c0 = a_c1 and b_c0 = b_c1 and a_c0 = b_c0)").select("i", "j", *sides).mapInArrow(
                _least_edges(width, radius), "comp long, weight double, first long, last long, lo long, hi long"
            )
            # A component is settled when it has an edge shorter than all that was not looked at.
            edges = edges if best is None else edges.unionByName(best)
            best = materialize(edges.groupBy("comp").agg(F.min(F.struct(*_EDGE)).alias("e")).select("comp", "e.*"), "hdbscan-best")
            if best.count() == n_comps - 1:
                break
            radius *= 4
        found = materialize(best.select(*_EDGE).distinct(), "hdbscan-edges")
        start = 2 * found.select(F.percentile_approx("weight", 0.95)).first()[0] or start
        tree = found if tree is None else tree.unionByName(found)
        ends = found.join(comp.select(F.col("pid").alias("lo"), F.col("comp").alias("ca")), "lo").join(
            comp.select(F.col("pid").alias("hi"), F.col("comp").alias("cb")), "hi"
        )
        roots = components(ends, "ca", "cb").withColumnRenamed("node", "comp")
        comp = materialize(comp.join(roots, "comp", "left").select("pid", F.coalesce("root", "comp").alias("comp")), "hdbscan-comps")
    return tree


def _middle(batches):
    for batch in batches:
        for raw in batch.column(batch.schema.get_field_index("core")).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw))], names=["core"])


# --- hierarchy


def _merge_piece(min_size: int):
    """One bucket's edges in order: who joins which cluster, which clusters merge, and each component's cluster afterwards.

    A cluster made here has a positive number; −v−1 is the cluster that component v has from lighter buckets.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("weight", "first", "last")])
        bucket = rows["bucket"][0].as_py()
        up: dict[int, int] = {}
        size: dict[int, int] = {}
        held: dict[int, list] = {}  # a small component's points
        cluster: dict[int, int] = {}  # a large component's cluster
        out, made = [], (bucket + 1) << _SYM

        def find(v):
            while up[v] != v:
                up[v] = up[up[v]]
                v = up[v]
            return v

        columns = ("weight", "u", "v", "u_size", "v_size", "u_points", "v_points")
        for weight, u, v, *more in zip(*(rows[c].to_pylist() for c in columns)):
            for x, n, points in ((u, more[0], more[2]), (v, more[1], more[3])):
                if x not in up:
                    up[x], size[x] = x, n
                    if n >= min_size:
                        cluster[x] = -x - 1
                    else:
                        held[x] = list(points)
            a, b = sorted((find(u), find(v)))
            lam = 1.0 / weight if weight > 0 else math.inf
            total = size[a] + size[b]
            large = [x for x in (a, b) if x in cluster]
            if len(large) == 2:
                for x in large:
                    out.append(("merge", cluster[x], made, lam, size[x]))
                cluster[a], made = made, made + 1
                cluster.pop(b)
            elif total >= min_size:
                if large:
                    own = cluster.pop(large[0])
                else:
                    own, made = made, made + 1
                for x in (a, b):
                    out += [("join", p, own, lam, 0) for p in held.pop(x, ())]
                cluster[a] = own
            else:
                held[a] = held.pop(a) + held.pop(b)
            up[b], size[a] = a, total
        out += [("top", v, own, 0.0, 0) for v, own in cluster.items()]
        kind, a, b, lam, n = zip(*out) if out else ((),) * 5
        return pa.table({"bucket": pa.array([bucket] * len(out), pa.int64()), "kind": pa.array(kind, pa.string()), "a": pa.array(a, pa.int64()),
                         "b": pa.array(b, pa.int64()), "lam": pa.array(lam, pa.float64()), "n": pa.array(n, pa.int64())})

    return run


def _pieces(tree: DataFrame, sizes: DataFrame, n_buckets: int, min_size: int) -> DataFrame:
    """The tree's edges by bucket, their ends being components of all lighter buckets, with sizes and a small one's points."""
    if n_buckets > 1:
        number = lambda batches: (
            pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, TaskContext.get().partitionId(), np.int64))], names=[*b.schema.names, "bucket"])
            for b in batches
        )
        tree = tree.repartitionByRange(n_buckets, "weight", "first", "last").mapInArrow(
            number, "weight double, first long, last long, lo long, hi long, bucket long"
        )
    else:
        tree = tree.withColumn("bucket", F.lit(0).cast("long"))
    edges = materialize(tree.select("weight", "first", "last", "bucket", F.col("lo").alias("u"), F.col("hi").alias("v"), F.lit(0).cast("long").alias("g")), "hdbscan-pieces")
    points = F.when(F.col("size") < min_size, F.array("pid"))
    nodes = materialize(sizes.select(F.lit(0).cast("long").alias("g"), F.col("pid").alias("v"), "size", points.alias("points")), "hdbscan-nodes")
    span = 1 << (n_buckets - 1).bit_length()
    while span > 1:  # group g holds buckets [g, g + span)
        half = span // 2
        light = F.col("bucket") < F.col("g") + half
        roots = materialize(components(edges.where(light), "u", "v", ("g",)), "hdbscan-roots")
        asked = edges.where(~light).select("g", F.explode(F.array("u", "v")).alias("v")).distinct()
        root = lambda c: roots.select("g", F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        heavy = edges.where(~light).join(root("u"), ["g", "u"], "left").join(root("v"), ["g", "v"], "left").select(
            "weight", "first", "last", "bucket", F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v"), (F.col("g") + half).alias("g")
        )
        placed = nodes.join(root("v"), ["g", "v"], "left").withColumn("r", F.coalesce("v_root", "v"))
        wanted = asked.join(root("v"), ["g", "v"], "left").select("g", F.coalesce("v_root", "v").alias("r")).distinct()
        total = placed.join(wanted, ["g", "r"], "left_semi").groupBy("g", "r").agg(F.sum("size").alias("total"))
        # Only components below the cluster size gather their points.
        small = placed.join(total.where(F.col("total") < min_size), ["g", "r"]).groupBy("g", "r").agg(F.flatten(F.collect_list("points")).alias("points"))
        merged = total.join(small, ["g", "r"], "left").select((F.col("g") + half).alias("g"), F.col("r").alias("v"), F.col("total").alias("size"), "points")
        nodes = materialize(nodes.unionByName(merged), "hdbscan-nodes")
        edges = materialize(edges.where(light).select(*heavy.columns).unionByName(heavy), "hdbscan-pieces")
        span = half
    own = lambda c: nodes.select("g", F.col("v").alias(c), F.col("size").alias(f"{c}_size"), F.col("points").alias(f"{c}_points"))
    return edges.join(own("u"), ["g", "u"]).join(own("v"), ["g", "v"])


def _resolve(refs: DataFrame, tops: DataFrame, col: str) -> DataFrame:
    """Replaces references (negative numbers) in ``col``, seen from bucket ``ref``, by the component's cluster of the
    last lighter bucket that has one, which may refer on from there."""
    known = tops.select(F.col("v").alias("label"), F.col("bucket").alias("at"), F.col("sym").alias("found"), F.col("ref").alias("found_ref"), F.lit(1).alias("o"))
    nothing = F.lit(None).cast("long")
    asked = refs.where(F.col(col) < 0).select((-F.col(col) - 1).alias("label"), F.col("ref").alias("at")).distinct()
    rows = known.unionByName(asked.select("label", "at", nothing.alias("found"), nothing.alias("found_ref"), F.lit(0).alias("o")))
    before = Window.partitionBy("label").orderBy("at", "o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.last(c, ignorenulls=True).over(before).alias(c) for c in ("found", "found_ref")]
    answer = rows.select("label", "at", "o", *last).where("o = 0").select((-F.col("label") - 1).alias(col), F.col("at").alias("ref"), "found", "found_ref")
    out = refs.join(answer, [col, "ref"], "left")
    return out.withColumns({col: F.coalesce("found", col), "ref": F.coalesce("found_ref", "ref")}).select(*refs.columns)


def condensed_tree(tree: DataFrame, sizes: DataFrame, cores: DataFrame, min_size: int, piece_edges: int = PIECE_EDGES):
    """(joins, merges): points (pid, sym, lam) in the cluster they join, and clusters (sym, parent, lam, n) in the one they merge into."""
    n_buckets = max(1, math.ceil(tree.count() / piece_edges))
    pieces = _pieces(tree, sizes, n_buckets, min_size)
    events = materialize(
        pieces.groupBy("bucket").applyInArrow(_merge_piece(min_size), "bucket long, kind string, a long, b long, lam double, n long"), "hdbscan-events"
    )
    # A place with enough events is a cluster from its own core distance on.
    alone = sizes.where(F.col("size") >= min_size).join(cores, "pid")
    lam = F.when(F.col("core") > 0, 1 / F.col("core")).otherwise(F.lit(math.inf))
    ref = F.col("bucket").alias("ref")
    tops = events.where("kind = 'top'").select(F.col("a").alias("v"), "bucket", F.col("b").alias("sym"), ref).unionByName(
        alone.select(F.col("pid").alias("v"), F.lit(-1).cast("long").alias("bucket"), F.col("pid").alias("sym"), F.lit(-1).cast("long").alias("ref"))
    )
    while True:
        tops = materialize(tops, "hdbscan-tops")
        if not tops.where("sym < 0").limit(1).count():
            break
        tops = _resolve(tops, tops, "sym")
    joins = _resolve(events.where("kind = 'join'").select(ref, F.col("a").alias("pid"), F.col("b").alias("sym"), "lam"), tops, "sym")
    joins = joins.select("pid", "sym", "lam").unionByName(alone.select("pid", F.col("pid").alias("sym"), lam.alias("lam")))
    merges = _resolve(events.where("kind = 'merge'").select(ref, F.col("a").alias("sym"), F.col("b").alias("parent"), "lam", "n"), tops, "sym")
    return materialize(joins, "hdbscan-joins"), materialize(merges.select("sym", "parent", "lam", "n"), "hdbscan-merges")


def stabilities(joins: DataFrame, merges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (sym, parent, stability); the root has neither a parent nor a stability."""
    mass = joins.join(sizes, "pid").select("sym", (F.col("lam") * F.col("size")).alias("mass"), F.col("size").alias("n")).unionByName(
        merges.select(F.col("parent").alias("sym"), (F.col("lam") * F.col("n")).alias("mass"), "n")
    )
    total = mass.groupBy("sym").agg(F.sum("mass").alias("mass"), F.sum("n").alias("n"))
    return total.join(merges.select("sym", "parent", "lam"), "sym", "left").select(
        "sym", "parent", F.when(F.col("parent").isNotNull(), F.col("mass") - F.col("n") * F.col("lam")).alias("stability")
    )


def _selected(batches):
    """The selection over a whole tree: values from the leaves up, labels from the roots down."""
    syms, parents, own = [], [], []
    for batch in batches:
        for held, c in zip((syms, parents, own), ("sym", "parent", "s")):
            held += batch.column(c).to_pylist()
    parent, s = dict(zip(syms, parents)), dict(zip(syms, own))
    kids: dict = {}
    for x, up in parent.items():
        kids.setdefault(up, []).append(x)
    order = list(kids.get(None, ()))
    for x in order:  # grows: every cluster comes after its parent
        order += kids.get(x, ())
    value, label = {}, {None: None}
    for x in reversed(order):
        below = kids.get(x)
        value[x] = max(s[x], sum(value[y] for y in below)) if below else s[x]
    for x in order:
        above = label[parent[x]]
        label[x] = above if above is not None else x if parent[x] is not None and value[x] <= s[x] else None
    yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array([label[x] for x in order], pa.int64())], names=["sym", "label"])


def select_clusters(clusters: DataFrame, most: int = TREE_CLUSTERS) -> DataFrame:
    """Rows (sym, label): for each cluster the selected one that holds it (null: none), by greatest total stability.

    ``clusters``: sym, parent, stability; up to ``most`` of them one task selects.  The value of a cluster is max(its stability, its
    children's values).  Leaves are known; a cluster with one unknown child is max(p, q + child),
    and such functions compose, so chains shorten by half a round.
    """
    base = materialize(clusters.select("sym", "parent", F.coalesce("stability", F.lit(0.0)).alias("s")), "hdbscan-clusters")
    if base.count() <= most:
        return base.coalesce(1).mapInArrow(_selected, "sym long, label long")
    kids = base.where("parent is not null").groupBy(F.col("parent").alias("sym")).agg(F.count(F.lit(1)).alias("pending"))
    rest = base.join(kids, "sym", "left").select("sym", "s", F.coalesce("pending", F.lit(0)).alias("pending"), F.lit(0.0).alias("acc"))
    new = materialize(rest.where("pending = 0").select("sym", F.col("s").alias("f")), "hdbscan-known")
    open_, chain, known = rest.where("pending > 0"), None, new
    parents = base.select("sym", "parent")
    while True:
        given = new.join(parents, "sym").where("parent is not null").groupBy(F.col("parent").alias("sym")).agg(F.sum("f").alias("add"), F.count(F.lit(1)).alias("less"))
        open_ = materialize(
            open_.join(given, "sym", "left").select(
                "sym", "s", (F.col("pending") - F.coalesce("less", F.lit(0))).alias("pending"), (F.col("acc") + F.coalesce("add", F.lit(0.0))).alias("acc")
            ), "hdbscan-open",
        )
        left = parents.join(known.select("sym"), "sym", "left_anti").select(F.col("sym").alias("down"), F.col("parent").alias("sym"))
        single = open_.where("pending = 1").join(left, "sym").select("sym", F.col("s").alias("p"), F.col("acc").alias("q"), "down")
        chain = materialize(single if chain is None else chain.unionByName(single), "hdbscan-chain")
        ready = open_.where("pending = 0").select("sym", F.greatest("s", "acc").alias("f"))
        open_ = open_.where("pending > 1")
        reached = chain.join(known.select(F.col("sym").alias("down"), F.col("f").alias("df")), "down").select(
            "sym", F.greatest(F.col("p"), F.col("q") + F.col("df")).alias("f")
        )
        new = materialize(ready.unionByName(reached), "hdbscan-new")
        far = chain.select(F.col("sym").alias("down"), F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("down").alias("down2"))
        chain = chain.join(new.select("sym"), "sym", "left_anti").join(far, "down", "left").select(
            "sym", F.coalesce(F.greatest(F.col("p"), F.col("q") + F.col("p2")), "p").alias("p"),
            F.coalesce(F.col("q") + F.col("q2"), "q").alias("q"), F.coalesce("down2", "down").alias("down"),
        )
        known = materialize(known.unionByName(new), "hdbscan-known")
        if known.count() == base.count():
            break
    chosen = F.when(F.col("parent").isNotNull() & (F.col("f") <= F.col("s")), F.col("sym")).alias("label")
    top = materialize(base.join(known, "sym").select("sym", F.col("parent").alias("up"), chosen), "hdbscan-top")
    while top.where("up is not null").limit(1).count():  # the highest chosen cluster on the way to the root
        above = top.select(F.col("sym").alias("up"), F.col("up").alias("up2"), F.col("label").alias("label2"))
        top = materialize(top.join(above, "up", "left").select("sym", F.col("up2").alias("up"), F.coalesce("label2", "label").alias("label")), "hdbscan-top")
    return top.select("sym", "label")


def _unpacked(batches):
    """A tile's points: number, representative, weight and core distance."""
    for batch in batches:
        for tile, reps, w, core in zip(*(c for c in batch.columns)):
            n = len(reps)
            pid = (tile.as_py() << _POS) + np.arange(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pid), reps.values, pa.array(np.frombuffer(w.as_py(), np.int64)), pa.array(np.frombuffer(core.as_py()))],
                names=["pid", "rep", "size", "core"],
            )


def hdbscan(points: DataFrame, axes: list[str], min_cluster_size: int = 15, min_samples: int = 5, id_col: str = "id",
            tile_rows: int = TILE_ROWS, piece_edges: int = PIECE_EDGES) -> DataFrame:
    """``(id, cluster_id)`` of points given by finite ``axes``, with −1 for noise."""
    if not 0 < tile_rows <= 1 << _POS:
        raise ValueError(f"tiles hold 1 to {1 << _POS} points")
    points = materialize(points.select(F.col(id_col).alias("id"), *[F.col(a).cast("double").alias(a) for a in axes]), "hdbscan-points")
    distinct = points.groupBy(*axes).agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("rep"))
    noise = points.select("id", F.lit(NOISE).alias("cluster_id"))
    if points.limit(2).count() < 2:
        return noise
    tiles = build_tiles(distinct, axes, tile_rows)
    cores = materialize(core_distances(tiles, len(axes), min_samples), "hdbscan-cores")
    kind = tiles.schema["reps"].dataType.elementType.simpleString()
    place = materialize(
        tiles.join(cores, "tile").select("tile", "reps", "w", "core").mapInArrow(_unpacked, f"pid long, rep {kind}, size long, core double"), "hdbscan-places"
    )
    sizes = place.select("pid", "size")
    tree = spanning_tree(tiles, cores, len(axes))
    if tree is None:  # one place only
        return noise
    joins, merges = condensed_tree(tree, sizes, place.select("pid", "core"), min_cluster_size, piece_edges)
    label = select_clusters(stabilities(joins, merges, sizes))
    of = joins.join(label, "sym").where("label is not null").join(place.select("pid", "rep"), "pid").select("rep", "label")
    # Events at one place share its representative, the smallest id there.
    reps = points.join(distinct.select(*axes, "rep"), axes).select("id", "rep")
    named = of.groupBy("label").agg(F.min("rep").alias("cluster_id"))
    return reps.join(of.join(named, "label").select("rep", "cluster_id"), "rep", "left").select("id", F.coalesce("cluster_id", F.lit(NOISE)).alias("cluster_id"))
