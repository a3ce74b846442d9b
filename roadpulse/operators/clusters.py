"""Spatial-temporal hotspots (K1–K6): scaling, distributed DBSCAN, cluster statistics.

K2 is exact DBSCAN (eps-ball in the 5-D standardised space, ``min_samples``
counting duplicates) over cells, without a table of point pairs:

1. identical scaled points are merged into one weighted point;
2. hour and cause rank are discrete, so a point's non-spatial part is one of at
   most 24 × (distinct ranks) *slices*; two slices can only hold neighbours when
   their fixed non-spatial distance is below eps — that slice-pair table is
   bounded by the slice domain (proven size) and broadcast;
3. a cell is a slice and a square of side eps/√2, so all its points are neighbours:
   a cell of weight ``min_samples`` holds core points only, whatever its size.
   Cells that can hold neighbours (at most 25 squares per slice pair) are paired by an
   equi-join and kept if their tight boxes come within eps;
4. points of lighter cells (fewer than ``min_samples`` each) sum the weights of the cells that
   lie wholly within eps, and look at single points only of cells that the eps-ball
   cuts, and only while undecided: rows grow with the points, not with their square;
5. two cells are linked when some core point of one is within eps of one of the other.
   Boxes decide most; undecided pairs of cells, if not connected otherwise, are split
   into sub-boxes until one pair is near enough or none can be (a closest pair by
   refinement, down to single points).  Components are found over linked cells;
6. border points join the smallest adjacent cluster; clusters below
   ``min_cluster_size`` events become noise (−1).

Cluster ids are the smallest member event id (stable, no global ranking).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import config as C
from roadpulse.config import DEFAULT, EngineConfig
from roadpulse.operators.features import literal_map
from roadpulse.operators.graph import components
from roadpulse.operators.hdbscan import hdbscan
from roadpulse.session import materialize, spread

NOISE = "-1"
_AXES = ["lat", "lng", "hsin", "hcos", "rank"]


def cluster_inputs(df: DataFrame) -> DataFrame:
    """K1 raw features: latitude, longitude, hour sin/cos, cause rank; nulls and what is no finite place become 0."""
    hour = F.col("hour")
    rank = F.coalesce(F.element_at(literal_map(C.CAUSE_SEVERITY_RANK), F.col("event_cause")), F.lit(C.CAUSE_SEVERITY_DEFAULT))
    return df.select(
        "id",
        F.when(F.abs("latitude") <= 360, F.col("latitude")).otherwise(0.0).alias("lat"),
        F.when(F.abs("longitude") <= 360, F.col("longitude")).otherwise(0.0).alias("lng"),
        F.coalesce(hour, F.lit(0)).alias("hour"),
        F.coalesce(F.sin(F.lit(2 * math.pi) * hour / 24), F.lit(0.0)).alias("hsin"),
        F.coalesce(F.cos(F.lit(2 * math.pi) * hour / 24), F.lit(0.0)).alias("hcos"),
        rank.cast("double").alias("rank"),
    )


def scaler_stats(points: DataFrame) -> DataFrame:
    """K1: population mean and standard deviation per axis (one row)."""
    return points.agg(
        *[F.avg(a).alias(f"m_{a}") for a in _AXES], *[F.stddev_pop(a).alias(f"s_{a}") for a in _AXES]
    )


def scale(points: DataFrame, stats: DataFrame, spatial_weight: float = 1.0) -> DataFrame:
    """Standardise (constant axes stay 0); the spatial weight applies after scaling."""
    j = points.crossJoin(F.broadcast(stats))
    cols = []
    for a in _AXES:
        z = F.when(F.col(f"s_{a}") > 0, (F.col(a) - F.col(f"m_{a}")) / F.col(f"s_{a}")).otherwise(F.lit(0.0))
        if a in ("lat", "lng") and spatial_weight != 1.0:
            z = z * F.lit(spatial_weight)
        cols.append(z.alias(f"z_{a}"))
    return j.select("id", "hour", "rank", *cols)


_SPACE = ("z_lat", "z_lng")
_REST = ("z_hsin", "z_hcos", "z_rank")
_CELL = ["hour", "rank", "fx", "fy"]
_BOX = ["x0", "x1", "y0", "y1"]
_SPLIT = 4  # a box is split into 4 x 4 sub-boxes at a time
_MARGIN = 1e-12  # boxes decide only what rounding cannot change


def _box() -> list:
    lat, lng = _SPACE
    return [F.min(lat).alias("x0"), F.max(lat).alias("x1"), F.min(lng).alias("y0"), F.max(lng).alias("y1")]


def _nearest2(a: str, b: str):
    """Least squared spatial distance between two boxes."""
    gap = lambda lo, hi: F.greatest(F.col(f"{b}{lo}") - F.col(f"{a}{hi}"), F.col(f"{a}{lo}") - F.col(f"{b}{hi}"), F.lit(0.0))
    return gap("x0", "x1") ** 2 + gap("y0", "y1") ** 2


def _farthest2(a: str, b: str):
    """Largest squared spatial distance between two boxes."""
    span = lambda lo, hi: F.greatest(F.col(f"{b}{hi}") - F.col(f"{a}{lo}"), F.col(f"{a}{hi}") - F.col(f"{b}{lo}"))
    return span("x0", "x1") ** 2 + span("y0", "y1") ** 2


def _named(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def _as_box(prefix: str) -> dict:
    """A single point as a box."""
    lat, lng = (F.col(f"{prefix}{c}") for c in _SPACE)
    return {f"{prefix}x0": lat, f"{prefix}x1": lat, f"{prefix}y0": lng, f"{prefix}y1": lng}


def _point_distance2(a: str, b: str):
    return sum((F.col(f"{a}{c}") - F.col(f"{b}{c}")) ** 2 for c in (*_SPACE, *_REST))


def _linked_cells(nodes: DataFrame, pairs: DataFrame, core: DataFrame, eps: float, side: float) -> DataFrame:
    """Rows (node, label): cells with core points, and the smallest node of those they are connected to.

    ``pairs``: candidate cell pairs with the squared distance ``dns2`` of their slices.
    """
    near, far = _nearest2("a_", "b_") + F.col("dns2"), _farthest2("a_", "b_") + F.col("dns2")
    sure, can = far <= eps * eps * (1 - _MARGIN), near <= eps * eps * (1 + _MARGIN)
    cols = ["node", *_CELL, *_BOX]
    met = (
        pairs.join(_named(nodes, "a_", cols), [f"a_{c}" for c in _CELL])
        .join(_named(nodes, "b_", cols), [f"b_{c}" for c in _CELL])
        .where("a_node < b_node").where(can)
        .select("a_node", "b_node", "dns2", sure.alias("sure"))
    )
    met = materialize(met, "dbscan-cell-pairs")
    label = components(met.where("sure"), "a_node", "b_node")
    label = materialize(
        nodes.select("node").join(label, "node", "left").select("node", F.coalesce("root", "node").alias("label")), "dbscan-cell-labels"
    )
    own = lambda p: label.select(F.col("node").alias(f"{p}node"), F.col("label").alias(f"{p}label"))
    open_ = (
        met.where("not sure").join(own("a_"), "a_node").join(own("b_"), "b_node").where("a_label <> b_label")
        .select("a_node", "b_node", "dns2", F.least("a_label", "b_label").alias("la"), F.greatest("a_label", "b_label").alias("lb"),
                *[F.lit(0).cast("bigint").alias(f"{p}{c}") for p in ("a_", "b_") for c in ("sx", "sy")])
    )
    open_ = materialize(open_, "dbscan-open")
    found, depth = [], 0
    while open_.limit(1).count():
        depth += 1
        asked = open_.select(F.explode(F.array("a_node", "b_node")).alias("node")).distinct()
        cut = side / _SPLIT ** depth
        sub = lambda c: F.floor(F.col(c) / F.lit(cut)).cast("bigint")
        up = lambda c: F.floor(F.col(c) / F.lit(cut * _SPLIT)).cast("bigint") if depth > 1 else F.lit(0).cast("bigint")
        boxes = (
            core.join(asked, "node", "left_semi")
            .groupBy("node", up("z_lat").alias("ux"), up("z_lng").alias("uy"), sub("z_lat").alias("sx"), sub("z_lng").alias("sy"))
            .agg(*_box())
        )
        cols = ["node", "ux", "uy", "sx", "sy", *_BOX]
        step = open_.withColumnsRenamed({f"{p}{o}": f"{p}{n}" for p in ("a_", "b_") for o, n in (("sx", "ux"), ("sy", "uy"))})
        for p in ("a_", "b_"):
            step = step.join(_named(boxes, p, cols), [f"{p}{c}" for c in ("node", "ux", "uy")])
        single = F.lit(True)
        for p in ("a_", "b_"):
            for lo, hi in (("x0", "x1"), ("y0", "y1")):
                single = single & (F.col(f"{p}{lo}") == F.col(f"{p}{hi}"))
        link = F.when(single, near <= eps * eps).otherwise(sure)
        step = step.where(can & (link | ~single)).select(
            "a_node", "b_node", "dns2", "la", "lb", *[f"{p}{c}" for p in ("a_", "b_") for c in ("sx", "sy")], link.alias("link")
        )
        step = materialize(step, "dbscan-split")
        new = materialize(step.where("link").select("la", "lb").distinct(), "dbscan-found")
        found.append(new)
        open_ = materialize(step.where("not link").drop("link").join(new, ["la", "lb"], "left_anti"), "dbscan-open")
    if not found:
        return label
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    top = components(links, "la", "lb").withColumnRenamed("node", "label")
    return materialize(label.join(top, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "dbscan-cell-labels")


def dbscan(df: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """K2: ``(id, cluster_id)`` with ``-1`` for noise."""
    eps, min_samples, min_size = cfg.dbscan_eps, cfg.dbscan_min_samples, cfg.min_cluster_size
    side = eps / math.sqrt(2.0)
    pts = cluster_inputs(df)
    z = scale(pts, scaler_stats(pts), cfg.spatial_weight)
    z = materialize(z, "dbscan-scaled")

    # 1. weighted distinct points and their cells
    key = [*_SPACE, "hour", "rank", *_REST]
    wp = z.groupBy(*key).agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("pid"))
    wp = materialize(wp.withColumns({f: F.floor(F.col(c) / side) for f, c in zip(("fx", "fy"), _SPACE)}), "dbscan-points")
    cells = materialize(wp.groupBy(*_CELL).agg(F.sum("w").alias("cw"), *_box()), "dbscan-cells")

    # 2. slice pairs within eps on the non-spatial axes (bounded: hours x ranks squared)
    sl = wp.select("hour", "rank", *_REST).distinct()
    a, b = sl.alias("a"), sl.alias("b")
    dns2 = sum((F.col(f"a.{c}") - F.col(f"b.{c}")) ** 2 for c in _REST)
    slices = a.join(F.broadcast(b), dns2 <= eps * eps).select(
        F.col("a.hour").alias("a_hour"), F.col("a.rank").alias("a_rank"),
        F.col("b.hour").alias("b_hour"), F.col("b.rank").alias("b_rank"), dns2.alias("dns2"),
    )

    # 3. pairs of cells whose boxes come within eps
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-2, 3) for dy in range(-2, 3)])
    near, far = _nearest2("a_", "b_") + F.col("dns2"), _farthest2("a_", "b_") + F.col("dns2")
    pairs = (
        spread(_named(cells, "a_", [*_CELL, "cw", *_BOX])).join(F.broadcast(slices), ["a_hour", "a_rank"])
        .select("*", F.explode(around).alias("o"))
        .withColumns({"b_fx": F.col("a_fx") + F.col("o.dx"), "b_fy": F.col("a_fy") + F.col("o.dy")}).drop("o")
        .join(_named(cells, "b_", [*_CELL, "cw", *_BOX]), [f"b_{c}" for c in _CELL])
        .where(near <= eps * eps * (1 + _MARGIN))
    )
    pairs = materialize(pairs, "dbscan-near-cells")

    # 4. core points of light cells: whole cells by weight, cut cells by their points
    cell_of = ["a_hour", "a_rank", "a_fx", "a_fy"]
    light = (
        _named(wp, "a_", ["pid", *_CELL, *_SPACE, *_REST])
        .join(pairs.where(F.col("a_cw") < min_samples).drop(*[f"a_{c}" for c in _BOX]), cell_of)
        .withColumns(_as_box("a_"))
    )
    inside = far <= eps * eps * (1 - _MARGIN)
    light = light.where(near <= eps * eps * (1 + _MARGIN)).select("*", inside.alias("inside"))
    sums = materialize(
        light.where("inside").groupBy("a_pid").agg(F.sum("b_cw").alias("nw")), "dbscan-light"  # the point's own cell is one of them
    )
    target = _named(wp, "b_", ["pid", "w", *_CELL, *_SPACE, *_REST])
    cut = (
        light.where("not inside").join(sums.where(F.col("nw") < min_samples), "a_pid")
        .join(target, [f"b_{c}" for c in _CELL]).where(_point_distance2("a_", "b_") <= eps * eps)
        .groupBy("a_pid").agg(F.sum("b_w").alias("more"))
    )
    light_core = (
        sums.join(cut, "a_pid", "left").where(F.col("nw") + F.coalesce("more", F.lit(0)) >= min_samples).select(F.col("a_pid").alias("pid"))
    )
    heavy = cells.where(F.col("cw") >= min_samples).select(*_CELL)
    core = wp.join(heavy, _CELL, "left_semi").unionByName(wp.join(light_core, "pid", "left_semi").select(*wp.columns))
    core = materialize(core, "dbscan-core")

    # 5. a cell's core points are one node, named by the smallest of them
    nodes = materialize(core.groupBy(*_CELL).agg(F.min("pid").alias("node"), *_box()), "dbscan-nodes")
    ends = pairs.select(*[f"{p}{c}" for p in ("a_", "b_") for c in _CELL], "dns2")
    label = _linked_cells(nodes, ends, core.join(nodes.select(*_CELL, "node"), _CELL), eps, side)
    labelled = materialize(nodes.join(label, "node").select(*_CELL, *_BOX, "label"), "dbscan-node-labels")

    # 6. border points: the smallest label among core points within eps
    edge = (
        _named(wp, "a_", ["pid", *_CELL, *_SPACE, *_REST])
        .join(core.select(F.col("pid").alias("a_pid")), "a_pid", "left_anti")
        .join(ends, cell_of)
        .join(_named(labelled, "b_", [*_CELL, *_BOX, "label"]), [f"b_{c}" for c in _CELL])
        .withColumns(_as_box("a_")).where(near <= eps * eps * (1 + _MARGIN))
        .groupBy("a_pid", *[f"a_{c}" for c in (*_SPACE, *_REST)])
        .agg(F.min(F.when(inside, F.col("b_label"))).alias("sure"),
             F.collect_list(F.when(~inside, F.struct(*[F.col(f"b_{c}") for c in _CELL], F.col("b_label").alias("label")))).alias("cut"))
    )
    edge = materialize(edge, "dbscan-border")
    seen = (
        edge.select("*", F.explode("cut").alias("o")).where(F.col("sure").isNull() | (F.col("o.label") < F.col("sure"))).select("*", "o.*")
        .join(_named(core, "b_", [*_CELL, *_SPACE, *_REST]), [f"b_{c}" for c in _CELL])
        .where(_point_distance2("a_", "b_") <= eps * eps).groupBy("a_pid").agg(F.min("label").alias("cut_label"))
    )
    border = edge.join(seen, "a_pid", "left").select(F.col("a_pid").alias("pid"), F.least("sure", "cut_label").alias("l"))
    point_label = core.join(labelled, _CELL).select("pid", F.col("label").alias("l")).unionByName(border)
    ev = z.select("id", *key).join(wp.select(*key, "pid"), key, "inner").select("id", "pid")
    lab = ev.join(point_label, "pid", "left")
    sizes = lab.where(F.col("l").isNotNull()).groupBy("l").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("cid"))
    out = lab.join(sizes.where(F.col("size") >= min_size), "l", "left")
    return out.select("id", F.coalesce(F.col("cid"), F.lit(NOISE)).alias("cluster_id"))


def hdbscan_clusters(df: DataFrame, cfg: EngineConfig = DEFAULT, min_cluster_size: int = 15) -> DataFrame:
    """K2, hierarchical: ``(id, cluster_id)`` by HDBSCAN over the same scaled features, ``-1`` for noise."""
    pts = cluster_inputs(df)
    z = scale(pts, scaler_stats(pts), cfg.spatial_weight)
    return hdbscan(z, [f"z_{a}" for a in _AXES], min_cluster_size, cfg.dbscan_min_samples)


def _mode(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(name))


def cluster_stats(df: DataFrame, labels: DataFrame) -> DataFrame:
    """K3: per cluster (noise excluded) size, centre, spreads, dominant cause, mean hour, rates, top corridor."""
    d = df.join(labels, "id", "inner").where(F.col("cluster_id") != NOISE)
    base = d.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("latitude").alias("center_lat"),
        F.avg("longitude").alias("center_lng"),
        F.stddev_samp("latitude").alias("lat_spread"),
        F.stddev_samp("longitude").alias("lng_spread"),
        F.avg("hour").alias("avg_hour"),
        F.avg("priority_binary").alias("high_priority_rate"),
        F.avg("road_closure_binary").alias("closure_rate"),
    )
    return base.join(_mode(d, "cluster_id", "event_cause", "dominant_cause"), "cluster_id", "left").join(
        _mode(d, "cluster_id", "corridor", "top_corridor"), "cluster_id", "left"
    )


def hotspots(stats: DataFrame, n: int = 10) -> DataFrame:
    """K4: top-n clusters by size."""
    return stats.orderBy(F.desc("size"), "cluster_id").limit(n)


def high_risk(stats: DataFrame, threshold: float = 0.7) -> DataFrame:
    """K5: clusters with a High share of at least ``threshold``, highest first."""
    return stats.where(F.col("high_priority_rate") >= threshold).orderBy(F.desc("high_priority_rate"), "cluster_id")


NEAR_AXES = ["lat", "lng", "hsin", "hcos"]  # the rank axis of all centres is the same, so it ranks none of them
FIRST_SIDE = 0.25


def assign_nearest(df: DataFrame, stats: DataFrame, scaler: DataFrame, mid_rank: float = 5.0) -> DataFrame:
    """K6: nearest cluster centre in the scaled space (centres use a mid cause rank), −1 without clusters.

    A grid search with growing cells: a row meets the centres of its own and the
    neighbouring cells in an equi-join.  A centre at most one cell side away is the
    nearest of all; rows without one go on with cells of twice the side, until all are
    settled.  Nothing is collected and the number of centres has no limit.
    Equal distances go to the smallest cluster id.
    """
    cen = stats.select(
        "cluster_id", F.col("center_lat").alias("lat"), F.col("center_lng").alias("lng"),
        F.sin(F.lit(2 * math.pi) * F.col("avg_hour") / 24).alias("hsin"),
        F.cos(F.lit(2 * math.pi) * F.col("avg_hour") / 24).alias("hcos"), F.lit(mid_rank).alias("rank"),
    ).fillna(0.0).withColumn("id", F.col("cluster_id")).withColumn("hour", F.lit(0))
    cen = materialize(scale(cen, scaler).select(F.col("id").alias("cluster_id"), *[F.col(f"z_{a}").alias(f"c_{a}") for a in NEAR_AXES]), "centres")
    open_ = materialize(scale(cluster_inputs(df), scaler).select("id", *[f"z_{a}" for a in NEAR_AXES]), "nearest-open")
    if not cen.limit(1).count():
        return open_.select("id", F.lit(NOISE).alias("cluster_id"))
    settled, side = None, FIRST_SIDE
    while open_.limit(1).count():
        around = cen
        for a in NEAR_AXES:
            here = F.floor(F.col(f"c_{a}") / F.lit(side)).cast("bigint")
            around = around.withColumn(f"g_{a}", F.explode(F.array(here - 1, here, here + 1)))
        cells = open_.withColumns({f"g_{a}": F.floor(F.col(f"z_{a}") / F.lit(side)).cast("bigint") for a in NEAR_AXES})
        d2 = sum((F.col(f"z_{a}") - F.col(f"c_{a}")) ** 2 for a in NEAR_AXES)
        best = (
            cells.join(around, [f"g_{a}" for a in NEAR_AXES]).withColumn("d2", d2).where(F.col("d2") <= side * side)
            .groupBy("id").agg(F.min(F.struct("d2", "cluster_id")).alias("b")).select("id", "b.cluster_id")
        )
        found = materialize(best, "nearest-found")
        settled = found if settled is None else settled.unionByName(found)
        open_ = materialize(open_.join(found, "id", "left_anti"), "nearest-open")
        side *= 2
    return settled if settled is not None else open_.select("id", F.lit(NOISE).alias("cluster_id"))
