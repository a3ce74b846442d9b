"""Hard-negative mining by a BOND vertical scan over columnar blocks of vectors.

Vectors are packed into blocks: one array per dimension, with its smallest and largest value,
rows ordered by label and id.  For each anchor a block's dimensions are read in descending
magnitude of the anchor's components.  After each group of dimensions the partial scores and
the smallest and largest contribution that the remaining dimensions can make bound every
row's score, and rows that can no longer count leave the candidate bitmap, until the
scores of the rest are exact.

Two scans are made.  The first finds each anchor's ``k`` best rows of its own label; a row goes
when its upper bound is below the k-th best lower bound known.  The second looks for rows of
other labels in the score windows that the positives span; a row goes when its bounds miss
every window or fall below the windows' n-th best lower bound.  Bounds only discard rows that
cannot be in the result, equal scores stay, so the result is that of the full product.

Anchors are a stated query set: they come in blocks of at most about ``ANCHOR_BLOCK``, each of
which travels with its tasks and meets all blocks of vectors.  A task emits per anchor at
most the rows asked for; Spark ranks what tasks found.

Scores are sums of integer products, exact in float64 below 2^53 and in 64-bit integers above;
vectors whose scores could leave 64 bits raise an error.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take
no part; a shorter vector counts as filled up with zeros; rows that repeat an id are separate
rows (none of them is "another row" for an anchor of that id), and an anchor row that repeats
as a whole is mined once; an anchor without another row of its label, and a positive without
a row in its window, give no rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize, prepare, table

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # the window in hundredths of the positive's score
BLOCK_ROWS = 4096
ANCHOR_BLOCK = 4096
GROUPS = 8  # groups of dimensions between two looks at the bounds
LEAST = np.int64(-(2**63))

_PACKED = "n int, width int, low long, high long, ids binary, labels binary, columns binary"


def _pack(batches):
    """Blocks of at most BLOCK_ROWS vectors: ids, labels, and one column of numbers per dimension."""

    def block(rows: list) -> pa.RecordBatch:
        ids, labels, sizes, flat = (np.concatenate(x) for x in zip(*rows))
        width = int(sizes.max(initial=0))
        cols = np.zeros((width, len(ids)), np.int64)
        row = np.repeat(np.arange(len(ids)), sizes)
        cols[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), row] = flat
        order = np.lexsort((ids, labels))
        low, high = int(cols.min(initial=0)), int(cols.max(initial=0))
        kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
        held = (ids[order].tobytes(), labels[order].tobytes(), cols[:, order].astype(kind).tobytes())
        values = [len(ids), width, low, high, *held]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _PACKED.split(", ")])

    rows, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, min(BLOCK_ROWS, batch.num_rows - at))
            if held + part.num_rows > BLOCK_ROWS:
                yield block(rows)
                rows, held = [], 0
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            rows.append((ids, labels, part.column(2).value_lengths().to_numpy(zero_copy_only=False),
                         part.column(2).flatten().to_numpy(zero_copy_only=False)))
            held += part.num_rows
    if held:
        yield block(rows)


class _Anchors:
    """A block of anchors: ids, labels, vectors, and the order in which each reads the dimensions."""

    def __init__(self, rows: list[tuple[int, int, list[int]]], width: int, exact: bool):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        self.kind = np.float64 if exact else np.int64
        self.vectors = np.zeros((len(rows), width), self.kind)
        for v, r in zip(self.vectors, rows):
            v[: len(r[2])] = r[2]
        self.order = np.argsort(-np.abs(self.vectors), axis=1, kind="stable")
        self.cuts = sorted({round(width * (i + 1) / GROUPS) for i in range(GROUPS)} - {0})

    def blocks(self, batches):
        """Of each packed block: ids, labels, columns, and what the dimensions after each cut can add at least and at most."""
        width = self.vectors.shape[1]
        ordered = np.take_along_axis(self.vectors, self.order, 1)
        for batch in batches:
            for n, own, low, high, ids, labels, columns in zip(*(c.to_pylist() for c in batch.columns)):
                cols = np.zeros((width, n), self.kind)
                kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(columns) // max(own * n, 1)] if own else np.int16
                cols[:own] = np.frombuffer(columns, kind).reshape(own, n)
                ends = np.stack([cols.min(axis=1), cols.max(axis=1)])[:, self.order] * ordered
                rest = [np.cumsum(x[:, ::-1], axis=1)[:, ::-1] for x in (ends.min(axis=0), ends.max(axis=0))]
                after = [np.c_[x, np.zeros(len(x), x.dtype)][:, self.cuts] for x in rest]
                yield np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), cols, after[0], after[1]

    def scan(self, a: int, cols: np.ndarray, alive: np.ndarray, least: np.ndarray, most: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap ``alive`` that ``keep`` never dropped by their bounds, and their exact scores."""
        where, done = np.flatnonzero(alive), 0
        score = np.zeros(len(where), self.kind)
        for i, cut in enumerate(self.cuts):
            dims = self.order[a, done:cut]
            score += self.vectors[a, dims] @ cols[dims[:, None], where[None, :]]
            done = cut
            if cut < cols.shape[0]:
                stay = keep(score + least[a, i], score + most[a, i])
                if not stay.all():
                    where, score = where[stay], score[stay]
                if not len(where):
                    break
        return where, score.astype(np.int64)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _emit(found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys = [(a, w, len(s)) for (a, w), (s, _) in found.items()]
    rep = [x[2] for x in keys]
    empty = [np.zeros(0, np.int64)]
    return pa.record_batch(
        [
            pa.array(np.repeat(np.array([x[0] for x in keys], np.int32), rep)),
            pa.array(np.repeat(np.array([x[1] for x in keys], np.int64), rep)),
            pa.array(np.concatenate([i for _, i in found.values()] or empty)),
            pa.array(np.concatenate([s for s, _ in found.values()] or empty)),
        ],
        names=["no", "window", "id", "score"],
    )


_FOUND = "no int, window long, id long, score long"


def _positives(anchors: _Anchors, k: int):
    """Per task, the k best other rows of each anchor's own label."""

    def run(batches):
        found: dict = {}
        for ids, labels, cols, least, most in anchors.blocks(batches):
            first, last = (np.searchsorted(labels, anchors.labels, side) for side in ("left", "right"))
            for a in np.flatnonzero(last > first):
                alive = np.zeros(len(ids), bool)
                alive[first[a] : last[a]] = ids[first[a] : last[a]] != anchors.ids[a]
                scores, held = found.get((a, 0), (np.zeros(0, np.int64),) * 2)
                floor = scores[k - 1] if len(scores) == k else None

                def keep(low, high):
                    best = _kth(low, k)
                    bar = best if floor is None else floor if best is None else max(best, floor)
                    return high >= bar if bar is not None else np.ones(len(low), bool)

                where, new = anchors.scan(a, cols, alive, least, most, keep)
                if len(where):
                    scores, held = np.r_[scores, new], np.r_[held, ids[where]]
                    own = _top(scores, held, k)
                    found[(a, 0)] = scores[own], held[own]
        yield _emit(found)

    return run


def _negatives(anchors: _Anchors, windows: list[list[tuple[int, int, int]]], k: int):
    """Per task, the k best rows of other labels in each window (its number, lowest and highest score) of each anchor."""

    def run(batches):
        found: dict = {}
        for ids, labels, cols, least, most in anchors.blocks(batches):
            first, last = (np.searchsorted(labels, anchors.labels, side) for side in ("left", "right"))
            for a, spans in enumerate(windows):
                if not spans:
                    continue
                alive = np.ones(len(ids), bool)
                alive[first[a] : last[a]] = False
                bars = []
                for w, lo, hi in spans:
                    scores = found.get((a, w), ((), ()))[0]
                    bars.append(max(lo, scores[k - 1]) if len(scores) == k else lo)

                def keep(low, high):
                    stay = np.zeros(len(low), bool)
                    for i, (_, lo, hi) in enumerate(spans):
                        fits = (high >= bars[i]) & (low <= hi)
                        best = _kth(low[fits & (low >= lo) & (high <= hi)], k)
                        if best is not None and best > bars[i]:
                            bars[i] = best
                            fits &= high >= best
                        stay |= fits
                    return stay

                where, new = anchors.scan(a, cols, alive, least, most, keep)
                for i, (w, lo, hi) in enumerate(spans):
                    fits = (new >= lo) & (new <= hi)
                    if fits.any():
                        scores, held = found.get((a, w), (np.zeros(0, np.int64),) * 2)
                        scores, held = np.r_[scores, new[fits]], np.r_[held, ids[where[fits]]]
                        own = _top(scores, held, k)
                        found[(a, w)] = scores[own], held[own]
        yield _emit(found)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("no", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "id", label_col: str = "label", vector_col: str = "vector",
         n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: whole-number ids and labels and arrays of whole numbers; ``is_anchor`` says which rows are anchors.
    """
    spark = prepare(vectors.sparkSession)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    valid = (
        vectors.select(
            F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
            F.col(vector_col).cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .where("id is not null and label is not null and vector is not null and forall(vector, x -> x is not null)")
    )
    packed = materialize(valid.select("id", "label", "vector").mapInArrow(_pack, _PACKED), "bond-blocks")
    n_blocks, width, least, most = packed.agg(F.count(F.lit(1)), F.max("width"), F.min("low"), F.max("high")).first()
    if not n_blocks:
        return spark.createDataFrame([], schema)
    largest = width * max(-least, most) ** 2
    if largest >= 2**62:
        raise ValueError("scores of these vectors could leave 64 bits")
    # As many tasks as the cluster's shuffles have: the work of a block is that of all anchors with it.
    spread = min(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = packed.repartition(spread, F.xxhash64("ids"))
    asked = materialize(valid.where("anchor").select("id", "label", "vector").distinct(), "bond-anchors")
    parts = math.ceil(asked.count() / anchor_block)
    out = []
    for part in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("id", "vector"), F.lit(parts)) == part).collect()  # a bounded block of the query set
        if not rows:
            continue
        anchors = _Anchors([(r.id, r.label, r.vector) for r in rows], width, largest < 2**53)
        best = materialize(
            _ranked(packed.mapInArrow(_positives(anchors, n_positives), _FOUND), n_positives)
            .select("no", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
            "bond-positives",
        )
        windows: list[list[tuple[int, int, int]]] = [[] for _ in rows]
        for no, score in best.select("no", "positive_score").distinct().collect():  # at most n_positives an anchor
            lo, hi = -((-low * score) // 100), high * score // 100
            if lo <= hi:
                windows[no].append((score, lo, hi))
        negatives = _ranked(packed.mapInArrow(_negatives(anchors, windows, n_negatives), _FOUND), n_negatives)
        names = spark.createDataFrame(list(enumerate(anchors.ids.tolist())), "no int, anchor_id long")
        met = (
            best.join(F.broadcast(names), "no")
            .join(
                negatives.select("no", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")),
                ["no", "positive_score"],
            )
            .select(*[c.split()[0] for c in schema.split(", ")])
        )
        out.append(met if parts == 1 else materialize(met, "bond-mined"))
    if not out:
        return spark.createDataFrame([], schema)
    first, *rest = out
    for more in rest:
        first = first.unionByName(more)
    return first


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    vectors = rows.where(finite).select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("vector"),
    )
    return mine(vectors, F.col("vec_id") % 50 == 0, id_col="vec_id")


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
