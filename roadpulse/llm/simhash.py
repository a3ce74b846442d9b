"""Near-duplicate documents by SimHash fingerprints and meet-in-the-middle ball hashing.

Two fingerprints at most ``max_bits`` apart have a common value within half that
distance of both.  So every distinct fingerprint emits all its variants within half
the radius, variants are shuffled, and fingerprints meeting on a variant are linked
after their distance is verified.  A variant travels as (its leading bits, the
fingerprint, flips left): the flips of the trailing bits are made after the shuffle,
in the task that owns those leading bits, so a fingerprint costs tens of shuffled rows
rather than thousands.  The number of leading bits follows the number of distinct
fingerprints; a bucket that is still large is worked through in slices of further
bits, so memory stays bounded however many fingerprints share it.

Defined results: null and empty texts have fingerprint zero and are linked like any
other; texts shorter than a shingle hash their whole word sequence; equal rows get
equal results; a null id takes part but is never a component's id unless all are null;
an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import connected_components, fresh, materialize, prepare, table

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Variants that one task expands at a time (8 bytes each, about four arrays of them).
VARIANTS_AT_ONCE = 2_000_000


def simhash(text: str | None, k: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text's k-word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z, splits on \x20 and \x09-\x0D
    n = len(words)
    if not n:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= k:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: n - k + 1].tolist()
    count = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        h = np.array(
            [digest(joined[s:e], seed) for s, e in zip(starts[at : at + (1 << 16)], ends[k - 1 + at :].tolist())],
            np.uint64,
        )
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * count > len(starts)))


def fingerprint_column(text, k: int = SHINGLE_WORDS):
    """Column of signed 64-bit fingerprints."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, k) for t in texts], np.uint64).view(np.int64))

    return fingerprint(text)


def _masks(bits: int, most: int) -> list[np.ndarray]:
    """Masks of 0..most set bits among the lowest ``bits``, by number of bits."""
    return [
        np.array([sum(1 << i for i in c) for c in itertools.combinations(range(bits), w)], np.uint64)
        for w in range(most + 1)
    ]


def _emit(bits: int, half: int):
    """Rows (bucket, fp, left): the leading bits of the variants, and how many trailing flips remain."""
    schema = pa.schema([("bucket", pa.int64()), ("fp", pa.int64()), ("left", pa.int8())])

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for w, masks in enumerate(_masks(bits, min(half, bits))):
                head = (fp >> np.uint64(64 - bits)) if bits else np.zeros_like(fp)
                bucket = (head[:, None] ^ masks[None, :]).ravel().view(np.int64)
                yield pa.record_batch(
                    [bucket, np.repeat(fp, len(masks)).view(np.int64), np.full(len(bucket), half - w, np.int8)],
                    schema=schema,
                )

    return run


def _links(fp: np.ndarray, left: np.ndarray, low: int, half: int, max_bits: int, out: list, at_once: int) -> None:
    """Appends the (i, j) index pairs found among one bucket's fingerprints; ``low`` trailing bits are still open."""
    if len(fp) < 2:
        return
    cost = sum(int((left == w).sum()) * sum(math.comb(low, j) for j in range(w + 1)) for w in range(half + 1))
    if cost > at_once and low:
        step = min(4, low)
        part = (fp >> np.uint64(low - step)) & np.uint64((1 << step) - 1)
        for value in range(1 << step):
            rest = left - np.bitwise_count(part ^ np.uint64(value)).astype(np.int8)
            own = np.flatnonzero(rest >= 0)
            found: list = []
            _links(fp[own], rest[own], low - step, half, max_bits, found, at_once)
            out += [(own[i], own[j]) for i, j in found]
        return
    tails = _masks(low, min(half, low))
    open_bits = fp & np.uint64((1 << low) - 1)
    variants, owners, weights = [], [], []
    for w in range(half + 1):
        rows = np.flatnonzero(left == w)
        for used, masks in enumerate(tails[: w + 1]):
            variants.append((open_bits[rows, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(rows, len(masks)))
            weights.append(np.full(len(rows) * len(masks), half - w + used, np.int8))
    v, o, wt = np.concatenate(variants), np.concatenate(owners), np.concatenate(weights)
    order = np.argsort(v) if max_bits % 2 == 0 else np.lexsort((wt, v))
    v, o, wt = v[order], o[order], wt[order]
    new = np.r_[True, v[1:] != v[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    # With an odd distance two fingerprints at the full half radius may lie one bit too far apart;
    # a closer member then links them, and the lightest one stands first.
    ok = ~new & ((wt[first] < half) | (max_bits % 2 == 0))
    i, j = o[first[ok]], o[ok]
    near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
    out.append((i[near], j[near]))


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n points over the pairs (i, j)."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, up := root[root]):
            root = up
    return root


def _link(bits: int, half: int, max_bits: int, at_once: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        bucket, fp, left = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in kept]) for c in range(3))
        order = np.argsort(bucket, kind="stable")
        bucket, fp, left = bucket[order], fp[order].view(np.uint64), left[order]
        for rows in np.split(np.arange(len(bucket)), np.flatnonzero(bucket[1:] != bucket[:-1]) + 1):
            found: list = []
            _links(fp[rows], left[rows], 64 - bits, half, max_bits, found, at_once)
            if found:
                i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                root = _forest(len(rows), i, j)
                moved = np.flatnonzero(root != np.arange(len(rows)))
                if len(moved):
                    yield pa.record_batch(
                        [fp[rows][root[moved]].view(np.int64), fp[rows][moved].view(np.int64)], schema=schema
                    )

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, at_once: int = VARIANTS_AT_ONCE) -> DataFrame:
    """Links (a, b) that join all fingerprints (column ``fp``, distinct) at most ``max_bits`` apart.

    Within a bucket only a spanning forest of the verified pairs is returned, so links
    stay proportional to fingerprints; no two linked fingerprints lose their connection.
    """
    half = (max_bits + 1) // 2
    n = fps.count()
    ball = sum(math.comb(64, w) for w in range(half + 1))
    bits = min(32, max(0, math.ceil(math.log2(max(1.0, n * ball / at_once)))))
    # Deal buckets so that a task sorts some hundred thousand short rows.
    rows = n * sum(math.comb(bits, w) for w in range(min(half, bits) + 1))
    parts = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // 300_000 + 1)
    emitted = fps.select("fp").mapInArrow(_emit(bits, half), "bucket long, fp long, left byte")
    return emitted.repartition(parts, "bucket").mapInArrow(_link(bits, half, max_bits, at_once), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """Rows (id, fp, component): one per row of ``docs``, component the smallest id reachable over links."""
    prepare(docs.sparkSession)
    marked = materialize(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash"
    )
    fps = materialize(marked.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = connected_components(fingerprint_links(fps, max_bits))
    joined = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = joined.groupBy("root").agg(F.min("first").alias("component"))
    classes = joined.join(firsts, "root").select("fp", "component")
    return marked.join(classes, "fp").select("id", "fp", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows repeated under that id stay together if their texts are equal; rows whose id is
    null stay only if their whole component has no id.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    key = fresh(docs, "kept_id")
    keep = found.where(F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias(key)).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(keep[key]), "left_semi").select(docs.columns)


def op3_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
