"""Ranked lexical search: all documents against a set of items, by dense blocked multiplication.

Items come in blocks of bounded size.  For a block, one pass over the texts keeps of every
document only its number of terms and the counts of the block's terms; document frequencies
are summed from per-task counts.  A second pass multiplies tiles: the compact vocabulary of a
few dozen items (their weights) times the same terms' impacts in a batch of documents, both
as dense float64 matrices for BLAS.  All values are integers, and a term tile is so narrow
that no partial sum reaches 2^53, so every product is exact in whatever order it is summed;
the sums of several term tiles are added as 64-bit integers.

Each task keeps an item's ``k`` best documents so far, ties cut by id, so that equal scores
neither pile up nor change the result.  What tasks keep is ranked again in salted groups and
then per item.

Defined results: a null or text without a term is neither counted nor ranked; an item without
a term has no rows; rows that repeat an item id are one item with the terms of all of them
(a null id is an id like any other); documents that repeat an id are ranked each; null
document ids come last among equal scores; other columns are ignored; empty tables give an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize, prepare, table

TOP = 50
BLOCK_BYTES = 16 << 20  # distinct item terms of a block, which travels with its tasks
ITEM_TILE = 64
TERM_TILE = 4096  # 4096 terms * weight under 45,000 * impact under 1,000,000 stays below 2^53
SALTS = 64
ONE, KILO, HALF = 1_000_000_000, 1000, 20  # scale of impacts, of term counts, and of the length factor

_ASCII = bytes(c if chr(c).isalnum() else 32 for c in range(128)).lower()
_FOLD = _ASCII + bytes(range(128, 256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all that is not ASCII, with A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


def _item_terms(batches):
    for batch in batches:
        got = [sorted(set(terms(x.as_py()))) for x in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(got, pa.list_(pa.binary()))], names=["item", "terms"])


def _count_terms(vocab: dict[bytes, int], id_type: pa.DataType):
    """Documents with a term: number of terms, and the numbers and counts of those in ``vocab`` (numbered from 1)."""
    schema = pa.schema([("id", id_type), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches):
        known, width = vocab.get, len(vocab) + 1
        for batch in batches:
            sizes, found, own = [], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                hits = np.fromiter(filter(None, map(known, words)), np.int64)
                if len(hits) > 1_000_000:  # a very long text is counted at once, so the batch stays small
                    hits, reps = np.unique(hits, return_counts=True)
                    found.append(np.stack([hits, reps]))
                else:
                    found.append(np.stack([hits, np.ones_like(hits)]))
                sizes.append(len(words))
                own.append(len(found[-1][0]))
            flat = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            keys, at = np.unique(np.repeat(np.arange(len(own)), own) * width + flat[0], return_inverse=True)
            tfs = np.bincount(at, weights=flat[1], minlength=len(keys)).astype(np.int32)
            offsets = np.searchsorted(keys, np.arange(len(own) + 1) * width).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32))) for v in (keys % width - 1, tfs)]
            out = pa.record_batch([batch.column(0).cast(id_type), pa.array(sizes, pa.int64()), *lists], schema=schema)
            yield out.filter(pa.array(np.array(sizes, np.int64) > 0))

    return run


def _frequencies(n_terms: int):
    """Per task, how many of its documents hold each term."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    return run


class _Best:
    """The k best documents of each item so far: highest score first, then smallest id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, np.int64)
        self.items, self.scores, self.ids, self.nulls = (np.zeros(0, t) for t in (np.int64, np.int64, object, bool))
        self.new: list[tuple] = []
        self.waiting = 0

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """``scores``: items from ``first`` on by documents."""
        item, doc = np.nonzero(scores >= self.floor[first : first + len(scores), None])
        self.new.append((item + first, scores[item, doc], ids[doc], nulls[doc]))
        self.waiting += len(item)
        if self.waiting > max(200_000, len(self.items)):
            self.cut()

    def cut(self) -> None:
        held = [(self.items, self.scores, self.ids.astype(self.new[0][2].dtype) if self.new else self.ids, self.nulls), *self.new]
        item, score, ids, nulls = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((np.unique(ids, return_inverse=True)[1], nulls, -score, item))
        item = item[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        order = order[place < self.k]
        last = place == self.k - 1
        self.items, self.scores, self.ids, self.nulls = item[place < self.k], score[order], ids[order], nulls[order]
        self.floor[item[last]] = self.scores[(place < self.k).cumsum()[last] - 1]
        self.new, self.waiting = [], 0


def _scores(item_terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int, id_type: pa.DataType):
    """Per task, the k best documents of each item of the block, by number of the item."""
    schema = pa.schema([("no", pa.int32()), ("id", id_type), ("score", pa.int64())])
    whole = pa.types.is_integer(id_type)

    def run(batches):
        best = _Best(len(item_terms), k)
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column(1).to_numpy(zero_copy_only=False)
            if 50 * int(n.max()) * n_docs < 2**63:
                m = 50 + 50 * n * n_docs // n_terms
            else:
                m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], np.int64)
            own = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(batch.num_rows), own)
            term, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
            impact = ONE * tf // (KILO * tf + HALF * m[doc])
            order = np.argsort(term, kind="stable")
            term, doc, impact = term[order], doc[order], impact[order]
            nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0 if whole else "").to_numpy(zero_copy_only=False)
            for first in range(0, len(item_terms), ITEM_TILE):
                tile = item_terms[first : first + ITEM_TILE]
                vocab, at = np.unique(np.concatenate(tile), return_inverse=True)
                row = np.repeat(np.arange(len(tile)), [len(t) for t in tile])
                scores = np.zeros((len(tile), batch.num_rows), np.int64)
                for low in range(0, len(vocab), TERM_TILE):
                    part = vocab[low : low + TERM_TILE]
                    mine = (at >= low) & (at < low + len(part))
                    items = np.zeros((len(tile), len(part)))
                    items[row[mine], at[mine] - low] = weights[part[at[mine] - low]]
                    start, end = np.searchsorted(term, part), np.searchsorted(term, part, "right")
                    held = end - start
                    upto = np.cumsum(held)
                    where = np.repeat(start - (upto - held), held) + np.arange(held.sum())
                    docs = np.zeros((len(part), batch.num_rows))
                    docs[np.repeat(np.arange(len(part)), held), doc[where]] = impact[where]
                    scores += (items @ docs).astype(np.int64)
                best.add(first, scores, ids, nulls)
        best.cut()
        ids = pa.array(best.ids.astype(np.int64) if whole else best.ids, pa.int64() if whole else pa.string(), mask=best.nulls)
        yield pa.record_batch([pa.array(best.items.astype(np.int32)), ids.cast(id_type), pa.array(best.scores)], schema=schema)

    return run


def _first(ranked: DataFrame, k: int, *group) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (item, rank, id, score): each item's ``k`` documents of the highest scores above 0."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = prepare(docs.sparkSession)
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    if not (pa.types.is_integer(id_type) or pa.types.is_string(id_type)):
        raise ValueError(f"ids must be integers or strings, not {kind}")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    wanted = materialize(
        items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("binary").alias("text"))
        .mapInArrow(_item_terms, f"item {item_kind}, terms array<binary>")
        .select("item", F.explode("terms").alias("term")).distinct(),
        "rank-items",
    )
    size = wanted.agg(F.sum(F.length("term") + 16)).first()[0] or 0
    n_blocks = math.ceil(size / block_bytes)
    stats, out = None, []
    for block in range(n_blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).orderBy("item", "term").collect()
        if not rows:
            continue
        vocab = {t: i + 1 for i, t in enumerate(sorted({bytes(r.term) for r in rows}))}
        names = list(dict.fromkeys(r.item for r in rows))
        number, held = {x: i for i, x in enumerate(names)}, [[] for _ in names]
        for r in rows:
            held[number[r.item]].append(vocab[bytes(r.term)] - 1)
        counted = materialize(
            texts.mapInArrow(_count_terms(vocab, id_type), f"id {kind}, n long, terms array<int>, tfs array<int>"), "rank-counts"
        )
        if stats is None:
            stats = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        n_docs, n_terms = stats[0], stats[1] or 0
        met = counted.where(F.size("terms") > 0)
        df = np.zeros(len(vocab), np.int64)
        tallied = met.select("terms").mapInArrow(_frequencies(len(vocab)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        for r in tallied.collect():  # one row a term of the block
            df[r.term] = r.df
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.float64)
        kept = met.mapInArrow(
            _scores([np.array(x) for x in held], weights, n_docs, max(n_terms, 1), k, id_type), f"no int, id {kind}, score long"
        )
        salted = _first(kept.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))), k, "no", "salt").drop("rank", "salt")
        ranked = _first(salted, k, "no")
        own = spark.createDataFrame(list(enumerate(names)), f"no int, item {item_kind}")  # bounded by the block
        ranked = ranked.join(F.broadcast(own), "no").select("item", "rank", "id", "score")
        out.append(ranked if n_blocks == 1 else materialize(ranked, "rank-block"))
    if not out:
        return spark.createDataFrame([], f"item {item_kind}, rank int, id {kind}, score long")
    first, *rest = out
    for more in rest:
        first = first.unionByName(more)
    return first


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    ranked = rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPLIT = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SPLIT} AS t FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({_SPLIT}) AS term FROM benchmark),
p AS (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d),
c AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM f, s),
i AS (SELECT rid, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)) AS impact FROM c, s),
r AS (SELECT item_id, rid, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
      FROM q JOIN i USING (term) JOIN w USING (term) GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
