"""Benchmark decontamination: a BM25 index of test items, queried with every training passage.

Spark computes the index: words of the items, document frequencies, and BM25 impacts,
each divided by the item's score against itself, so a score is the share of the item
that a passage holds and one threshold serves all items.  Items are dealt into shards of
a bounded number of postings, each built by one task, written, and small enough to
broadcast; a larger benchmark makes more shards, never a larger one, and documents meet
a few shards a pass, so neither the driver nor a worker holds the whole index.  Within a
shard items of alike length form a class with its own passage size, stepped by the
longest item's words, so that any occurrence falls whole into some passage, also one
that inserted words made longer by a quarter.

A passage is pruned when the sum of its words' largest impacts stays below the
threshold in every one of a few ranges of items.  The others run block-max WAND over the postings and return every item at or
above the threshold, without a limit on their number.  Retrieved pairs are verified:
word five-grams of the question found in the passage, and words of the answer (the
item's last sentence), 0.8 or more of each.

Defined results: null and empty texts match nothing, items without words are never
found, repeated items and rows are each answered (an item id that repeats with other
texts too), an item's best passage is the one highest in score, then in question and
answer overlap, other columns of the documents pass through, empty tables give empty
results.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_left
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import fresh, materialize, prepare, table

K1, B = 1.2, 0.75
THRESHOLD = 0.7  # share of an item's BM25 score against itself
OVERLAP = 0.8  # of the question's five-grams and of the answer's words
SHINGLE = 5
RANGES = 16  # of items, for the bound on a passage
BLOCK = 64  # postings that share a maximum
SHARD_POSTINGS = 1_000_000  # of a broadcast index, some 50 MB
SHARDS_PER_PASS = 4  # indexes that a worker holds at once
SENTENCE = re.compile(r"[.!?]+[\"')\]]*\s+(?=\S)")
WORDS = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return WORDS((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item before its last sentence, and of that sentence; one sentence alone is the question."""
    ends = [m.end() for m in SENTENCE.finditer(text.strip())]
    question, answer = words_of(text.strip()[: ends[-1]] if ends else text), words_of(text.strip()[ends[-1] :] if ends else "")
    return (question, answer) if question else (answer, [])


def shingles(words: list[str], n: int = SHINGLE) -> set[tuple[str, ...]]:
    """Word n-grams; of fewer words, the whole sequence."""
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


class Postings:
    """Items (ascending numbers) and impacts of one word, with a maximum for each block."""

    __slots__ = ("items", "impacts", "top", "tops")

    def __init__(self, items: list[int], impacts: list[float]):
        self.items, self.impacts, self.top = items, impacts, max(impacts)
        self.tops = [max(impacts[i : i + BLOCK]) for i in range(0, len(impacts), BLOCK)]


def block_max_wand(lists: list[Postings], threshold: float) -> list[tuple[int, float]]:
    """All (item, score) with a summed impact of at least ``threshold``."""
    slack = threshold - 1e-9  # impacts are sums of floats
    end = 1 << 62
    cursors = [[p.items[0], 0, p] for p in lists]  # current item, place, postings
    found = []

    def seek(c, item):
        place = bisect_left(c[2].items, item, c[1])
        c[1] = place
        c[0] = c[2].items[place] if place < len(c[2].items) else end

    while True:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            if c[0] == end:
                break
            bound += c[2].top
            if bound >= slack:
                pivot = i
                break
        if pivot < 0:
            return found
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        # The blocks that hold the pivot, and where the first of them ends.
        local, upto = 0.0, end
        for c in cursors[: pivot + 1]:
            place = bisect_left(c[2].items, item, c[1])
            if place < len(c[2].items):
                block = place // BLOCK
                local += c[2].tops[block]
                last = c[2].items[min(len(c[2].items), (block + 1) * BLOCK) - 1]
                upto = min(upto, last)
        if local < slack:
            target = upto + 1 if upto < end else item + 1
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            target = max(target, item + 1)
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    seek(c, target)
        elif cursors[0][0] == item:
            score = 0.0
            for c in cursors[: pivot + 1]:
                score += c[2].impacts[c[1]]
                seek(c, item + 1)
            if score >= slack:
                found.append((item, score))
        else:
            for c in cursors[:pivot]:
                if c[0] < item:
                    seek(c, item)


class Shard:
    """Postings, passage sizes and texts of some items, by class of length."""

    def __init__(self, postings: pd.DataFrame, items: pd.DataFrame):
        self.words = {w: i for i, w in enumerate(sorted(postings["word"].unique()))}
        self.keys = list(items["item_id"])
        self.parts = [question_and_answer(t) for t in items["text"]]
        number = {int(i): n for n, i in enumerate(items["item_no"])}
        self.classes = []
        for size, own in postings.groupby("size_class"):
            longest = int(own["n_words"].max())
            lists: dict[int, Postings] = {}
            for word, p in own.groupby("word"):
                rows = sorted(zip((number[int(i)] for i in p["item_no"]), p["impact"].tolist()))
                lists[self.words[word]] = Postings([r[0] for r in rows], [r[1] for r in rows])
            tops = np.zeros(len(self.words) + 1)  # the last place: words of no item
            tops[list(lists)] = [p.top for p in lists.values()]
            # The same maxima for ranges of items: a passage that no range of items can satisfy is skipped whole.
            used = sorted(number[int(i)] for i in own["item_no"].unique())
            range_of = {item: k * RANGES // len(used) for k, item in enumerate(used)}
            by_range = np.zeros((len(self.words) + 1, RANGES), np.float32)
            for i, p in lists.items():
                np.maximum.at(by_range[i], [range_of[x] for x in p.items], np.array(p.impacts, np.float32))
            # Any stretch of words that an edited copy within OVERLAP may take falls whole into some passage.
            self.classes.append((longest + math.ceil(longest / OVERLAP), longest, tops, lists, by_range))

    def hits(self, text: str | None, threshold: float, overlap: float) -> list[tuple]:
        """Verified (item_id, score, question overlap, answer overlap) of one document, best passage of each item."""
        words = words_of(text)
        get, none = self.words.get, len(self.words)
        ids = np.array([get(w, none) for w in words], np.int64)
        best: dict[int, tuple] = {}
        for size, step, tops, lists, by_range in self.classes:
            bound = np.r_[0.0, np.cumsum(tops[ids])]
            starts = np.arange(0, max(1, len(ids) - size + step), step)
            ends = np.minimum(starts + size, len(ids))
            for at in np.flatnonzero(bound[ends] - bound[starts] >= threshold - 1e-6):
                own = np.unique(ids[starts[at] : ends[at]])
                own = own[tops[own] > 0]
                if by_range[own].sum(0).max(initial=0.0) < threshold - 1e-4:
                    continue
                for item, score in block_max_wand([lists[i] for i in own.tolist()], threshold):
                    passage = words[starts[at] : ends[at]]
                    question, answer = self.parts[item]
                    q, a = overlap_of(passage, question, answer)
                    if q >= overlap and a >= overlap and (item not in best or (score, q, a) > best[item]):
                        best[item] = (score, q, a)
        return [(self.keys[i], *best[i]) for i in sorted(best)]


def overlap_of(passage: list[str], question: list[str], answer: list[str]) -> tuple[float, float]:
    """Shares of the question's five-grams, and of the answer's words, that the passage holds."""
    want, words = shingles(question), set(answer)
    n = min(SHINGLE, len(question))
    q = len(want & shingles(passage, n)) / len(want) if want else 1.0
    return q, len(words & set(passage)) / len(words) if words else 1.0


def bm25_postings(items: DataFrame) -> DataFrame:
    """Rows (item_no, n_words, size_class, word, impact) of items (item_no, text); an item's impacts add up to 1."""

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(t) for t in texts])

    words = materialize(items.select("item_no", split("text").alias("words")).withColumn("n_words", F.size("words")).where("n_words > 0"), "bm25-words")
    tf = words.select("item_no", "n_words", F.explode("words").alias("word")).groupBy("item_no", "n_words", "word").agg(F.count("*").alias("tf"))
    df = tf.groupBy("word").agg(F.count("*").alias("df"))
    whole = words.agg(F.count("*").alias("n"), F.avg("n_words").alias("mean")).first()
    n, mean = whole["n"], whole["mean"] or 1.0
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n_words") / mean))
    raw = tf.join(df, "word").withColumn("raw", idf * part)
    whole_score = raw.groupBy("item_no").agg(F.sum("raw").alias("self"))
    return raw.join(whole_score, "item_no").select(
        "item_no", "n_words", F.ceil(F.log2("n_words")).cast("int").alias("size_class"), "word", (F.col("raw") / F.col("self")).alias("impact")
    )


def write_shards(items: DataFrame, item_col: str = "item_id", text_col: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Rows (shard, data): pickled indexes of all items, each of about ``shard_postings`` postings, built by the task that owns the shard."""
    prepare(items.sparkSession)
    numbered = materialize(
        items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("item_no")), "bm25-items"
    )
    postings = materialize(bm25_postings(numbered), "bm25-postings")
    shards = max(1, math.ceil(postings.count() / shard_postings))
    own = F.pmod(F.xxhash64("item_no"), F.lit(shards)).cast("int").alias("shard")

    def build(rows: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"shard": [], "data": []})
        # As bytes that carry their classes: executors need no installed copy of this package.
        data = cloudpickle.dumps(Shard(rows, texts.sort_values("item_no")))
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "data": [data]})

    built = postings.select(own, "*").groupBy("shard").cogroup(numbered.select(own, "*").groupBy("shard"))
    return materialize(built.applyInPandas(build, "shard int, data binary"), "bm25-shards")


def shard_passes(shards: DataFrame, per_pass: int = SHARDS_PER_PASS):
    """Lists of at most ``per_pass`` broadcast indexes; only one pass is in the driver and the workers at a time."""
    numbers = sorted(r["shard"] for r in shards.select("shard").collect())
    for at in range(0, len(numbers), per_pass):
        rows = (shards.where(F.col("shard") == k).select("data").first() for k in numbers[at : at + per_pass])
        yield [shards.sparkSession.sparkContext.broadcast(bytes(r["data"])) for r in rows], at + per_pass >= len(numbers)


def build_shards(items: DataFrame, item_col: str = "item_id", text_col: str = "text", shard_postings: int = SHARD_POSTINGS) -> list:
    """Broadcast indexes of all items at once, for benchmarks of few shards."""
    return [s for own, _ in shard_passes(write_shards(items, item_col, text_col, shard_postings)) for s in own]


def hits_column(text: Column, shards: list, item_type: str, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Column:
    """Array of (item_id, score, question, answer) of the items found in a text."""
    kind = f"array<struct<item_id:{item_type},score:double,question:double,answer:double>>"

    def of(sent):
        loaded: list = []  # once a task

        @F.pandas_udf(kind)
        def hits(texts: pd.Series) -> pd.Series:
            if not loaded:
                loaded.append(pickle.loads(sent.value))
            return pd.Series([loaded[0].hits(t, threshold, overlap) for t in texts])

        return hits(text)

    return F.concat(F.array().cast(kind), *map(of, shards))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_postings: int = SHARD_POSTINGS,
                 per_pass: int = SHARDS_PER_PASS) -> DataFrame:
    """Rows (id, item_id, score, question, answer): each test item found in each row of ``docs``."""
    item_type = items.schema[item_col].dataType.simpleString()
    out = []
    for shards, last in shard_passes(write_shards(items, item_col, shard_postings=shard_postings), per_pass):
        found = docs.select(F.col(id_col).alias("id"), hits_column(F.col(text_col), shards, item_type, threshold, overlap).alias("hits"))
        found = found.select("id", F.explode("hits").alias("h")).select("id", "h.*")
        out.append(found if last else _finish(found, shards))
    if not out:  # no item has a word
        none = hits_column(F.col(text_col), [], item_type)
        return docs.select(F.col(id_col).alias("id"), F.explode(none).alias("h")).select("id", "h.*")
    return reduce(DataFrame.unionByName, out)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      shard_postings: int = SHARD_POSTINGS, per_pass: int = SHARDS_PER_PASS) -> DataFrame:
    """The rows of ``docs`` that hold no test item, columns unchanged."""
    item_type = items.schema[item_col].dataType.simpleString()
    for shards, last in shard_passes(write_shards(items, item_col, shard_postings=shard_postings), per_pass):
        name = fresh(docs, "hits")
        hits = hits_column(F.col(text_col), shards, item_type)
        kept = docs.withColumn(name, hits).where(F.size(name) == 0).select([F.col(f"`{c}`") for c in docs.columns])
        docs = kept if last else _finish(kept, shards)
    return docs


def _finish(found: DataFrame, shards: list) -> DataFrame:
    """The written rows of a pass, whose indexes are no longer needed."""
    out = materialize(found, "bm25-pass")
    for s in shards:
        s.destroy()
    return out


def op4_decontaminate_bm25(spark, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "item_id",
        F.round("score", 6).alias("score"),
        F.round("question", 6).alias("question_overlap"),
        F.round("answer", 6).alias("answer_overlap"),
    )
