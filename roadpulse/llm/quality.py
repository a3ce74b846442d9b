"""Quality rules on repetition, from a suffix array over the words of each document.

Words are numbered, a suffix array of every document is built by prefix doubling
(all documents of a batch at once, suffixes never compare across documents), and the
longest common prefixes of neighbouring suffixes give the maximal repeated word
sequences.  Their spans are united; a document fails if they cover too much of it or
if its longest repeat is too long.

Defined results: null and empty texts have no words, all counts zero, and fail
``n_words``; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import fresh, prepare, table

MIN_WORDS = 10
REPEAT_WORDS = 5  # shortest repeat that counts
MAX_REPEAT_PERCENT = 20  # of a document's words, and of the characters in them
MAX_LONGEST = 100  # words in the longest repeat
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "longest_repeat long, repeat_chars long, base_failed boolean, kept boolean"
)


def suffix_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position, how many words from it on also start at another position of its document.

    ``doc`` is non-decreasing; ``words`` are small integers.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # rank: place of the first of its group
    scales, k = [rank.copy()], 1
    size = np.bincount(rank, minlength=n)
    active = np.flatnonzero(size[rank] > 1)
    while len(active):
        after = np.minimum(active + k, n - 1)
        r1 = rank[active]
        r2 = np.where((active + k < n) & (doc[after] == doc[active]), rank[after] + 1, 0)
        order = np.argsort(r1 * (n + 2) + r2, kind="stable")
        a, r1, r2 = active[order], r1[order], r2[order]
        head = np.r_[True, r1[1:] != r1[:-1]]
        new = head | np.r_[True, r2[1:] != r2[:-1]]
        place = np.arange(len(a))
        first_head = np.flatnonzero(head)[np.cumsum(head) - 1]
        first_new = place[new][np.cumsum(new) - 1]
        rank[a] = r1 + first_new - first_head
        sizes = np.diff(np.r_[np.flatnonzero(new), len(a)])
        active = a[np.repeat(sizes, sizes) > 1]
        k *= 2
        scales.append(rank.copy())
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)  # of suffixes[r - 1] and suffixes[r]
    i, j = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(scales[0][i] == scales[0][j])
    i, j, shared = i[near], j[near], np.zeros(len(near), np.int64)
    for level in range(len(scales) - 1, -1, -1):
        same = (np.maximum(i, j) + shared) < n
        at = np.flatnonzero(same)
        hit = scales[level][i[at] + shared[at]] == scales[level][j[at] + shared[at]]
        at = at[hit]
        # Equal ranks at the last scale would mean equal suffixes, which do not exist.
        shared[at] += 1 << level
    lcp[near + 1] = shared
    longest = np.empty(n, np.int64)
    longest[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return longest


def measure(texts: list[str | None], repeat_words: int = REPEAT_WORDS) -> pd.DataFrame:
    """Counts of each text, all of them measured together."""
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    sizes, rows = [], []
    for text in texts:
        text = text or ""
        words = text.encode().split()  # on \x20 and \x09-\x0D
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
        sizes.append(len(words))
        seen: set[str] = set()
        dup = 0
        for line in text.split("\n"):
            if line.strip(SPACE):
                dup += line in seen
                seen.add(line)
        rows.append((len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dup))
    out = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines"])
    n = len(ids)
    words, doc = np.array(ids, np.int64), np.repeat(np.arange(len(texts)), sizes)
    longest = suffix_repeats(words, doc)
    lengths = np.array([len(w.decode()) for w in numbers], np.int64)
    chars = lengths[words] if n else np.zeros(0, np.int64)
    starts = np.flatnonzero(longest >= repeat_words)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + longest[starts], -1)
    covered = np.cumsum(marks[:-1]) > 0
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=len(texts)).astype(np.int64)
    out["repeat_chars"] = np.bincount(doc[covered], chars[covered], minlength=len(texts)).astype(np.int64)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, doc, np.where(longest >= repeat_words, longest, 0))
    out["longest_repeat"] = most
    return out


def quality_column(text, min_words=MIN_WORDS, repeat_words=REPEAT_WORDS, max_percent=MAX_REPEAT_PERCENT, max_longest=MAX_LONGEST):
    """Struct column of counts, ``base_failed`` and the verdict ``kept``."""

    @F.pandas_udf(FIELDS)
    def quality(texts: pd.Series) -> pd.DataFrame:
        q = measure(list(texts), repeat_words)
        q["base_failed"] = (q.n_words < min_words) | (100 * q.n_repeat_words > max_percent * q.n_words)
        over = (100 * q.repeat_chars > max_percent * q.word_chars) | (q.longest_repeat > max_longest)
        q["kept"] = ~(q.base_failed | over)
        return q[[f.split()[0] for f in FIELDS.split(", ")]]

    return quality(text)


def apply_quality_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the rules, columns unchanged."""
    prepare(docs.sparkSession)
    name = fresh(docs, "quality")
    return docs.withColumn(name, quality_column(docs[text_col])).where(F.col(f"{name}.kept")).select(docs.columns)


def op9_quality_repetition(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", quality_column(F.col("text")).alias("q")).select("doc_id", "q.*")
