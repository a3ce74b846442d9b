"""Personal data: fixed patterns, and identifiers found by bootstrapping from their contexts.

The fixed patterns give seed entities.  Every identifier-like string (a run without
spaces that holds digits, or digit-bearing groups with single spaces between them) and
every seed becomes an instance, whatever letters it holds; the words around an occurrence
are its lexical patterns, found at any distance over white space.  Spark scores the graph of patterns and instances in rounds: a
pattern is as good as the share of its other instances believed to be personal data, seeds
or found in an earlier round; two words are judged from what one word of them tells on.
An instance is as good as its best patterns together.  Instances that high-confidence
patterns find become spans of the text too; of nested ones the longest.

Texts are read once, in Python, which only finds the fixed patterns, the candidates and
their contexts; counting, scoring and discovery are joins and aggregates over those.

Defined results: null and empty texts have no spans; equal rows get equal results; a
table without seeds induces no pattern; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize, prepare, table

KINDS = ["email", "ip", "card", "phone", "context"]
ROUNDS = 3
SHRINK = 2.0  # added to a pattern's instances, so that rare patterns score low
BACK_OFF = 0.6  # what a one-word pattern's confidence counts for where its two-word pattern is new
MIN_CONFIDENCE = 0.4  # share of a pattern's instances believed, from which on it may discover
MIN_SCORE = 0.7  # of an instance that is discovered: one sure pattern, or two that agree
MIN_DIGITS = 3  # of a candidate
LONG_WORD = 64  # characters; longer neighbours, such as a text without spaces, all stand as one mark
MIN_LENGTH = 6  # letters and digits of a candidate

# Runs start where no character of their class stands before, or right after the last match
# (\G): the same matches as plain search, without trying each start within a long run.
PATTERNS = [
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
CANDIDATE = r"(?<!\S)\S*?[0-9]\S*"
# Groups with digits and single spaces between them; a short group of letters may stand before and after.
GROUP = r"[A-Z./-]*+[0-9][A-Z0-9./-]*+"
SPACED = rf"(?<![^\s(\[{{\"':#=])(?:[A-Z]{{1,3}}\x20)?+({GROUP}(?:\x20{GROUP})+)(?:\x20[A-Z]{{1,2}}(?!\w))?(?!\w)"
EDGES = ".,;:!?\"'()[]{}<>|#*$%&"
SPANS = "array<struct<start:int,end:int,kind:int,value:string>>"
CONTEXTS = "array<struct<start:int,end:int,value:string,seed:boolean,patterns:array<struct<pattern:string,parent:string>>>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind: int, value: str) -> bool:
    """Whether a match of a fixed pattern passes its check."""
    if kind == 0:
        return True
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))
    digits = "".join(c for c in value if c in "0123456789")
    return 10 <= len(digits) <= 15 if kind == 3 else 14 <= len(digits) <= 19 and luhn(digits)


class Finder:
    def __init__(self):
        self.find = [regex.compile(p).finditer for p in PATTERNS]
        self.candidates = regex.compile(CANDIDATE).finditer
        self.spaced = regex.compile(SPACED).finditer
        self.digit = regex.compile("[0-9]").search
        self.words = regex.compile(r"\S+").finditer

    def base(self, text: str) -> list[tuple[int, int, int, str]]:
        """Spans (start, end, kind, value) by start, then kind."""
        digit = self.digit(text) is not None
        may = ("@" in text, digit and text.count(".") > 2, digit, digit and "+" in text)
        found = [
            (m.start(), m.end(), kind, m.group())
            for kind, find in enumerate(self.find)
            if may[kind]
            for m in find(text)
            if valid(kind, m.group())
        ]
        return sorted(found, key=lambda s: (s[0], s[2]))

    def patterns(self, text: str, start: int, end: int, starts: list[int], ends: list[int]) -> list[tuple[str, str | None]]:
        """Lexical patterns of an occurrence, each with its parent: two words before, and one word on either side.

        Their parents, patterns too, have one word, before or after; ^ and $ stand for missing words.  Words
        are what stands between white space of any width (``starts`` and ``ends`` are those of the text's words); what
        is joined to the value on either side is a word too.
        """
        at = bisect_left(starts, start)  # the first word that begins at the value or after it
        near = [(starts[i], min(ends[i], start)) for i in range(max(0, at - 2), at)]
        first, left = (["^", "^"] + [self.word(text, *w) for w in near])[-2:]
        at = bisect_right(ends, end)  # the first word that ends after the value
        right = self.word(text, max(starts[at], end), ends[at]) if at < len(ends) else "$"
        one, other = f"{left} _", f"_ {right}"
        return [(f"{first} {left} _", one), (f"{left} _ {right}", other), (one, None), (other, None)]

    @staticmethod
    def word(text: str, start: int, end: int) -> str:
        """A word of a pattern; one of more than LONG_WORD characters is no word but stands as a mark."""
        return text[start:end].strip(".,;!?\"'").lower() if end - start <= LONG_WORD else "\N{HORIZONTAL ELLIPSIS}"

    def candidates_of(self, text: str) -> list[tuple[int, int, str]]:
        """Identifier-like strings (start, end, value) by start: runs without spaces, and spaced groups with and without letters around."""
        out = set()
        if self.digit(text):
            places = [m.span() for m in self.candidates(text)]
            places += [m.span(g) for m in self.spaced(text) for g in (0, 1)]
            for start, end in places:
                run = text[start:end]
                value = run.strip(EDGES)
                if sum(c in "0123456789" for c in value) < MIN_DIGITS or sum(c.isalnum() for c in value) < MIN_LENGTH:
                    continue
                start += run.index(value)
                out.add((start, start + len(value), value))
        return sorted(out)

    def contexts(self, text: str, base: list) -> list[tuple]:
        """Occurrences (start, end, value, seed, patterns) of seeds and of candidates outside them."""
        out, upto = [], []
        candidates = self.candidates_of(text)
        words = [m.span() for m in self.words(text)] if base or candidates else []
        words = [w[0] for w in words], [w[1] for w in words]
        for start, end, _, value in base:
            out.append((start, end, value, True, self.patterns(text, start, end, *words)))
            upto.append((start, end))
        at = 0
        upto.sort()
        for start, end, value in candidates:
            while at < len(upto) and upto[at][1] <= start:
                at += 1
            if at < len(upto) and upto[at][0] < end:
                continue
            out.append((start, end, value, False, self.patterns(text, start, end, *words)))
        return out


def found_column(text: Column) -> Column:
    """Struct column of the base spans and the occurrences with their patterns."""

    @F.pandas_udf(f"base {SPANS}, seen {CONTEXTS}")
    def found(texts: pd.Series) -> pd.DataFrame:
        finder = Finder()
        base = [finder.base(t) if t else [] for t in texts]
        return pd.DataFrame({"base": base, "seen": [finder.contexts(t, b) if t else [] for t, b in zip(texts, base)]})

    return found(text)


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Instances (value, seed, score) of a graph of distinct edges (pattern, parent, value, seed), scored in rounds.

    An edge's confidence leaves its own instance out, so none supports itself; every
    round is three aggregates and three joins, written to the shared folder.
    """
    graph = materialize(edges, "pii-graph")
    scores = graph.select("value", "seed").distinct().withColumn("score", F.col("seed").cast("double"))
    for _ in range(rounds):
        held = (
            graph.join(scores.select("value", "score"), "value").groupBy("pattern", "parent")
            .agg(F.sum("score").alias("believed"), F.count("*").alias("n"))
        )
        held = materialize(held, "pii-patterns")
        ones = held.where("parent is null and believed > 0").select(F.col("pattern").alias("parent"), F.col("believed").alias("all_believed"), F.col("n").alias("all_n"))
        # Without belief in its parent a pattern has none either.
        two = held.where("parent is not null").join(ones, "parent").select("pattern", "believed", "n", "all_believed", "all_n")
        own = F.col("score")
        one = BACK_OFF * (F.col("all_believed") - own) / (F.col("all_n") - 1 + SHRINK)
        confidence = (F.col("believed") - own + SHRINK * one) / (F.col("n") - 1 + SHRINK)
        told = (
            graph.where("parent is not null and not seed").join(two, "pattern").join(scores.select("value", "score"), "value")
            .select("value", confidence.alias("confidence")).where(F.col("confidence") >= MIN_CONFIDENCE)
            .groupBy("value").agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("now"))
        )
        scores = materialize(
            scores.join(told, "value", "left").select("value", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("now", F.lit(0.0))).alias("score")),
            "pii-scores",
        )
    return scores


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, spans): spans (start, end, kind, value) of the fixed patterns, and of all means together."""
    prepare(docs.sparkSession)
    # A row number of its own tells rows apart that repeat an id; it is written, so it stays.
    found = materialize(
        docs.select(F.col(id_col).alias("id"), found_column(F.col(text_col)).alias("f"))
        .select("id", "f.base", "f.seen", F.monotonically_increasing_id().alias("row")),
        "pii-found",
    )
    seen = found.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    pairs = seen.select(F.explode("patterns").alias("p"), "value", "seed").select("p.*", "value", "seed")
    known = seen.groupBy("value").agg(F.max("seed").alias("seed"))  # a seed once is a seed everywhere
    edges = pairs.select("pattern", "parent", "value").distinct().join(known, "value")
    scores = score_graph(edges)
    new = scores.where(~F.col("seed") & (F.col("score") >= MIN_SCORE)).select("value")
    before = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    more = (
        seen.where(~F.col("seed")).join(new, "value")
        .withColumn("upto", F.max("end").over(before)).where("upto is null or end > upto")  # not inside another
        .groupBy("row").agg(F.collect_list(F.struct("start", "end", F.lit(KINDS.index("context")).alias("kind"), "value")).alias("more"))
    )
    spans = F.concat("base", F.coalesce("more", F.array().cast(SPANS)))
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"], s["value"]))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")),
    )
    return found.join(more, "row", "left").select("id", "base", ordered.alias("spans"))


def told(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_pii_bootstrap(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[number(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
