"""Line dedup: repeated runs of lines, found by prefix doubling over line-ID sequences.

A document is its sequence of lines that hold a word.  Lines occurring once in the
corpus can be in no repeat, so only stretches of repeated lines go on.  Over those,
prefix doubling names the runs of 1, 2, 4, ... lines starting at each position: the
name of 2k lines is made from the names of k lines at a position and k lines further
on.  Positions with the same name share a prefix of that many lines, which is one
interval of the suffix array; the name of a run of any length m comes from two
overlapping names of the largest power of two up to m.  (Intervals need equality of
prefixes only, so names are digests and no global sort is made.)

A run counts from ``min_words`` words on.  From each position the shortest run of
that many words is taken both forwards and backwards; runs of the same name form an
interval, its first occurrence in order of (id, text digest, line) stays, and the lines
of all later ones are deleted.  Those shortest runs together cover exactly the lines
of the maximal repeated runs: a line of a maximal run with an earlier copy is in the
backward run that ends at it, or in the forward run from the maximal run's start.

All work is DataFrame functions; hot lines are counted with partial aggregates, and
nothing is gathered per line, only per document.

Defined results: null texts stay null and empty texts empty, both without lines; lines
without a word are never counted nor deleted; rows with equal id and text are one
document and lose the same lines; rows with one id but different texts are different
documents, in order of their digests; null ids come last; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import fresh, materialize, prepare, table

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]"
SPACES = r"[\x20\x09-\x0D]+"


def _digest(text):
    return F.unhex(F.md5(text.cast("binary")))


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, tkey, at, line, name, words): the lines that hold a word, numbered from 0 in each document (at) and its text (line)."""
    numbered = F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("text")))
    wordy = F.filter(numbered, lambda x: x["text"].rlike(WORD))
    held = docs.select(F.col(id_col).alias("id"), _digest(F.col(text_col)).alias("tkey"), F.posexplode(wordy).alias("at", "x"))
    words = F.size(F.filter(F.split("x.text", SPACES), lambda w: w != ""))
    return held.select("id", "tkey", "at", "x.line", _digest(F.col("x.text")).alias("name"), words.alias("words"))


def _names(lines: DataFrame, min_words: int) -> tuple[DataFrame, list[int]]:
    """Repeated lines with the names of the runs of 1, 2, 4, ... lines from each on, and those scales."""
    # Written, so that the join below is between two plain exchanges and a hot line's rows can be split.
    often = materialize(lines.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "line-repeats")
    repeated = lines.join(often, "name", "left_semi")
    in_doc = Window.partitionBy("id", "tkey").orderBy("at")
    rows = (
        repeated.withColumn("stretch", F.col("at") - F.dense_rank().over(in_doc))
        .dropDuplicates(["id", "tkey", "stretch", "at"])  # rows that repeat an id and text
        .select("id", "tkey", "stretch", "at", "line", "words", F.col("name").alias("n1"))
    )
    along = Window.partitionBy("id", "tkey", "stretch").orderBy("at")
    scales = [1]
    # Every line has a word, so a shortest run is at most min_words lines long.
    while 2 * scales[-1] <= min_words:
        k = scales[-1]
        after = F.lead(f"n{k}", k).over(along)
        rows = rows.withColumn(f"n{2 * k}", F.when(after.isNotNull(), _digest(F.concat(F.col(f"n{k}"), after))))
        scales.append(2 * k)
    rows = rows.withColumn("ahead", F.collect_list("words").over(along.rowsBetween(0, min_words - 1)))
    rows = rows.withColumn("behind", F.reverse(F.collect_list("words").over(along.rowsBetween(1 - min_words, 0))))
    names = rows.select(
        "id", "tkey", "stretch", "at", "line", *[f"n{k}" for k in scales],
        _shortest("ahead", min_words).alias("m_ahead"), _shortest("behind", min_words).alias("m_behind"),
    )
    return names, scales


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (id, tkey, line) of the lines to delete: those in a later copy of a run of ``min_words`` words."""
    prepare(docs.sparkSession)
    names, scales = _names(materialize(line_table(docs, id_col, text_col), "lines"), min_words)
    names = materialize(names, "line-names")
    ahead = F.struct(F.col("at").alias("start"), F.col("m_ahead").alias("m"))
    behind = F.struct((F.col("at") - F.col("m_behind") + 1).alias("start"), F.col("m_behind").alias("m"))
    runs = (
        names.select("id", "tkey", F.explode(F.array(ahead, behind)).alias("r"))
        .select("id", "tkey", "r.start", "r.m").where("m is not null").distinct()
    )
    # The name of m lines: the names at both of its ends of the largest scale that fits.
    scale = reduce(lambda c, k: F.when(F.col("m") >= k, k).otherwise(c), scales, F.lit(1))
    ends = runs.withColumn("scale", scale).withColumn("at", F.explode(F.array("start", F.col("start") + F.col("m") - F.col("scale"))))
    a, b = ends.alias("a"), names.alias("b")
    named = (
        a.join(b, F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tkey") == F.col("b.tkey")) & (F.col("a.at") == F.col("b.at")))
        .select("a.id", "a.tkey", "start", "m", "a.at", reduce(lambda c, k: F.when(F.col("scale") == k, F.col(f"n{k}")).otherwise(c), scales, F.col("n1")).alias("name"))
        .groupBy("id", "tkey", "start", "m")
        .agg(F.min_by("name", "at").alias("head"), F.max_by("name", "at").alias("tail"))
        .select(
            "id", "tkey", "start", "m",
            _digest(F.concat("head", "tail", F.col("m").cast("string").cast("binary"))).alias("run"),
            F.struct(F.col("id").isNull().alias("no_id"), "id", "tkey", "start").alias("place"),
        )
    )
    # An interval of positions that share the run: the first one stays.  (Both sides written: a hot run can be split.)
    named = materialize(named, "line-runs")
    first = named.groupBy("run").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = named.join(materialize(first, "line-firsts"), "run").where(F.col("place") > F.col("first"))
    covered = later.select("id", "tkey", F.explode(F.sequence("start", F.col("start") + F.col("m") - 1)).alias("at")).distinct().alias("c")
    same = F.col("c.id").eqNullSafe(F.col("b.id")) & (F.col("c.tkey") == F.col("b.tkey")) & (F.col("c.at") == F.col("b.at"))
    return covered.join(b, same).select("b.id", "b.tkey", "b.line")


def _shortest(sizes: str, min_words: int):
    """How many of the leading sizes reach ``min_words`` together; null if all do not."""
    reached = F.aggregate(
        F.col(sizes),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n")),
        lambda acc, w: F.when(acc["sum"] >= min_words, acc).otherwise(
            F.struct((acc["sum"] + w).alias("sum"), (acc["n"] + 1).alias("n"))
        ),
        lambda acc: F.when(acc["sum"] >= min_words, acc["n"]),
    )
    return reached


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the text less its deleted lines, and last an array of their numbers (from 0, all lines counted).

    ``drop_emptied`` leaves out the rows that lost every line with a word.
    """
    runs = repeated_runs(docs, id_col, text_col, min_words).groupBy("id", "tkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    key, gone, parts = (fresh(docs, s) for s in ("key", "deleted", "parts"))
    d, r = docs.withColumn(key, _digest(F.col(text_col))).alias("d"), runs.alias("r")
    held = d.join(r, F.col(f"d.{id_col}").eqNullSafe(F.col("r.id")) & (F.col(f"d.{key}") == F.col("r.tkey")), "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], F.col("r.lines").alias(gone)
    )
    lines = F.split(F.col(text_col), "\n", -1)
    if drop_emptied:  # told by columns of the join, so that the filter repeats none of the rewriting below
        held = held.where(F.col(gone).isNull() | (F.size(gone) < F.size(F.filter(lines, lambda x: x.rlike(WORD)))))
    held = held.withColumn(parts, F.when(F.col(gone).isNotNull(), lines))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    rest = F.array_join(F.transform(stay, lambda i: F.element_at(F.col(parts), i + 1)), "\n")
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(rest)
    return held.select(
        *[(text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns],
        F.coalesce(F.col(gone), F.array().cast("array<int>")).alias(gone),
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the texts less later copies; documents that lost every line with a word are dropped."""
    return dedup_lines(docs, id_col, text_col, min_words, drop_emptied=True).select(docs.columns)


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedup_lines(docs)
    return found.select(
        "doc_id",
        F.size("_deleted").cast("long").alias("n_deleted"),
        F.array_join(F.col("_deleted").cast("array<string>"), ",").alias("deleted_lines"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


# Brute force over all lines: the runs are compared as text, from every line both ways.
OP8_SQL = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
  FROM documents),
wordy AS (
  SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos,
    len(regexp_extract_all(line, '[^ 	-
]+')) AS words
  FROM split WHERE regexp_matches(line, '[^ 	-
]')),
ahead AS (
  SELECT a.doc_id, a.pos, b.pos AS upto, sum(b.words) OVER (PARTITION BY a.doc_id, a.pos ORDER BY b.pos) AS total
  FROM wordy a JOIN wordy b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + 49),
behind AS (
  SELECT a.doc_id, a.pos AS upto, b.pos, sum(b.words) OVER (PARTITION BY a.doc_id, a.pos ORDER BY b.pos DESC) AS total
  FROM wordy a JOIN wordy b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - 49 AND a.pos),
runs AS (
  SELECT doc_id, pos, min(upto) AS upto FROM ahead WHERE total >= 50 GROUP BY ALL
  UNION
  SELECT doc_id, max(pos) AS pos, upto FROM behind WHERE total >= 50 GROUP BY doc_id, upto),
texts AS (
  SELECT r.doc_id, r.pos, r.upto, string_agg(w.line, chr(10) ORDER BY w.pos) AS run
  FROM runs r JOIN wordy w ON w.doc_id = r.doc_id AND w.pos BETWEEN r.pos AND r.upto GROUP BY ALL),
later AS (
  SELECT doc_id, pos, upto FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM texts) WHERE nth > 1),
gone AS (
  SELECT DISTINCT w.doc_id, w.no FROM later l JOIN wordy w ON w.doc_id = l.doc_id AND w.pos BETWEEN l.pos AND l.upto),
rest AS (
  SELECT s.doc_id, count(g.no) AS n_deleted, coalesce(string_agg(g.no::VARCHAR, ',' ORDER BY g.no), '') AS deleted_lines,
    coalesce(string_agg(CASE WHEN g.no IS NULL THEN s.line END, chr(10) ORDER BY s.no), '') AS kept
  FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.no = s.no GROUP BY s.doc_id)
SELECT d.doc_id, coalesce(n_deleted, 0) AS n_deleted, coalesce(deleted_lines, '') AS deleted_lines,
  coalesce(length(kept), 0) AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id
"""
