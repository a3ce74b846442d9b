"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

All of it is DataFrame functions.  Matches with their places come from one pass per
pattern: ``\\G`` ties every match to the end of the one before, and the text skipped in
between is part of it, so the lengths of the pieces add up to code point places and a
text without a match is read once.

Two character Markov models are counted from labelled samples, one of random strings
and one of ordinary identifiers.  The log-likelihood ratio of character pairs is summed along every run of
identifier characters outside the matches; a stretch of a run whose sum is above a
threshold is a secret too, whatever ordinary text it is joined to.  How short a run may
be follows from the threshold and the largest ratio.  The table of ratios is bounded by
the alphabet's square.

Defined results: null and empty texts have no spans; equal rows get equal results;
without samples of a class its model is uniform; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize, prepare, table

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs of a class and a minimum length: the same spans as whole runs filtered by length.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_VALUE = 12
KINDS = ["assign", "access", "hex", "markov"]
SPANS = "array<struct<start:int,end:int,kind:int,value:string>>"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CHARACTER = "[A-Za-z0-9+/_=-]"
MIN_RATIO = 8.0  # natural logarithm of the likelihood ratio
ORDINARY = -MIN_RATIO / 2  # of what is left at a run's end: below, it is cut from the secret beside it
LONG_RUN = 200  # characters from which on a run is summed without a look at its pairs first
SOURCE_PAIRS = 20_000  # what the counts of a source of samples are scaled to
SMOOTHING = 0.5  # added to each pair's count
VOCABULARY = "word_bpe_49k.json"
SAMPLE_DOCS = 2000  # documents whose words are the sample of ordinary identifiers
SAMPLE_SECRETS = 2000  # values found by the patterns, and uniform strings, in the sample of random ones


def running(values: Column, zero: Column, step) -> Column:
    """Array of the running states of a fold, one for each element.

    Blocks of about the square root of the array's size are folded one after the other, so that no state
    array is copied more than twice that many times.
    """
    none = F.array().cast("array<int>")

    def bound(x, step_of):  # a one-element array, so that the value is computed once
        return F.transform(F.array(x), step_of)[0]

    def next_state(acc, x):
        return bound(step(acc["at"], x), lambda now: F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out")))

    def next_block(acc, block):
        inner = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("out")), next_state)
        return bound(inner, lambda s: F.struct(s["at"].alias("at"), F.concat(acc["out"], F.array(s["out"])).alias("out")))

    def folded(held):
        size = F.size(held)

        def in_blocks(per):
            blocks = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / per).cast("int")), lambda b: F.slice(held, b * per + 1, per))
            start = F.struct(zero.alias("at"), F.array().cast("array<array<int>>").alias("out"))
            return F.aggregate(blocks, start, next_block, lambda acc: F.flatten(acc["out"]))

        return F.when(size > 0, bound(F.ceil(F.sqrt(size)).cast("int"), in_blocks)).otherwise(none)

    return bound(values, folded)


def found_spans(text: Column, pattern: str | Column, kind: int, min_value: int | None = None) -> Column:
    """Array of (start, end, kind, value) of a pattern's matches; value is its first group, or else the match."""
    whole = F.concat(F.lit(r"\G(?s:.*?)("), F.lit(pattern), F.lit(")"))

    def span(piece, end):
        match = F.call_function("regexp_extract", piece, whole, F.lit(1))
        value = F.call_function("regexp_extract", piece, whole, F.lit(2)) if min_value is not None else match
        return F.struct((end - F.length(match)).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), value.alias("value"))

    def placed(pieces):
        ends = running(F.transform(pieces, F.length), F.lit(0), lambda at, n: at + n)
        return F.zip_with(pieces, ends, span)

    # Bound by a one-element array, so that the matches are looked for once.
    spans = F.transform(F.array(F.regexp_extract_all(text, whole, F.lit(0))), placed)[0]
    if min_value is not None:
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= min_value)
    return F.coalesce(spans, F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    return in_order(F.concat(found_spans(text, ASSIGN, 0, MIN_VALUE), found_spans(text, ACCESS, 1), found_spans(text, HEX, 2)))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind, then end."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))


def pair_numbers(run: Column) -> Column:
    """Numbers from 1 of a run's character pairs in the table of ratios."""
    chars = F.transform(F.split(run, ""), lambda c: F.position(c, F.lit(ALPHABET)))
    chars = F.filter(chars, lambda p: p > 0)
    n = F.size(chars)
    pairs = F.arrays_zip(F.slice(chars, 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice(chars, 2, F.greatest(n - 1, F.lit(0))).alias("b"))
    return F.transform(pairs, lambda p: (p["a"] - 1) * len(ALPHABET) + p["b"])


def train(samples: DataFrame) -> DataFrame:
    """One row with ``ratios``: for each character pair log P(second | first) of random less that of ordinary strings.

    ``samples`` has strings ``value``, a boolean ``random`` and the name of their ``source``; the sources of a
    class weigh alike, however many strings they have.  Characters outside the alphabet are left out.
    """
    size = len(ALPHABET)
    pairs = (
        samples.select("random", "source", F.explode(pair_numbers(F.col("value"))).alias("pair"))
        .groupBy("random", "source", "pair").agg(F.count("*").alias("n"))
    )
    totals = pairs.groupBy("random", "source").agg(F.sum("n").alias("total"))
    counts = (
        pairs.join(totals, ["random", "source"]).withColumn("n", F.col("n") * SOURCE_PAIRS / F.col("total"))
        .groupBy("pair").agg(F.sum(F.when(F.col("random"), F.col("n"))).alias("r"), F.sum(F.when(~F.col("random"), F.col("n"))).alias("o"))
    )
    grid = samples.sparkSession.range(1, size * size + 1).withColumnRenamed("id", "pair")
    full = grid.join(counts, "pair", "left").fillna(0.0).withColumn("first", F.floor((F.col("pair") - 1) / size))
    firsts = full.groupBy("first").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))

    def log_p(n, total):
        return F.log((F.col(n) + SMOOTHING) / (F.col(total) + size * SMOOTHING))

    ratio = full.join(firsts, "first").select("pair", (log_p("r", "all_r") - log_p("o", "all_o")).alias("ratio"))
    return ratio.agg(F.transform(F.sort_array(F.collect_list(F.struct("pair", "ratio"))), lambda x: x["ratio"]).alias("ratios"))


def score(run: Column, ratios: Column) -> Column:
    """Log-likelihood ratio of a run of identifier characters."""
    return F.aggregate(pair_numbers(run), F.lit(0.0), lambda acc, p: acc + F.element_at(ratios, p))


def bounds(ratios: DataFrame) -> tuple[int, str]:
    """Characters of the shortest run whose ratios may add up to more than MIN_RATIO, and a regex of all such runs.

    A sum above it takes a number of pairs with positive ratios; the regex, a tree over their first characters, counts them.
    """
    told = ratios.first()["ratios"]
    if max(told) <= 0:
        return 1 << 30, "(?!)"
    need, size = int(MIN_RATIO / max(told)) + 1, len(ALPHABET)
    seconds = {a: [b for j, b in enumerate(ALPHABET) if told[i * size + j] > 0] for i, a in enumerate(ALPHABET)}

    def some(chars):
        return "[" + "".join(c if c.isalnum() else "\\" + c for c in chars) + "]"

    def tree(firsts):
        if len(firsts) == 1:
            return some(firsts) + some(seconds[firsts[0]])
        half = len(firsts) // 2
        return f"(?:(?={some(firsts[:half])}){tree(firsts[:half])}|{tree(firsts[half:])})"

    pair = tree(sorted((a for a in ALPHABET if seconds[a]), key=lambda a: (not a.islower(), a)))
    return need + 1, f"^(?:(?:(?!{pair}).)*+.){{{need}}}"


def best_sum(run: Column, ratios: Column) -> Column:
    """Largest log-likelihood ratio of a stretch of a run."""

    def step(acc, p):
        now = F.greatest(acc["sum"] + F.element_at(ratios, p), F.lit(0.0))
        return F.struct(now.alias("sum"), F.greatest(acc["best"], now).alias("best"))

    return F.aggregate(pair_numbers(run), F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")), step, lambda acc: acc["best"])


def stretches(run: Column, ratios: Column) -> Column:
    """Array of (start, end) of a run's stretches above MIN_RATIO: each ends at its largest sum, once the sum has fallen
    to nothing or by MIN_RATIO."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def emitted(acc):
        own = F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))
        return F.when(acc["best"] > MIN_RATIO, F.concat(acc["out"], own)).otherwise(acc["out"])

    def state(at, total, start, best, end, out):
        return F.struct(at.alias("at"), total.alias("sum"), start.alias("start"), best.alias("best"), end.alias("end"), out.alias("out"))

    def step(acc, p):
        at, total = acc["at"] + 1, acc["sum"] + F.element_at(ratios, p)
        over = (total <= 0) | (total < acc["best"] - MIN_RATIO)
        more = total > acc["best"]
        return F.when(over, state(at, F.lit(0.0), at, F.lit(0.0), at, emitted(acc))).otherwise(
            state(at, total, acc["start"], F.greatest(acc["best"], total), F.when(more, at + 1).otherwise(acc["end"]), acc["out"])
        )

    zero = F.lit(0)
    return F.aggregate(pair_numbers(run), state(zero, F.lit(0.0), zero, F.lit(0.0), zero, none), step, emitted)


def widened(run: Column, found: Column, ratios: Column) -> Column:
    """Stretches to the ends of their words, and to the run's ends where what is left there is not clearly ordinary."""

    def unclear(start, length):
        return score(F.substr(run, start + 1, length), ratios) > ORDINARY

    def wide(s, i):
        low = F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(0)
        word = F.length(F.regexp_extract(F.reverse(F.substr(run, low + 1, s["start"] - low)), "^[A-Za-z0-9]*", 0))
        start = s["start"] - word
        start = F.when((i == 0) & unclear(F.lit(0), start + 1), 0).otherwise(start)
        word = F.length(F.regexp_extract(F.substr(run, s["end"] + 1), "^[A-Za-z0-9]*", 0))
        end = s["end"] + word
        end = F.when(unclear(end - 1, F.length(run)), F.length(run)).otherwise(end)
        return F.struct(start.alias("start"), F.when(i == F.size(found) - 1, end).otherwise(s["end"]).alias("end"))

    return F.transform(found, wide)


def scored_runs(text: Column, base: Column, ratios: Column, shortest: int, likely: str) -> Column:
    """A text's distinct runs that have a stretch above MIN_RATIO, less those that are an access or hex span wherever they stand."""
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(f"{CHARACTER}{{{shortest},}}"), F.lit(0)))
    runs = F.array_except(runs, F.transform(F.filter(base, lambda b: b["kind"] > 0), lambda b: b["value"]))
    runs = F.filter(runs, lambda x: (F.length(x) > LONG_RUN) | x.rlike(likely))
    return F.filter(runs, lambda x: best_sum(x, ratios) > MIN_RATIO)


def outside(place: Column, spans: Column, reach: Column, shortest: int) -> Column:
    """Parts (start, value) of a place of ``shortest`` characters or more before, between and after ``spans``, those that start in it
    or later, in order; ``reach`` is the end of what earlier spans cover."""

    def cut(reaches):
        # The part before each span starts where all spans before it end; the last part ends with the place.
        ends = F.concat(F.transform(spans, lambda s: F.least(s["start"], place["end"])), F.array(place["end"]))
        gaps = F.zip_with(F.concat(F.array(F.greatest(reach, place["start"])), reaches), ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))
        return F.filter(gaps, lambda g: g["end"] - g["start"] >= shortest)

    reaches = running(F.transform(spans, lambda s: s["end"]), F.greatest(reach, place["start"]), lambda at, end: F.greatest(at, end))
    gaps = F.transform(F.array(reaches), cut)[0]

    def valued(chars):
        return F.transform(gaps, lambda g: F.struct(
            g["start"].alias("start"), F.array_join(F.slice(chars, g["start"] - place["start"] + 1, g["end"] - g["start"]), "").alias("value")))

    return F.transform(F.array(F.split(place["value"], "")), valued)[0]


def model_spans(text: Column, base: Column, runs: Column, ratios: Column, shortest: int, likely: str) -> Column:
    """Spans of the stretches that the models take for secrets, in the parts outside the base spans of the runs as long as
    the shortest of ``runs``.

    Places and base spans are merged by start, so each place meets only the base spans that start before the next one.
    """
    least = F.array_min(F.transform(runs, F.length)).cast("string")
    # A stretch outside the base spans is a stretch of the whole run too, so a run in no ``runs`` would give none.
    places = F.filter(
        found_spans(text, F.concat(F.lit(f"{CHARACTER}{{"), least, F.lit(",}")), 3),
        lambda r: (F.length(r["value"]) > LONG_RUN) | r["value"].rlike(likely),
    )

    def event(s, is_base):
        return F.struct(s["start"].alias("start"), F.lit(is_base).alias("base"), s["end"].alias("end"), s["value"].alias("value"))

    def inside(part):
        def span(s):
            start = part["start"] + s["start"]
            value = F.substr(part["value"], s["start"] + 1, s["end"] - s["start"])
            return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), F.lit(3).alias("kind"), value.alias("value"))

        return F.transform(widened(part["value"], stretches(part["value"], ratios), ratios), span)

    def merged(events):
        before = running(F.transform(events, lambda e: e["base"]), F.lit(0), lambda n, one: n + one)
        reach = running(F.transform(events, lambda e: F.when(e["base"] == 1, e["end"]).otherwise(0)), F.lit(0), lambda at, end: F.greatest(at, end))
        told = F.filter(F.arrays_zip(events.alias("event"), before.alias("before"), reach.alias("reach")), lambda e: e["event"]["base"] == 0)

        def placed(own):
            def parts(e, i):
                upto = F.when(i + 1 < F.size(own), F.get(own, i + 1)["before"]).otherwise(F.size(base))
                spans = F.slice(base, e["before"] + 1, upto - e["before"])
                return F.flatten(F.transform(outside(e["event"], spans, e["reach"], shortest), inside))

            return F.flatten(F.transform(own, parts))

        return F.transform(F.array(told), placed)[0]

    events = F.sort_array(F.concat(F.transform(places, lambda s: event(s, 0)), F.transform(base, lambda s: event(s, 1))))
    return F.when(F.size(runs) > 0, F.transform(F.array(events), merged)[0])


def ordinary_identifiers(spark: SparkSession, vocabulary: str | None = None) -> DataFrame:
    """Labelled ordinary identifiers: the words of a public vocabulary file, alone and joined as in code and paths.

    Bounded by the vocabulary; ``vocabulary`` is the path of a tokenizer's JSON file.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, encoding="utf-8") as f:
        told = json.load(f)["model"]
    suffix = told["end_of_word_suffix"] or ""
    words = [p.removesuffix(suffix) for p in told["vocab"] if p.endswith(suffix)]
    words = [w for w in words if len(w) > 2 and w.isascii() and w.isalpha()]
    values = list(words)
    for i, (a, b, c) in enumerate(zip(words, words[1:], words[2:])):
        forms = [f"{a}_{b}", f"{a}{b.title()}", f"{a.upper()}_{b.upper()}", f"{a}/{b}/{c}", f"{a}-{b}",
                 f"{a.title()}{b.title()}{c.title()}", f"{a}{b}", a.upper(), f"{a}_{b}_{i % 100}", f"{a}={b}"]
        values.append(forms[i % len(forms)])
    values += ["-" * 40, "=" * 40, "_" * 40, "+-" * 20] * 8
    return spark.createDataFrame([(v,) for v in values], "value string")


def labelled_samples(docs: DataFrame, values: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     vocabulary: str | None = None) -> DataFrame:
    """Samples (value, random, source): pattern matches and uniform strings are random; identifiers made of a
    vocabulary, and words of the texts outside the matches, are ordinary.

    Bounded by SAMPLE_DOCS and SAMPLE_SECRETS; rows are taken in order of a digest.
    """
    spark = docs.sparkSession
    # The digests are drawn first, so that only the drawn texts are moved, each once.
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("draw"), F.col(text_col).alias("text"))
    drawn_docs = keyed.select("draw").distinct().orderBy("draw").limit(SAMPLE_DOCS)
    some = keyed.join(F.broadcast(drawn_docs), "draw", "left_semi").groupBy("draw").agg(F.min("text").alias("text"))
    plain = F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    words = F.regexp_extract_all(plain, F.lit("[A-Za-z0-9+/_=-]{2,}"), F.lit(0))
    drawn = F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256)))
    parts = [
        (some.select(F.explode(words).alias("value")), False, "corpus"),
        (ordinary_identifiers(spark, vocabulary), False, "vocabulary"),
        (values.distinct().orderBy(F.xxhash64("value"), "value").limit(SAMPLE_SECRETS), True, "matches"),
        (spark.range(SAMPLE_SECRETS).select(F.regexp_replace(drawn, "=", "").alias("value")), True, "uniform"),
    ]
    return reduce(DataFrame.unionByName, [df.select("value", F.lit(r).alias("random"), F.lit(n).alias("source")) for df, r, n in parts])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: DataFrame | None = None) -> DataFrame:
    """Rows (id, base, spans): spans (start, end, kind, value) of the patterns, and of patterns and models together.

    Without ``samples`` (value, random, source) the models are trained on a bounded sample of the documents themselves.
    """
    prepare(docs.sparkSession)
    text = F.col(text_col)
    if samples is None:
        values = materialize(docs.select(F.explode(base_spans(text)["value"]).alias("value")).distinct(), "secret-values")
        samples = labelled_samples(docs.select(id_col, text_col), values, id_col, text_col)
    ratios = materialize(train(samples), "secret-model")
    shortest, likely = bounds(ratios)
    held = docs.select(F.col(id_col).alias("id"), text.alias("text"), base_spans(text).alias("base")).withColumn("ratios", ratios.scalar())
    held = held.withColumn("runs", scored_runs(F.col("text"), F.col("base"), F.col("ratios"), shortest, likely))
    more = model_spans(F.col("text"), F.col("base"), F.col("runs"), F.col("ratios"), shortest, likely)
    spans = in_order(F.concat("base", F.coalesce(more, F.array().cast(SPANS))))
    return materialize(held.select("id", "base", spans.alias("spans")), "secret-spans")


def told(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
