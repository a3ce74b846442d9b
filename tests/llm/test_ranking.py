"""Ranked lexical search, hard negatives and token counts against brute force, SQL and the tokenizer's library."""

import collections
import math
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import hard_negatives, lexical_rank, token_counts
from roadpulse.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string"
ODD = [(1, "a b c d e\n" * 40), (2, None), (None, "null id, some WORDS of text"), (3, ""), (4, "x"), (4, "x"), (5, " \n\t\n"),
       (6, "long " * 30000), (7, "a b c d e\n" * 40), (8, "Ä ä ÀB-àb \x00é\U0001f600z")]
CLASH = ", id int, n long, terms string, score string, rank int"


def odd(spark):
    return spark.createDataFrame([(i, t, 9, 1, "kept", "s", -1) for i, t in ODD], KINDS + CLASH)


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_hard_negatives"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS FROM '{SF}/{f}'")
    got = queries()[name](spark, SF).toPandas()
    want = con.sql(oracle_sql()[name]).df()[list(got.columns)]
    assert len(got) and sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


# --- ranked lexical search


def _rank(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    held = [(i, collections.Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(split(t))
    out = []
    for item, own in asked.items():
        found = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "a b WORDS"), (1, "x"), (2, None), (3, ""), (None, "long ä"), (5, "é\U0001f600z nowhere"), (5, "é\U0001f600z nowhere"), (6, " - ")]


@pytest.mark.parametrize("block_bytes", [lexical_rank.BLOCK_BYTES, 40])
def test_rank_of_odd_rows_in_one_and_many_blocks(spark, block_bytes):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, no int")
    got = lexical_rank.rank_documents(odd(spark), items, k=3, block_bytes=block_bytes)
    assert got.columns == ["item", "rank", "id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _rank(ODD, ITEMS, 3)


def test_rank_narrow_tiles_ties_and_string_ids(spark, monkeypatch):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))) for i in range(400)] + [(i, "a b") for i in range(400, 900)]
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(4))) for i in range(9)]
    monkeypatch.setattr(lexical_rank, "ITEM_TILE", 2)
    monkeypatch.setattr(lexical_rank, "TERM_TILE", 3)
    di = spark.createDataFrame(docs, KINDS).repartition(5)
    ii = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_rank.rank_documents(di, ii, k=20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _rank(docs, items, 20)
    named = lexical_rank.rank_documents(di.withColumn("doc_id", F.format_string("d%04d", "doc_id")), ii, k=20)
    assert sorted(((r[0], r[1], int(r[2][1:]), r[3]) for r in named.collect()), key=str) == _rank(docs, items, 20)


def test_rank_of_empty_tables(spark):
    none, items = spark.createDataFrame([], KINDS), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_rank.rank_documents(none, items).collect() == []
    assert lexical_rank.rank_documents(odd(spark), items.limit(0)).collect() == []


# --- hard negatives


def _mine(rows, every, n_pos=5, n_neg=3):
    out = []
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))  # noqa: E731  (shorter vectors end in zeros)
    for a, lab, v in {(i, l, tuple(v)) for i, l, v in rows if i % every == 0}:
        others = sorted((-dot(v, w), i, l) for i, l, w in rows if i != a)
        for p, i, _ in [x for x in others if x[2] == lab][:n_pos]:
            fit = [x for x in others if x[2] != lab and -50 * p <= -100 * x[0] <= -95 * p][:n_neg]
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("scale,anchor_block", [(40, 4096), (40, 7), (50_000_000, 4096), (1, 4096)])
def test_mining_equals_brute_force(spark, scale, anchor_block):
    rng = np.random.default_rng(scale)
    centres = rng.normal(size=(4, 12)) * scale
    rows = []
    for i in range(600):
        lab = int(rng.integers(4))
        rows.append((i, lab, [int(x) for x in np.floor(centres[lab] + rng.normal(size=12) * scale)][: 12 if i % 11 else 5]))
    rows += [(i, 1, rows[3][2]) for i in range(600, 700)]  # many equal vectors
    rows += [rows[20], rows[40], (30, 2, rows[31][2]), (33, 0, [0] * 12), (44, 0, [])]
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(6)
    got = hard_negatives.mine(df, F.col("id") % 20 == 0, anchor_block=anchor_block)
    found = collections.Counter(tuple(r) for r in got.collect())
    want = collections.Counter(_mine(rows, 20))
    assert found.keys() == want.keys() and len(want) > 50


def test_mining_leaves_out_null_and_infinite_rows(spark, tmp_path):
    v = [0.5, -0.25]
    rows = [(0, v, 1), (14, v, 0), (2, [0.5, -0.2], 1), (3, [0.4, -0.25], 2), (4, None, 1), (5, [0.5, None], 1), (None, v, 1),
            (6, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 2), (9, v, None), (50, v, 9), (21, v, 8)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id long, embedding array<float>, label int, id int, score string")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries()["op12_hard_negatives"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.sql(oracle_sql()["op12_hard_negatives"]).df()[list(got.columns)]
    assert len(got) and sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    none = spark.createDataFrame([], "id long, label int, vector array<int>")
    assert hard_negatives.mine(none, F.lit(True)).collect() == []
    assert hard_negatives.mine(df.select("vec_id", "label", F.array(F.lit(1)).alias("vector")), F.lit(False), id_col="vec_id").collect() == []
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(df.select("vec_id", "label", F.array(F.lit(2**62)).alias("vector")), F.lit(True), id_col="vec_id")


# --- token counts


def _texts():
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = ["a" * 5000, "ab" * 3000, " " * 3001, "=-" * 2500, "<|endoftext|>" * 3 + "x<|endoftext|", "'s 's're can't I'LL 've", "\r\n\n \t x"]
    out += ["".join(rng.choice(a) for _ in range(k)) for a in (letters, "aab", "etaoin", " \n\t-=*", "ÃÂ") for k in (9, 150, 1500, 9000)]
    spans = [(32, 127), (160, 0x600), (0x3040, 0x9FFF), (0x1F300, 0x1F9FF), (0x10000, 0x30000), (0x2080, 0x20A0)]
    out += ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(200)) for _ in range(60)]
    return out


@pytest.mark.parametrize("long,part", [(token_counts.LONG, token_counts.PART_CHARS), (4, 300)])
def test_token_counts_equal_the_library(spark, monkeypatch, long, part):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_counts, "LONG", long)
    monkeypatch.setattr(token_counts, "PART_CHARS", part)
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 1000)
    rows = ODD + [(100 + i, t) for i, t in enumerate(_texts())]
    lib = Tokenizer.from_str(token_counts.tokenizer_text())
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    got = token_counts.token_counts(spark.createDataFrame([(i, t, 1, "x") for i, t in rows], KINDS + ", n_bytes int, id string").repartition(3))
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert token_counts.token_counts(spark.createDataFrame([], KINDS)).collect() == []


def test_token_counts_of_the_table(spark):
    import pandas as pd
    from tokenizers import Tokenizer

    docs = pd.read_parquet(f"{SF}/documents.parquet")
    lib = Tokenizer.from_str(token_counts.tokenizer_text())
    got = {r.doc_id: r for r in queries()["op13_token_counts"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t in zip(docs.doc_id, docs.text):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].over_limit, got[i].n_bytes) == (n, n > 512, len((t or "").encode()))


def test_splitter_agrees_with_the_library_on_characters():
    from tokenizers import Tokenizer

    spec = token_counts.tokenizer_text()
    pre, split = Tokenizer.from_str(spec).pre_tokenizer, token_counts.Splitter(spec)
    for c in [*range(0x3000), *range(0x3000, 0x110000, 37)]:
        if not 0xD800 <= c < 0xE000:
            s = f"a{chr(c)}a1{chr(c)}1.{chr(c)}. {chr(c)}  {chr(c)}{chr(c)} "
            assert split._words(s) == [s[a:b] for _, (a, b) in pre.pre_tokenize_str(s)], hex(c)
