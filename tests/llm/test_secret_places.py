"""Spans of the models against a plain form of the method, and texts with very many matches."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from roadpulse.llm import secret_scan

SF = "/root/testdata/sf0.001"
ALPHABET = secret_scan.ALPHABET


@pytest.fixture(scope="module")
def samples(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    values = spark.createDataFrame([("Zx8Kq0vLmT3pYw7RbN2s",)], "value string")
    return secret_scan.labelled_samples(docs, values).cache()


def plain_spans(text, base, ratios, shortest):
    """Model spans of a text, character by character."""
    covered = [False] * len(text)
    for start, end in base:
        covered[start:end] = [True] * (end - start)
    blank = "".join(" " if c else x for c, x in zip(covered, text))
    size, limit = len(ALPHABET), secret_scan.MIN_RATIO

    def ratio(a, b):
        return ratios[ALPHABET.index(a) * size + ALPHABET.index(b)]

    def total(s):
        out = 0.0
        for a, b in zip(s, s[1:]):
            out += ratio(a, b)
        return out

    out = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", blank):
        run = m[0]
        if len(run) < shortest:
            continue
        found, acc, start, best, end = [], 0.0, 0, 0.0, 0
        for i in range(1, len(run)):
            acc += ratio(run[i - 1], run[i])
            if acc <= 0 or acc < best - limit:
                if best > limit:
                    found.append((start, end))
                acc, start, best, end = 0.0, i, 0.0, i
            elif acc > best:
                best, end = acc, i + 1
        if best > limit:
            found.append((start, end))
        for k, (a, b) in enumerate(found):
            low = found[k - 1][1] if k else 0
            a -= len(re.search("[A-Za-z0-9]*$", run[low:a])[0])
            if k == 0 and total(run[: a + 1]) > secret_scan.ORDINARY:
                a = 0
            if k == len(found) - 1:
                b += len(re.match("[A-Za-z0-9]*", run[b:])[0])
                if total(run[b - 1 :]) > secret_scan.ORDINARY:
                    b = len(run)
            out.append((m.start() + a, m.start() + b))
    return out


def test_model_spans_equal_plain_form(spark, samples):
    rnd = random.Random(5)
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789"

    def word():
        kind = rnd.randrange(8)
        if kind == 0:
            return "".join(rnd.choices(letters, k=rnd.randint(8, 40)))
        if kind == 1:
            return hashlib.sha256(str(rnd.random()).encode()).hexdigest()[: rnd.randint(10, 40)]
        if kind == 2:
            return "AKIA" + "".join(rnd.choices("ABCDEFGHXYZ0189", k=rnd.randint(10, 20)))
        if kind == 3:
            return "password=" + "".join(rnd.choices(letters, k=rnd.randint(6, 20)))
        return rnd.choice(["config", "user", "the", "größe", "value", "reader", "load", "-----"])

    texts = ["".join(word() + rnd.choice([" ", "_", "/", "=", "", ". "]) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ratios = secret_scan.train(samples)
    shortest, _ = secret_scan.bounds(ratios)
    told = ratios.first()["ratios"]
    n = 0
    for r in secret_scan.scan(df, samples=samples).collect():
        want = plain_spans(texts[r.id], [(s.start, s.end) for s in r.base], told, shortest)
        assert [(s.start, s.end) for s in r.spans if s.kind == 3] == want, texts[r.id]
        assert all(s.value == texts[r.id][s.start : s.end] for s in r.spans if s.kind != 0)
        n += len(want)
    assert n > 50


def test_texts_with_very_many_matches_stay_linear(spark, samples):
    sums = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(120_000)]
    manifest = "\n".join(f"{h}  file{i}.txt" for i, h in enumerate(sums))
    joined = "_".join(h[:40] + "_Zx8Kq0vLmT3pYw7RbN2s" for h in sums[:2000])  # one run with 2000 base spans
    df = spark.createDataFrame([(1, manifest), (2, joined)], "doc_id long, text string")
    t0 = time.monotonic()
    got = {r.id: r for r in secret_scan.scan(df, samples=samples).collect()}
    assert time.monotonic() - t0 < 150
    assert [(s.start, s.end) for s in got[1].spans] == [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{16,}", manifest)]
    assert len(got[2].base) == 2000 and sum(s.kind == 3 for s in got[2].spans) == 2000


def test_held_out_secrets_are_found(spark, samples):
    """Random strings of forms and contexts that no sample has; ordinary text beside them stays clean."""
    rnd = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    frames = ["export KEY {}", "see {} for it", "https://h.example/{}/x", "id:{};", "({})", "Bearer {}", "cfg/{}", "a {}\n"]
    rows = [(i, rnd.choice(frames).format("".join(rnd.choices(letters, k=rnd.choice([24, 32, 40]))))) for i in range(400)]
    plain = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("-page_id - 1 as doc_id", "regexp_replace(html, '<[^>]*>', ' ') as text")
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(plain)
    got = secret_scan.scan(df, samples=samples).selectExpr("id", "size(spans) > 0 as hit").collect()
    caught = sum(r.hit for r in got if r.id >= 0)
    false = sum(r.hit for r in got if r.id < 0)
    print(f"recall {caught / 400:.3f}, pages with a span {false} of {len(got) - 400}")
    assert caught >= 0.9 * 400
