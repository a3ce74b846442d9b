"""Words around a value are found whatever their length and distance."""

import random

import regex

from roadpulse.llm import pii


def _plain(text, start, end):
    mark = lambda w: w.strip(".,;!?\"'").lower() if len(w) <= pii.LONG_WORD else "\N{HORIZONTAL ELLIPSIS}"
    first, left = (["^", "^"] + [mark(w) for w in text[:start].split()[-2:]])[-2:]
    after = text[end:].split()
    right = mark(after[0]) if after else "$"
    return [(f"{first} {left} _", f"{left} _"), (f"{left} _ {right}", f"_ {right}"), (f"{left} _", None), (f"_ {right}", None)]


def _spans(finder, text):
    words = [m.span() for m in finder.words(text)]
    return [w[0] for w in words], [w[1] for w in words]


def test_contexts_equal_plain_splitting():
    rng, finder = random.Random(3), pii.Finder()
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(1, 9)):
            parts += [rng.choice(["call", "my", "Cell:", "x" * rng.choice([3, 64, 65, 300]), "AB1234567", "(12345678)", "tel:12345678", "9876543,"]),
                      " " * rng.choice([1, 2, 90]) + rng.choice(["", "\n"])]
        text = "".join(parts)
        for m in regex.finditer(r"[A-Z]*[0-9]{7,}", text):
            assert finder.patterns(text, *m.span(), *_spans(finder, text)) == _plain(text, *m.span())


def test_wide_spaces_and_long_words():
    finder = pii.Finder()
    text = "please call" + " " * 90 + "12345678" + " " * 45 + "today"
    at = text.index("1")
    assert finder.patterns(text, at, at + 8, *_spans(finder, text))[:2] == [("please call _", "call _"), ("call _ today", "_ today")]
    text = "reach " + "y" * 100 + " at 12345678"
    at = text.index("1")
    assert finder.patterns(text, at, at + 8, *_spans(finder, text))[0][0] == "\N{HORIZONTAL ELLIPSIS} at _"


def test_a_text_without_spaces_is_read_once(spark):
    text = ",".join(f"a{i}@example.org" for i in range(40_000))
    found = pii.Finder().contexts(text, pii.Finder().base(text))
    assert len(found) >= 40_000 and all(len(p) < 200 for c in found[:100] for p, _ in c[4])
