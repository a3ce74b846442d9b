"""Token counts of a byte-level BPE by rank-synchronous merging of arrays.

A task holds the distinct pre-tokens of a batch of texts as one ragged numpy array of byte
symbols.  In each round every sequence finds its lowest-ranked adjacent pair and merges all
places of that pair at once, left to right; sequences without a pair leave the array, and the
symbols that survive are counted.  This gives the library's merges because a pair that holds
the product of a merge always ranks after that merge (checked when the vocabulary is loaded).

Sequences are first cut where two neighbouring bytes stand together in no piece of the
vocabulary, since no merge can cross such a place.  A sequence that is still long merges many
pairs a round: a pair that ranks lowest among all pairs within the longest piece's length can
be reached by no earlier merge, so it need not wait for the lowest pair of the whole sequence.

The tables of the vocabulary (some 50,000 merges) travel with the job.  Texts stay in their rows:
no shuffle, nothing gathered; a worker holds the pre-tokens of about ``PART_CHARS`` characters
and a bounded memory of counts it already knows.

Defined results: a null or empty text has 0 bytes and 0 tokens; ids pass through with nulls and
repeats, one result row for each input row; other columns are ignored; an empty table gives an
empty result.  A special token's string inside a text is one token, as is the library's default.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import prepare, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512  # tokens beyond which a document is over the limit
PART_CHARS = 2_000_000  # texts are split and merged in parts of about this size
KNOWN_WORDS = 300_000  # counts a worker remembers before it starts afresh
LONG = 1024  # symbols from which a sequence merges by neighbourhoods
NONE = np.int32(2**31 - 1)  # rank of a pair that is no merge

# The byte-level pre-tokenizer's own pattern (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose classes are the same in every Unicode table in use; texts with others are split by the library.
SAFE = (
    r"[\x00-\u0557\u0559-\u058a\u058d-\u088e\u0890-\u0c5b\u0c5d-\u0cdb\u0cdd-\u208e\u2090-\u209c"
    r"\u20a0-\ua7cd\ua800-\uab6b\uab6e-\ud7ff\ue000-\uffff\U0001f000-\U0001fbff]*+"
)


def tokenizer_text(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


class Splitter:
    """Pre-tokens of a text, special tokens apart."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        told = json.loads(spec)
        how = told["pre_tokenizer"]
        if told["normalizer"] or how["type"] != "ByteLevel" or how["add_prefix_space"] or not how["use_regex"]:
            raise ValueError("not a plain byte-level tokenizer")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError("added tokens that take their surroundings along are not supported")
        special = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)").finditer
        self.pre = Tokenizer.from_str(spec).pre_tokenizer
        self.find, self.safe = regex.compile(WORDS).findall, regex.compile(SAFE).fullmatch
        self.seam = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])").search

    def parts(self, text: str):
        """(special tokens, characters, words) of consecutive parts; a part ends where a word does."""
        at = 0
        for m in self.special(text):
            for a, b in self._cuts(text, at, m.start()):
                yield 0, b - a, self._words(text[a:b])
            yield 1, 0, []
            at = m.end()
        for a, b in self._cuts(text, at, len(text)):
            yield 0, b - a, self._words(text[a:b])

    def _cuts(self, text: str, at: int, end: int):
        while end - at > PART_CHARS and (m := self.seam(text, at + PART_CHARS, end)):
            yield at, m.start()
            at = m.start()
        if at < end:
            yield at, end

    def _words(self, text: str) -> list[str]:
        if text.isascii() or self.safe(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.pre.pre_tokenize_str(text)]


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary's pieces, by rule: visible Latin-1 stands for itself."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Counts the symbols that are left of byte sequences when all merges are made."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        vocab, letters = model["vocab"], byte_letters()
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or not letters.keys() <= vocab.keys():
            raise ValueError("not a plain byte-level BPE")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.byte_id = np.zeros(256, np.int32)
        self.byte_id[list(letters.values())] = [vocab[x] for x in letters]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.size = max(vocab.values()) + 1
        made = np.full(self.size, -1)
        made[self.result[::-1]] = np.arange(len(merges))[::-1]
        if (np.maximum(made[left], made[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge ranks before its own parts")
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int32)
        pieces = [bytes(letters[c] for c in a + b) for a, b in merges]
        self.reach = max(map(len, pieces), default=1)
        self.joint = np.zeros((256, 256), bool)
        for p in pieces:
            self.joint[list(p[:-1]), list(p[1:])] = True

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(a), NONE)
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        if not len(flat):
            return sizes
        first = np.zeros(len(flat), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        first[1:] |= ~self.joint[flat[:-1], flat[1:]]
        starts = np.flatnonzero(first)
        lengths = np.diff(np.r_[starts, len(flat)])
        left = lengths.copy()
        for long in (False, True):
            own = np.flatnonzero((lengths > 1) & ((lengths > LONG) == long))
            if len(own):
                at = np.repeat(starts[own] - np.r_[0, np.cumsum(lengths[own])[:-1]], lengths[own]) + np.arange(lengths[own].sum())
                left[own] = self._merge(self.byte_id[flat[at]], lengths[own], long)
        word = np.repeat(np.arange(len(words)), sizes)[starts]
        return np.bincount(word, weights=left, minlength=len(words)).astype(np.int64)

    def _merge(self, sym: np.ndarray, lengths: np.ndarray, long: bool) -> np.ndarray:
        """Symbols left of each sequence; the sequences stand end to end in ``sym``."""
        out, who = lengths.copy(), np.arange(len(lengths))
        seq = np.repeat(np.arange(len(lengths)), lengths)
        rank = self._pairs(sym, seq)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, starts)
            held = np.diff(np.r_[starts, len(sym)])
            open_ = low < NONE
            if not open_.all():  # finished sequences leave
                out[who[~open_]] = held[~open_]
                stay = np.repeat(open_, held)
                sym, rank, who, low, held = sym[stay], rank[stay], who[open_], low[open_], held[open_]
                seq = np.repeat(np.arange(len(held)), held)
                if not len(sym):
                    break
            hit = (rank == (self._near(rank) if long else np.repeat(low, held))) & (rank < NONE)
            hit = self._left_to_right(sym, rank, hit)
            at = np.flatnonzero(hit)
            sym[at] = self.result[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            fresh = hit.copy()  # pairs that begin at a merge or just before one are new
            before = at - 1
            before = before[before >= 0]
            before = np.where(stay[before], before, np.maximum(before - 1, 0))
            fresh[before] = True
            sym, rank, seq, fresh = sym[stay], rank[stay], seq[stay], np.flatnonzero(fresh[stay])
            rank[fresh] = self._pairs(sym, seq, fresh)
        return out

    def _pairs(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Rank of the pair that begins at each place (or those ``at``); a sequence's last symbol begins none."""
        at = np.arange(len(sym)) if at is None else at
        after = np.minimum(at + 1, len(sym) - 1)
        inside = (seq[after] == seq[at]) & (after > at)
        out = np.full(len(at), NONE)
        out[inside] = self.ranks(sym[at[inside]], sym[after[inside]])
        return out

    def _near(self, rank: np.ndarray) -> np.ndarray:
        """Lowest rank within ``reach`` places on either side."""
        n, r = len(rank), self.reach
        low, width = np.r_[np.full(r, NONE), rank, np.full(r, NONE)], 1
        while 2 * width <= 2 * r + 1:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[:n], low[2 * r + 1 - width : 2 * r + 1 - width + n])

    @staticmethod
    def _left_to_right(sym: np.ndarray, rank: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Of pairs of a symbol with itself that overlap, every other one from the left; a row of them merges as a whole or waits."""
        twin = (rank < NONE) & np.r_[sym[:-1] == sym[1:], False]
        linked = np.r_[False, twin[1:] & twin[:-1] & (sym[1:] == sym[:-1])]  # overlaps the pair before it
        if not linked.any():
            return hit
        head = np.maximum.accumulate(np.where(linked, 0, np.arange(len(sym))))
        row = np.cumsum(~linked) - 1
        whole = np.minimum.reduceat(hit, np.flatnonzero(~linked))[row]
        return np.where(twin, hit & whole & ((np.arange(len(sym)) - head) % 2 == 0), hit)


def _count_texts(spec: str, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        split, merger = Splitter(spec).parts, Merger(spec)
        known: dict[str, int] = {}

        def count(held: list[tuple[int, list[str]]], tokens: np.ndarray) -> None:
            new = list(set().union(*(w for _, w in held)) - known.keys())
            known.update(zip(new, merger.counts([w.encode() for w in new]).tolist()))
            for row, words in held:
                tokens[row] += sum(map(known.__getitem__, words))
            if len(known) > KNOWN_WORDS:
                known.clear()

        for batch in batches:
            tokens, sizes = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            held, waiting = [], 0
            for row, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                sizes[row] = len(text) if text.isascii() else len(text.encode())
                for special, size, words in split(text):
                    tokens[row] += special
                    held.append((row, words))
                    waiting += size
                    if waiting > PART_CHARS:
                        count(held, tokens)
                        held, waiting = [], 0
            count(held, tokens)
            yield pa.record_batch([batch.column(0).cast(id_type), pa.array(sizes), pa.array(tokens)], schema=schema)

    return run


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, its text's UTF-8 bytes (n_bytes) and tokens (n_tokens)."""
    from pyspark.sql.pandas.types import to_arrow_type

    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _count_texts(tokenizer_text(tokenizer), to_arrow_type(kind)), f"id {kind.simpleString()}, n_bytes long, n_tokens long"
    )


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )
