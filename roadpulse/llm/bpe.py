"""BPE encoding through a distinct-word table, and decoding through an id-to-piece table.

Texts are split into words in Spark; consecutive documents form chunks, and a chunk
names its distinct words by number, so a document becomes a short sequence of numbers
(its word positions).  The distinct words of all chunks are shuffled by word, each
distinct word is encoded once by the task that owns it, and the ids travel back to the
chunks, where they are joined to the documents by position.  (With very many chunks this
is done for bands of them, so that the words one task holds stay bounded.)  Only the distinct words of
chunks and the packed numbers are ever shuffled, never one row per word position.

The tokenizer file is a parameter; its text is sent to the executors with the job.
Splitting is done with the tokenizer's own pattern; texts holding characters on which
the pattern's Unicode tables could disagree take the tokenizer's own (slower) splitter.

Defined results: a null or empty text has no ids and decodes to the empty text; equal
rows get equal ids; ids and nulls of the key column pass through; an empty table gives
an empty result.
"""

from __future__ import annotations

import json
import math
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import fresh, materialize, prepare, table

TOKENIZER = "word_bpe_49k.json"
CHUNK_WORDS = 5_000_000  # word positions of a chunk; a longer document is a chunk of its own
GROUP_WORDS = 500_000  # about so many of them are joined to their ids at a time
BUCKET_BYTES = 32 << 20  # of packed words that one task loads at a time; more of them make more bands of chunks

# Characters that the regex module and the tokenizer treat alike, one by one and in sequence.
SAFE = (
    r"[\x00-\u02ff\u0370-\u03a2\u03a4-\u0482\u048a-\u052f\u2000-\u206f\u20a0-\u20bf\u2190-\u2bff"
    r"\u3000-\u3029\u3030-\u3098\u309b-\u30ff\u4e00-\u9fff\uac00-\ud7a3]*+"
)


def tokenizer_text(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


class Splitter:
    """Splits texts into the words that the tokenizer encodes one by one."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        told = json.loads(spec)
        kinds = [n["type"] for n in told["normalizer"]["normalizers"]]
        pattern = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unsupported normalizer: {kinds}")
        self.tokenizer = Tokenizer.from_str(spec)
        self.special = {t["content"] for t in told["added_tokens"]}
        self.around = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.find = regex.compile(pattern).findall
        self.safe = regex.compile(SAFE).fullmatch

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        out, at = [], 0
        for m in self.around.finditer(text) if "<|" in text else ():
            out += self._plain(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if self.safe(text):
            return self.find(unicodedata.normalize("NFC", text).lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values as compressed byte planes, which suits word numbers and sizes."""
    planes = np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T)
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces flat[s : s + n], end to end."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class _Chunk:
    """Consecutive documents and the numbers of their distinct words."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.keys: list = []
        self.docs: list[np.ndarray] = []
        self.held = 0

    def add(self, key, words: list[str]) -> None:
        names = self.names
        self.docs.append(np.fromiter((names.setdefault(w, len(names)) for w in words), np.uint32, len(words)))
        self.keys.append(key)
        self.held += len(words)

    def rows(self, chunk: int, buckets: int, schema: pa.Schema) -> pa.RecordBatch:
        """Rows of numbered words for groups of documents, of the words' order, and of each bucket's distinct words."""
        # Frequent words get small numbers, which pack well.
        order = np.argsort(-np.bincount(np.concatenate(self.docs), minlength=len(self.names)), kind="stable")
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        words: dict[int, list[str]] = {}
        for w in sorted(self.names):
            words.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)  # alike in every chunk
        words = dict(sorted(words.items()))
        ranks = pack(np.array([number[self.names[w]] for own in words.values() for w in own], np.uint32))
        ends = np.cumsum([len(d) for d in self.docs])
        groups = np.split(np.arange(len(ends)), np.flatnonzero(np.diff(ends // GROUP_WORDS)) + 1)
        zip_ = zstandard.ZstdCompressor(9).compress
        rows = [(chunk, None, None, None, None, ranks)]
        for own in groups:
            held = [self.docs[i] for i in own]
            rows.append((chunk, None, [self.keys[i] for i in own], pack(np.array([len(d) for d in held])), None,
                         pack(number[np.concatenate(held)])))
        rows += [(chunk, bucket, None, None, zip_(" ".join(own).encode()), None) for bucket, own in words.items()]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _split(spec: str, id_type: pa.DataType, buckets: int, chunk_words: int):
    """Rows of chunks: their documents' words by number, and their distinct words by bucket."""
    schema = pa.schema([
        ("chunk", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(id_type)),
        ("sizes", pa.binary()), ("words", pa.binary()), ("numbers", pa.binary()),
    ])

    def run(batches):
        split = Splitter(spec).words
        at, chunk = TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = split(text.as_py())
                if chunk.docs and chunk.held + len(words) > chunk_words:
                    yield chunk.rows(at, buckets, schema)
                    at, chunk = at + 1, _Chunk()
                chunk.add(key, words)
        if chunk.docs:
            yield chunk.rows(at, buckets, schema)

    return run


def _encode_words(tokenizer, words: list[str], last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words end to end, and how many each has. ``last``: whether an id ends a word."""
    texts = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    flat = np.array([i for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], np.uint32)
    sizes = np.diff(np.r_[-1, np.flatnonzero(last[flat])])
    if len(sizes) != len(words):  # some word's last piece is no word end: one by one
        ids = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
        flat, sizes = np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)
    return flat, sizes


def _encode_bucket(spec: str):
    """One bucket of the distinct-word table: every distinct word is encoded once."""

    loaded: list = []  # once for all buckets of a task

    def run(entries: pa.Table) -> pa.Table:
        if not loaded:
            tokenizer = Splitter(spec).tokenizer
            vocab = tokenizer.get_vocab(with_added_tokens=True)
            suffix = json.loads(spec)["model"]["end_of_word_suffix"]
            added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
            last = np.zeros(max(vocab.values()) + 1, bool)
            last[[i for piece, i in vocab.items() if piece.endswith(suffix) or piece in added]] = True
            loaded.extend((tokenizer, last))
        tokenizer, last = loaded
        unzip, zip_ = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(9).compress
        place: dict[str, int] = {}
        rows = [
            np.array([place.setdefault(w, len(place)) for w in unzip(x).decode().split(" ")])
            for x in entries["words"].to_pylist()
        ]
        flat, sizes = _encode_words(tokenizer, list(place), last)
        starts = np.cumsum(sizes) - sizes
        return pa.table({
            "chunk": entries["chunk"],
            "bucket": entries["bucket"],
            "sizes": pa.array([pack(sizes[r]) for r in rows], pa.binary()),
            "ids": pa.array([zip_(gather(flat, starts[r], sizes[r]).astype("<u4").tobytes()) for r in rows], pa.binary()),
        })

    return run


def _join_back(id_type: pa.DataType):
    """A chunk's documents and encoded words: ids in the order of the word positions."""

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("bucket")
        unzip = zstandard.ZstdDecompressor().decompress
        sizes = np.concatenate([*map(unpack, words["sizes"].to_pylist()), np.zeros(0, np.uint32)])
        ids = np.concatenate([np.frombuffer(unzip(x), "<u4").astype(np.int32) for x in words["ids"].to_pylist()] or [np.zeros(0, np.int32)])
        rows = docs.to_pylist()
        number = next(unpack(r["numbers"]) for r in rows if r["keys"] is None)
        own_sizes, own_starts = np.zeros(len(number), np.int32), np.zeros(len(number), np.int32)
        own_sizes[number] = sizes
        own_starts[number] = np.cumsum(sizes, dtype=np.int64) - sizes
        out = []
        for r in rows:
            if r["keys"] is not None:
                at = unpack(r["numbers"])
                upto = np.r_[0, np.cumsum(own_sizes[at], dtype=np.int64)]
                offsets = upto[np.r_[0, np.cumsum(unpack(r["sizes"]), dtype=np.int64)]]
                found = gather(ids, own_starts[at], own_sizes[at])
                held = pa.LargeListArray.from_arrays(offsets, found).cast(pa.list_(pa.int32()))
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(4 * offsets), pa.py_buffer(found.astype("<i4"))]
                ).cast(pa.binary())
                out.append(pa.record_batch([pa.array(r["keys"], id_type), held, raw], names=["key", "ids", "ids_le"]))
        return pa.Table.from_batches(out)

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           chunk_words: int = CHUNK_WORDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id, the token ids of its whole text, and these as little-endian 32-bit integers (ids_le).

    A bucket of the distinct-word table is loaded whole, so chunks are dealt into as many bands as keep the
    largest bucket of a band near ``bucket_bytes``; a word is encoded once in each band that holds it.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = prepare(docs.sparkSession)
    spec = tokenizer_text(tokenizer)
    kind = docs.schema[id_col].dataType
    id_type, name = to_arrow_type(kind), kind.simpleString()
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = materialize(
        docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(
            _split(spec, id_type, buckets, chunk_words),
            f"chunk long, bucket int, keys array<{name}>, sizes binary, words binary, numbers binary",
        ),
        "bpe-words",
    )
    words = split.where("bucket is not null").select("chunk", "bucket", "words")
    largest = words.groupBy("bucket").agg(F.sum(F.octet_length("words")).alias("n")).agg(F.max("n")).first()[0] or 0
    bands = max(1, math.ceil(largest / bucket_bytes))
    encoded = (
        words.withColumn("band", F.pmod(F.xxhash64("chunk"), F.lit(bands)).cast("int"))
        .groupBy("band", "bucket").applyInArrow(_encode_bucket(spec), "chunk long, bucket int, sizes binary, ids binary")
    )
    numbered = split.where("bucket is null").select("chunk", "keys", "sizes", "numbers")
    return (
        numbered.groupBy("chunk").cogroup(encoded.groupBy("chunk"))
        .applyInArrow(_join_back(id_type), f"key {name}, ids array<int>, ids_le binary")
        .withColumnRenamed("key", "id")
    )


def piece_table(spark: SparkSession, tokenizer: str | None = None) -> DataFrame:
    """Rows (id, piece) of the tokenizer's vocabulary, added tokens included."""
    told = json.loads(tokenizer_text(tokenizer))
    vocab = told["model"]["vocab"] | {t["content"]: t["id"] for t in told["added_tokens"]}
    return spark.createDataFrame([(i, p) for p, i in vocab.items()], "id int, piece string")


def decode(encoded: DataFrame, pieces: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the decoded text: pieces of the ids in order, joined by spaces (the tokenizer has no decoder).

    The id-to-piece table, bounded by the vocabulary, is gathered into one array in id
    order and looked up by position; an id outside the table gives a null text.
    """
    held = pieces.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("id", "piece"))), lambda x: x["piece"]).alias("pieces")
    )
    n = pieces.count()
    lowest, highest = pieces.agg(F.min("id"), F.max("id")).first()
    if n and (lowest, highest) != (0, n - 1):
        raise ValueError("ids of the piece table must be 0 to its size - 1")
    name = fresh(encoded, "pieces")
    text = F.array_join(F.transform(F.col(ids_col), lambda i: F.element_at(F.col(name), i + 1)), " ")
    known = F.forall(F.col(ids_col), lambda i: (i >= 0) & (i < n))
    return encoded.withColumn(name, held.scalar()).withColumn(out_col, F.when(known, text)).drop(name)


def digests(encoded: DataFrame, pieces: DataFrame) -> DataFrame:
    return decode(encoded, pieces).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op5_bpe_encode_decode(spark, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents")), piece_table(spark))
