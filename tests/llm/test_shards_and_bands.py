"""Index shards in passes, copies made longer by insertions, and bands of word buckets give the same whole results."""

import random

from pyspark.sql import functions as F

from roadpulse.llm import bpe, decontaminate

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string"


def _words(rnd, n):
    return ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]


def test_passes_equal_one_shard(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    whole = decontaminate.contaminated(rows, bench).collect()
    postings = decontaminate.bm25_postings(bench.select(F.monotonically_increasing_id().alias("item_no"), "text")).count()
    cut = {"shard_postings": postings // 5, "per_pass": 2}
    assert decontaminate.write_shards(bench, shard_postings=postings // 5).count() >= 4
    split = decontaminate.contaminated(rows, bench, **cut).collect()
    # Impacts are float sums, in shards in another order.
    key = lambda r: (r.id, r.item_id, round(r.score, 6), r.question, r.answer)
    assert whole and sorted(map(key, whole)) == sorted(map(key, split))
    kept = decontaminate.drop_contaminated(rows, bench, **cut)
    assert kept.columns == rows.columns
    assert kept.count() == rows.count() - len({r.id for r in whole})


def test_repeated_item_ids_and_clashing_columns(spark):
    rnd = random.Random(3)
    a, b = (" ".join(_words(rnd, 30)) + ". " + " ".join(_words(rnd, 4)) for _ in range(2))
    items = spark.createDataFrame([(1, a), (1, b), (2, a)], "item_id long, text string")
    rows = spark.createDataFrame([(7, f"x {a}", 1, "s"), (8, b, 2, "t"), (9, "nothing of these", 3, None), (None, None, 4, "u")],
                                 KINDS + ", hits int, `a.b` string")
    found = sorted((r.id, r.item_id) for r in decontaminate.contaminated(rows, items).collect())
    assert found == [(7, 1), (7, 2), (8, 1)]
    kept = decontaminate.drop_contaminated(rows, items)
    assert kept.columns == rows.columns
    assert sorted(r.hits for r in kept.collect()) == [3, 4]


def test_copies_longer_by_insertions_are_found_at_every_offset(spark):
    rnd = random.Random(5)
    question, answer = _words(rnd, 60), _words(rnd, 5)
    items = spark.createDataFrame([(1, " ".join(question) + ". " + " ".join(answer) + ".")], "item_id long, text string")
    docs = []
    for pad in range(0, 140, 3):
        at = rnd.randrange(5, 55)
        # A fifth of the words more, in one place; and a tenth more in two places.
        one = question[:at] + _words(rnd, 13) + question[at:]
        two = question[:20] + _words(rnd, 3) + question[20:40] + _words(rnd, 3) + question[40:]
        for copy in (one, two):
            docs.append((len(docs), " ".join(_words(rnd, pad) + copy) + ". " + " ".join(answer) + ". " + " ".join(_words(rnd, 90))))
    docs.append((len(docs), " ".join(_words(rnd, 300))))
    found = {r.id for r in decontaminate.contaminated(spark.createDataFrame(docs, KINDS), items).collect()}
    assert found == set(range(len(docs) - 1))


def test_bands_of_buckets_give_the_same_ids(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one = {r.id: (r.ids, bytes(r.ids_le)) for r in bpe.encode(rows, chunk_words=20_000).collect()}
    many = {r.id: (r.ids, bytes(r.ids_le)) for r in bpe.encode(rows, chunk_words=20_000, bucket_bytes=4096).collect()}
    assert one == many and len(one) == rows.count()
