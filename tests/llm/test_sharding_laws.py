"""The laws of sharding, checked on whole results."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tagloom.llm.sharding import shard


def laws(rows, made, shards, tolerance):
    """Every row once, right sizes and checksums, gapless slots, level bytes; returns the shards of each text."""
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in made) == want
    slots, loads = defaultdict(list), Counter({k: 0 for k in range(shards)})
    for r in made:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(loads.values()) / shards
    assert max(abs(x - mean) for x in loads.values()) <= tolerance * mean, loads
    of_text = defaultdict(set)
    for r in made:
        of_text[r.text_crc32].add(r.shard)
    return of_text


@pytest.mark.parametrize("copies", [400, 4000])
def test_one_row_repeated_beyond_a_shard_is_dealt_out(spark, copies):
    rows = [(7, "the same words in every row")] * copies + [(100 + i, f"another text {i:04d} of like size") for i in range(copies // 8)]
    random.Random(1).shuffle(rows)
    made = shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=4).collect()
    laws(rows, made, 4, 0.03)


def test_a_missing_id_repeated_beyond_a_shard_is_dealt_out(spark):
    rows = [(None, "the same words in every row")] * 300 + [(1, None)] * 300 + [(2, "")] * 10
    made = shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=3).collect()
    laws(rows, made, 3, 0.15)


def test_groups_of_copies_stay_together(spark):
    rng = random.Random(5)
    rows, number = [], 0
    for group in range(300):
        text = " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(3, 120)))
        for _ in range(1 + int(rng.paretovariate(1.5)) % 12):
            number += 1
            rows.append((number, text))
    made = shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=8).collect()
    assert all(len(s) == 1 for s in laws(rows, made, 8, 0.03).values())


def test_a_hot_group_of_different_ids_is_cut_by_id(spark):
    rows = [(i, "copied everywhere, word for word") for i in range(600)] + [(1000 + i, f"text number {i:05d} of about that size") for i in range(600)]
    first = shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=6).collect()
    again = shard(spark.createDataFrame(rows[::-1], "doc_id bigint, text string"), shards=6).collect()
    laws(rows, first, 6, 0.03)
    assert {(r.doc_id, r.shard, r.slot) for r in first} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_the_given_documents_are_level(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    laws(rows, shard(docs).collect(), 24, 0.02)
