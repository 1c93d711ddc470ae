import random

import numpy as np
from brute import components, simhash
from helpers import rows_of
from plan_text import plan_of
from pyspark.sql import functions as F

from parcelgrid.llm import simhash as S


def close(a, b):
    return (a ^ b).bit_count() <= 3


def test_every_close_pair_shares_a_shard_once():
    rng = random.Random(1)
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            y ^= 1 << bit
        shared = [c for c, mask in enumerate(S.MASKS) if x & mask == y & mask]
        both = np.array([x, y], np.uint64)
        table = S.pivot_table(both)
        counted = [c for c in shared if len(S.verified(both[:1], both[1:], table[:1], table[1:], np.array([c])))]
        assert counted == shared[:1]


def test_documents_against_brute_force(docs, empty, clashing):
    rows = docs.select("doc_id", "text").collect()
    prints = {r.text: simhash(r.text) for r in rows}
    root = components(sorted(set(prints.values())), close)
    least = {}
    for r in rows:
        if r.doc_id is not None:
            key = root[prints[r.text]]
            least[key] = min(least.get(key, r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, f"{prints[r.text]:016x}", least[root[prints[r.text]]]) for r in rows), key=repr)
    assert rows_of(S.near_duplicates(docs)) == want
    assert rows_of(S.near_duplicates(clashing)) == want
    assert S.near_duplicates(empty).count() == 0
    one = S.one_per_group(clashing)
    assert one.columns == clashing.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(least.values()))
    assert S.one_per_group(empty).count() == 0


def test_links_of_dense_and_crowded_shards(spark, monkeypatch):
    """A group of near copies larger than NARROW, cut into chunks, next to chains and strangers."""
    rng = random.Random(2)
    core = rng.getrandbits(64)
    prints = {core}
    while len(prints) < 150:
        own = core
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            own ^= 1 << bit
        prints.add(own)
    chain = rng.getrandbits(64)
    for _ in range(40):
        for bit in rng.sample(range(64), 3):
            chain ^= 1 << bit
        prints.add(chain)
    prints |= {rng.getrandbits(64) for _ in range(300)}
    want = components(sorted(prints), close)
    table = spark.createDataFrame([(S.signed(p),) for p in prints], "fp long").repartition(4)
    for rows in (4096, 20):
        monkeypatch.setattr(S, "SHARD_ROWS", rows)
        links = S.fingerprint_links(table).collect()
        named = {p: p for p in prints}
        got = components(sorted(prints), lambda a, b: False)
        linked = {(x % (1 << 64), y % (1 << 64)) for x, y in links}
        assert all(close_chain(want, x, y) for x, y in linked)
        got = components(sorted(named), lambda a, b: (a, b) in linked or (b, a) in linked)
        assert got == want


def close_chain(want, x, y):
    return want[x] == want[y]


def test_null_ids_only(spark):
    table = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x")], "doc_id long, text string")
    assert [r.component_id for r in S.near_duplicates(table).collect()] == [None] * 3
    assert S.one_per_group(table).count() == 2


def test_one_hot_text(spark):
    table = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("the same text for all of them").alias("text"))
    assert S.near_duplicates(table).select("component_id").distinct().count() == 1
    assert [r.doc_id for r in S.one_per_group(table).collect()] == [0]


def test_nothing_is_broadcast_by_the_size_of_a_file(spark):
    """The shards are 20 times the fingerprints; texts stay where they are if few rows go."""
    plan = plan_of(S.fingerprint_links(spark.range(5000).withColumnRenamed("id", "fp")))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    table = spark.createDataFrame([(i, f"{i} one of {i * 7} many {i * i} words") for i in range(50)] * 2, "doc_id long, text string")
    one = S.one_per_group(table)
    assert "LeftAnti" in plan_of(one) and "hashpartitioning" not in plan_of(one)
    assert sorted(r.doc_id for r in one.collect()) == list(range(50))
