import hashlib
import re

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from parcelgrid.llm import exact_dedup as E


def plain(rows):
    """``doc_id, keep_id, group_size, sha``, sorted, and the number kept, from (doc_id, text)."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for content, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(i, keep, len(own), hashlib.sha256(content.encode()).hexdigest()) for i, _ in own]
    return sorted(out, key=repr), len(groups)


def held(df):
    rows = df.select("doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return sorted((tuple(r)[:4] for r in rows), key=repr), sum(r.kept for r in rows)


def test_against_plain_groups(docs, empty, clashing):
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert held(E.exact_dedup(docs)) == want
    assert held(E.exact_dedup(clashing)) == want
    assert E.exact_dedup(empty).count() == 0
    again = clashing.drop("n").withColumnRenamed("doc_id", "n")
    assert rows_of(E.exact_dedup(again, id_col="n").select("n")) == rows_of(docs.select("doc_id"))


def test_spacing_decides_who_stays(spark):
    rows = [(5, "ab"), (3, "a b"), (9, "a\n\tb"), (8, "a  b"), (7, ""), (6, None), (4, " \r"), (2, "a b"), (1, "a\x1cb")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert held(E.exact_dedup(df)) == plain(rows)
    assert {r.doc_id for r in E.exact_dedup(df).filter("kept").collect()} == {8, 4, 2, 1}


@pytest.mark.parametrize("few", [True, False])
def test_colliding_digests_are_told_apart_by_their_bytes(docs, monkeypatch, few):
    """A digest of four bits puts unlike texts under one key; groups must not change."""
    if not few:
        monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    want, kept = plain([(r.doc_id, r.text) for r in docs.collect()])
    rows, n = held(E.exact_dedup(docs, digest=lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1))))
    assert [r[:3] for r in rows] == [r[:3] for r in want] and n == kept


def test_joins_that_shuffle(docs, monkeypatch):
    monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(E, "HOT_SHARE", 15)
    assert held(E.exact_dedup(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_state_outlives_the_run(spark, tmp_path):
    """Small batches, then files added later: the second run reads only those and knows the earlier ones."""
    content, folder = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "doc_id long, text string"
    early = [(i, f"text {i % 4}") for i in range(20)]
    spark.createDataFrame(early, schema).repartition(5).write.parquet(content)
    assert held(E.exact_dedup_files(spark, content, folder, batch_bytes=1000)) == plain(early)
    late = [(100 + i, f"text  {i % 6}") for i in range(12)] + [(0, "text 5")]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(content)
    assert held(E.exact_dedup_files(spark, content, folder, batch_bytes=1000)) == plain(early + late)
    written = spark.read.parquet(f"{folder}/digests").count()
    assert written == len(early + late)


def test_one_file_and_one_very_long_text(spark, tmp_path):
    rows = [(1, "x y " * 2_000_000), (2, "xy" * 2_000_000), (3, "z")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    assert held(E.exact_dedup_files(spark, str(file))) == plain(rows)
