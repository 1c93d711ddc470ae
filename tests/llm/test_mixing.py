import random

import pytest
from brute import targets, words
from helpers import rows_of
from pyspark.sql import functions as F

from parcelgrid.llm import mixing as M


def check(rows, table):
    sizes = {}
    for r in table.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    want = targets(sizes)
    taken = {}
    source = {r.doc_id: r.source for r in table.collect()}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        taken[s] = taken.get(s, 0) + r.taken
    return want, taken


def test_targets_are_met(spark):
    rng = random.Random(6)
    rows = [
        (i, "w " * rng.choice([0, 1, 5, 40, 400]), rng.choice(["a"] * 30 + ["b", "B", "c", "é", None, "d"]))
        for i in range(3000)
    ]
    rows.append((3000, "only", "tiny"))
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    want, taken = check(M.mix(table).collect(), table)
    assert set(taken) == set(want)
    for s in want:
        assert abs(taken[s] - want[s]) <= 1, s


def test_reruns_agree_and_copies_match(docs, clashing, empty):
    found = M.mix(docs)
    assert rows_of(found) == rows_of(M.mix(docs.repartition(7))) == rows_of(M.mix(clashing))
    check(found.collect(), docs)
    copies = M.mixed(clashing)
    assert copies.columns == clashing.columns
    counted = {}
    for r in copies.collect():
        counted[r.doc_id, r.source] = counted.get((r.doc_id, r.source), 0) + len(words(r.text))
    want = {}
    for r, d in zip(sorted(found.collect(), key=repr), sorted(docs.collect(), key=repr)):
        assert r.doc_id == d.doc_id
        want[r.doc_id, d.source] = want.get((r.doc_id, d.source), 0) + r.taken
    assert counted == {k: v for k, v in want.items() if v}
    assert M.mix(empty).count() == 0 and M.mixed(empty).count() == 0


def test_all_empty(spark):
    table = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in M.mix(table).collect()] == [(0, 0.0, 0)] * 2


def test_ties_on_the_boundary_share_it(spark):
    table = spark.range(1).select(
        F.lit(7).alias("doc_id"), F.lit("a b c d").alias("text"), F.explode(F.split(F.lit("xxxxxxy"), "")).alias("source")
    )
    rows = M.mix(table.filter("source != ''")).collect()
    assert len({(r["size"], r.target, r.taken) for r in rows if r.source_size == 24}) == 1


def test_no_python_on_the_main_path(docs):
    plan = M.mix(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
