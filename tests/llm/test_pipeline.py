"""The stages against plain versions of each, on the small table and on odd rows."""

import duckdb
import pytest
from brute import components, repeats, simhash, words
from helpers import SMALL, rows_of

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from parcelgrid.llm import queries


def quality(text):
    inside, longest = repeats(text) if len(words(text)) < 900 else (None, None)
    if inside is None:
        return None
    n = len(words(text))
    return n >= 20 and 100 * inside <= 30 * n and not (longest >= 50 and longest > 0.2 * n)


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for number, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(number)))
        found = spark.read.parquet(str(tmp_path / str(number)))
        rows = found.collect()
        if name == "quality_rules":
            kept = {r.doc_id for r in rows}
            for doc_id, r in before.items():
                want = quality(r.text)
                assert want is None or (doc_id in kept) == want
        if name == "line_dedup":
            had = {r.doc_id: r.text for r in docs.collect()}
            seen = set()
            for r in sorted(rows, key=lambda r: r.doc_id):
                lines = [line.strip().lower() for line in r.text.split("\n") if words(line)]
                assert lines and set(r.text.split("\n")) <= set(had[r.doc_id].split("\n"))
                assert not seen & set(lines) and len(set(lines)) == len(lines)
                seen |= set(lines)
            gone = {line.strip().lower() for t in had.values() for line in t.split("\n") if words(line)} - seen
            assert len(gone) < 0.1 * len(seen)
        if name == "simhash_dedup":
            prints = {r.doc_id: simhash(r.text) for r in docs.collect()}
            root = components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
            first = {}
            for i, p in prints.items():
                first[root[p]] = min(first.get(root[p], i), i)
            assert sorted(r.doc_id for r in rows) == sorted(first.values())
        if name == "mix_sources":
            whole = {r.doc_id: len(words(r.text)) for r in docs.collect()}
            taken = {}
            for r in rows:
                taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words(r.text))
            assert all(n <= 3 * whole[i] for i, n in taken.items())
            assert abs(sum(taken.values()) - sum(whole.values())) <= 20
        if name == "packing":
            assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
            assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
        else:
            assert found.columns == columns and all(r.n_chars == len(r.text) for r in rows if name in ("line_dedup", "mix_sources"))
        docs = found


def test_stages_on_odd_rows(spark, docs, empty):
    for table in (docs, empty):
        for _, stage in pipeline.STAGES:
            found = stage(spark, table, SMALL)
            found.collect()
            if found.columns == docs.columns:
                assert found.schema.simpleString() == docs.schema.simpleString()


def test_run_goes_through(spark):
    assert pipeline.run(spark, SMALL).count() > 100


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(spark, name):
    found = contract.queries()[name](spark, SMALL)
    if name not in contract.oracle_sql():
        assert found.count() > 0
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    twin = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in twin.description]
    assert sorted(names) == sorted(found.columns)
    assert rows_of(found.select(names)) == sorted(twin.fetchall(), key=repr)
