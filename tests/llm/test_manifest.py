import hashlib
import zlib

import pytest
from helpers import rows_of

from parcelgrid.llm import manifest as M

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    texts = [None if v is None else str(v) for v in values]
    return H(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def climb(level, paths):
    """The root of a list of (digest, members); adds siblings to the members' paths."""
    while len(level) > 1:
        above = []
        for i in range(0, len(level), 3):
            run = level[i : i + 3]
            for j, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1 :])))
            above.append((H(*(h for h, _ in run)), [m for _, own in run for m in own]))
        level = above
    return level[0]


def plain(rows):
    rows = [r[:5] for r in rows]
    leaves = [leaf_of((r[0], r[3], r[2], r[4], r[1])) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
    paths, subroot, tops = {i: [] for i in order}, {}, []
    for source in sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode())):
        own = [i for i in order if rows[i][3] == source]
        top = climb([(leaves[i], [i]) for i in own], paths)
        subroot.update((i, top[0]) for i in own)
        tops.append(top)
    root = climb(tops, paths)[0] if tops else None
    out = []
    for i, r in enumerate(rows):
        text = r[1]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        fold = leaf_of((r[0], r[3], r[2], r[4], text))
        for left, right in paths[i]:
            fold = H(left, fold, right)
        proof = H(*(x for step in paths[i] for x in step))
        out.append((r[0], leaves[i], subroot[i], root, proof, fold, fold == root))
    return sorted(out, key=repr)


def test_against_plain_tree(docs, empty, clashing):
    want = plain(docs.collect())
    assert rows_of(M.tamper_check(docs)) == want
    assert rows_of(M.tamper_check(clashing)) == want
    assert M.tamper_check(empty).count() == 0
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)


@pytest.mark.parametrize("band", [1, 2])
def test_many_bands_and_groups(spark, monkeypatch, band):
    """Narrow bands, so that both kinds of tree have several; groups of 1 to 100 rows, shuffled counts."""
    monkeypatch.setattr(M, "BAND", band)
    monkeypatch.setattr(M, "WIDTH", M.FAN**band)
    monkeypatch.setattr(M, "BROADCAST_RUNS", 0)
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 100, 1, 1, 5]
    rows, at = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            at = (at + 37) % 1009
            rows.append((at, f"text {at}\nof {g}", None if at % 5 else "en", None if g == 4 else f"s{g}", at))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert rows_of(M.tamper_check(df.repartition(5))) == plain(rows)


def test_one_row_and_its_empty_proof(spark):
    df = spark.createDataFrame([(3, "", "", None, 0)], "doc_id long, text string, lang string, source string, n_chars int")
    (row,) = M.manifest(df).collect()
    assert row.leaf == row.subroot == row.root and row.proof == []
    assert rows_of(M.tamper_check(df)) == plain(df.collect())


def test_null_and_empty_fields_differ(spark):
    rows = [(1, None, "en", "a", 0), (1, "", "en", "a", 0), (1, "x" * 3_000_000, "en", "a", None), (1, "", "en", "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert rows_of(M.tamper_check(df)) == plain(rows)
    assert M.manifest(df).select("leaf").distinct().count() == 3
