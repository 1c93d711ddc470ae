import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import rows_of, sentence
from pyspark.sql import functions as F

from parcelgrid import session
from parcelgrid.llm import toxicity as X


def auc(rows):
    good = sorted(s for s, y in rows if y == 0)
    bad = [s for s, y in rows if y == 1]
    from bisect import bisect_left, bisect_right

    return sum((bisect_left(good, s) + bisect_right(good, s)) / 2 for s in bad) / len(good) / len(bad)


@pytest.fixture(scope="module")
def data(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_rows(data):
    docs, labels = data
    found = X.toxicity(docs, labels)
    rows = found.join(docs, "doc_id").join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    words = {"worthless", "trash", "disgusting", "scum", "idiot", "moron", "clown", "loser", "stupid", "pathetic"}
    toxic = lambda r: any(w in r.text.lower() for w in words)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    assert auc([(r.score, int(toxic(r))) for r in held]) > 0.97
    caught = [r.predicted for r in held if toxic(r)]
    assert sum(caught) >= 0.8 * len(caught)
    wrong = [r.predicted for r in held if not toxic(r)]
    assert sum(wrong) <= 0.03 * len(wrong)


def test_held_out_labels_are_never_read(data):
    docs, labels = data
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    changed = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda marks: rows_of(X.toxicity(docs, marks).select("doc_id", F.round("score", 9)))
    assert score(labels) == score(changed) == score(labels.filter(~held))


def test_joins_give_what_broadcasts_give(data, monkeypatch):
    docs, labels = data
    before = {r.doc_id: r.score for r in X.toxicity(docs, labels).collect()}
    monkeypatch.setattr(X, "BROADCAST_ROWS", 0)
    after = {r.doc_id: r.score for r in X.toxicity(docs, labels).collect()}
    assert before.keys() == after.keys()
    assert all(math.isclose(before[i], after[i], abs_tol=1e-9) for i in before)


def test_odd_tables(spark, docs, empty, clashing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.toxicity(docs, none).collect()} == {0.5}
    marks = spark.createDataFrame([(i, i % 20 // 10) for i in range(0, 400, 10)] + [(None, 1), (10, None), (20, 7)], "doc_id long, toxic int")
    found = X.toxicity(docs, marks)
    assert found.count() == docs.count()
    assert rows_of(found) == rows_of(X.toxicity(clashing, marks.selectExpr("*", "1 AS id", "2 AS text")))
    assert X.toxicity(empty, marks).count() == 0


def plain_values(train, texts):
    """Kneser-Ney in plain Python: the value of each text, from ``(text, toxic)`` rows."""
    cut = lambda t: X.LETTERS.findall((t or "").lower())
    grams = [Counter(), Counter()]
    for text, toxic in train:
        own = cut(text)
        grams[toxic].update(set(zip([None, *own], own)))
    every = set(grams[0]) | set(grams[1])
    kinds = [Counter(w for _, w in g) for g in grams]
    shared = Counter(w for _, w in every)
    after = [Counter(), Counter()]
    follow = [Counter(), Counter()]
    for y in (0, 1):
        for (u, _), n in grams[y].items():
            after[y][u] += n
            follow[y][u] += 1
    total, all_kinds = [sum(k.values()) for k in kinds], sum(shared.values())

    def cut_off(counts):
        ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
        return ones / (ones + 2 * twos) if ones and twos else 0.75

    of_words, of_grams = [cut_off(k) for k in kinds], [cut_off(g) for g in grams]

    def word(y, w):
        return max(kinds[y][w] - of_words[y], 0) / total[y] + of_words[y] * len(kinds[y]) / total[y] * shared[w] / all_kinds

    def both(y, u, w):
        if not after[y][u]:
            return word(y, w)
        return (max(grams[y][u, w] - of_grams[y], 0) + of_grams[y] * follow[y][u] * word(y, w)) / after[y][u]

    def sure(bad, good, share):
        n = bad + good
        s = 2 * sum(k * math.log(k / (n * p)) for k, p in ((bad, share), (good, 1 - share)) if k)
        return 1 / (1 + math.exp((X.EVIDENCE - s) / X.WIDTH))

    def gain(u, w):
        if w not in shared:
            return 0.0
        alone = sure(kinds[1][w], kinds[0][w], total[1] / sum(total)) * math.log(word(1, w) / word(0, w))
        one = alone if abs(alone) >= X.RESOLUTION else 0.0
        if grams[0][u, w] + grams[1][u, w] < X.LEAST:
            return one
        t, o = after[1][u] * word(1, w), after[0][u] * word(0, w)
        part = sure(grams[1][u, w], grams[0][u, w], min(max(t / (t + o), 1e-9), 1 - 1e-9))
        pair = part * math.log(both(1, u, w) / both(0, u, w)) + (1 - part) * alone
        return pair if abs(pair - alone) >= X.RESOLUTION else one

    out = []
    for text in texts:
        own = cut(text)
        out.append(sum(gain(u, w) for u, w in zip([None, *own], own)) / len(own) if own else 0.0)
    return out


def test_values_are_those_of_plain_models(spark, texts, monkeypatch):
    rng = random.Random(12)
    train = [(sentence(rng, 30) + (" you scum" if k % 4 == 0 else " you see"), int(k % 4 == 0)) for k in range(60)]
    train += [(t, k % 2) for k, t in enumerate(texts)] + [("only once", 1)]
    asked = [t for t, _ in train] + ["you scum", "only", "once more", "unheard of", None, ""]
    want = plain_values(train, asked)
    entries = X.model(spark.createDataFrame(train, "text string, toxic int").repartition(3))
    docs = spark.createDataFrame(list(enumerate(asked)), "id long, text string").repartition(3)
    got = {r.id: r.value for r in X.values(docs, entries).collect()}
    assert all(math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-9) for k, v in enumerate(want))
    # an expression of a single toxic text counts, a little; one of many counts fully
    assert 0 < 2 * got[asked.index("only")] < got[asked.index("you scum")]


def test_one_toxic_text_raises_the_score(data):
    docs, labels = data
    once = docs.limit(1).selectExpr("-1L AS doc_id", "'Zorgblatt ' || text AS text", "lang", "source", "n_chars")
    asked = docs.limit(1).selectExpr("-7L AS doc_id", "'zorgblatt' AS text", "lang", "source", "n_chars")
    blank = docs.limit(1).selectExpr("-8L AS doc_id", "'' AS text", "lang", "source", "n_chars")
    marks = labels.select("doc_id", "toxic").unionByName(labels.limit(1).selectExpr("-1L AS doc_id", "1 AS toxic"))
    found = {r.doc_id: r.score for r in X.toxicity(docs.unionByName(once).unionByName(asked).unionByName(blank), marks).collect()}
    assert zlib.crc32(b"-1") % 3 != 1 and found[-7] > found[-8]


@pytest.mark.parametrize("marks", [X.MARKS, 0])
def test_beyond_the_broadcast_only_rare_tokens_are_shuffled(spark, data, monkeypatch, marks):
    docs, labels = data
    train = docs.join(labels.dropDuplicates(["doc_id"]), "doc_id").filter("toxic IN (0, 1)").select("text", "toxic")
    texts = docs.select(F.col("doc_id").alias("id"), "text").union(spark.createDataFrame([(None, "you scum"), (-1, None), (-1, "")], "id long, text string"))
    with session.intermediates(spark):
        entries = X.model(train).cache()
        want = sorted((str(r.id), r.value) for r in X.values(texts, entries).collect())
        monkeypatch.setattr(X, "BROADCAST_ROWS", entries.count() // 2)
        monkeypatch.setattr(X, "MARKS", marks)
        since = len(session._written.paths)
        got = sorted((str(r.id), r.value) for r in X.values(texts, entries).collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) for (_, a), (_, b) in zip(got, want))
        written = session._written.paths[since:]
        assert not any("/texts-" in path for path in written)
        sums = spark.read.parquet(next(path for path in written if "/sums-" in path))
        asked = sums.agg(F.sum(F.size("asked"))).first()[0]
        words = sums.agg(F.sum("n")).first()[0]
        # with the marks, hardly more than the occurrences of the rare half
        assert 0 < asked and (marks == 0 or asked < 0.2 * 2 * words)
        entries.unpersist()


def test_counted_tokens_of_each_text():
    owner, keys = np.array([1, 0, 1, 1, 0]), np.array([7, 5, 7, -2, 5])
    assert [x.tolist() for x in X.counted(owner, keys, True)] == [[0, 1, 1], [5, -2, 7], [True] * 3, [2, 1, 2]]
    assert [len(x) for x in X.counted(owner[:0], keys[:0], False)] == [0, 0, 0, 0]
