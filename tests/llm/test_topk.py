import math
import random

import pytest
from helpers import rows_of

from parcelgrid.llm import topk as K


def brute(rows, every, k=5):
    own = {}
    for i, x in rows:
        if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            q = [math.floor(256 * v) for v in x]
            own[i] = min(own.get(i, q), q, key=lambda v: (len(v), v))
    out = []
    for i, x in own.items():
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in own.items() if j != i and len(y) == len(x))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8192, 40])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK_ROWS", block)
    monkeypatch.setattr(K, "CHUNK_QUERIES", 7)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(60)]  # many ties
    rows += [(400 + i, [0.0] * 8) for i in range(12)]
    rows += [(500, None), (510, [1.0, None] * 4), (520, [float("nan")] * 8), (530, [float("inf")] * 8)]
    rows += [(540, []), (550, [0.5, 1.0]), (560, [0.25, -1.0]), (None, [1.0] * 8), (10, rows[3][1]), (20, rows[20][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    single = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(single, 10)
    assert rows_of(K.top_k(table, "vec_id % 10 = 0")) == want
    clash = table.selectExpr("*", "1 AS d", "2 AS block", "3 AS x", "4 AS `rank`")
    assert rows_of(K.top_k(clash, "vec_id % 10 = 0")) == want


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert rows_of(K.top_k(table, "vec_id % 50 = 0")) == [(0, 1, 1, 256 * 512)]
    assert K.top_k(table.limit(0), "vec_id % 50 = 0").count() == 0


def test_search_stops_early():
    import numpy as np

    rng = np.random.default_rng(0)
    rows = (rng.standard_normal((4000, 4)) * 100).astype(np.int64).astype(float)
    block = K.Block(np.arange(4000), rows)
    reads = []
    block.rows = Counting(rows, reads)
    ids, scores = block.search(0, rows[0], 5, None)
    want = sorted((-(rows[j] @ rows[0]), j) for j in range(1, 4000))[:5]
    assert [(-s, i) for i, s in zip(ids, scores)] == want
    assert sum(reads) < 3000


class Counting:
    def __init__(self, rows, reads):
        self.rows, self.reads, self.shape, self.dtype = rows, reads, rows.shape, rows.dtype

    def __getitem__(self, at):
        self.reads.append(len(at))
        return self.rows[at]
