import random
import zlib

import numpy as np
from helpers import rows_of
from public_tokenizers import path
from tokenizers import Tokenizer

from parcelgrid.llm import packing as P
from parcelgrid.llm.tokens import WordIds

FILE = "word_bpe_49k.json"


LIBRARY = Tokenizer.from_file(path(FILE))


def plain_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_cached_ids_are_the_library_s(texts):
    rng = random.Random(1)
    odd = ["".join(rng.choice("aBé'<|>.,# \n\t\x1c2½ßÿ÷×ſ́") for _ in range(40)) for _ in range(200)]
    own = [t for t in texts if len(t or "") < 6000] + odd
    for cache in (WordIds(FILE), WordIds(FILE, most=50)):
        for start in range(0, len(own), 40):
            part = own[start : start + 40]
            for text, ids in zip(part, cache.of(part)):
                assert np.frombuffer(ids, "<u2").tolist() == plain_ids(text), text


def test_pieces_cover_every_document_once(docs, empty, clashing):
    found = P.pack(clashing).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(plain_ids(r.text) + [1])
    by_doc = {}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes())
        assert r.length == len(r.ids) // 2 > 0 and r.offset + r.length <= 2048
        by_doc.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u2").tolist(), r.doc_tokens))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        copies = len(texts[doc])
        want = sorted(x for ids in texts[doc] for x in ids)
        assert sorted(x for _, ids, _ in pieces for x in ids) == want
        if copies == 1:
            assert [x for _, ids, _ in sorted(pieces) for x in ids] == texts[doc][0]
            assert {n for _, _, n in pieces} == {len(texts[doc][0])}
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    ends = {s: 0 for s in sequences}
    for s, own in sequences.items():
        for offset, length in sorted(own):
            assert offset == ends[s]
            ends[s] += length
    assert [ends[s] for s in sorted(ends)][:-1] == [2048] * (len(ends) - 1)
    assert P.pack(empty).count() == 0
    joined = {r.sequence_id: len(r.ids) // 2 for r in P.sequences(P.pack(docs)).collect()}
    assert joined == ends


def test_curve_visits_neighbours():
    """Keys of a whole grid are 0 … n - 1, and consecutive ones are one step apart."""
    before = P.BITS
    P.BITS = 2
    try:
        points = np.stack(np.meshgrid(*[np.arange(4)] * 4, indexing="ij"), -1).reshape(-1, 4)
        keys = P.hilbert_keys(points)
    finally:
        P.BITS = before
    assert sorted(keys) == list(range(256))
    along = points[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_lie_together(spark):
    rng = random.Random(3)
    pools = [[f"{c}{i}" for i in range(200)] for c in ("xa", "yo", "zu")]
    rows = [(i, " ".join(rng.choices(pools[i % 3], k=300))) for i in range(90)]
    found = P.pack(spark.createDataFrame(rows, "doc_id long, text string")).filter("start = 0")
    order = [r.doc_id % 3 for r in found.orderBy("sequence_id", "offset").collect()]
    changes = sum(a != b for a, b in zip(order, order[1:]))
    assert changes < 30  # 59 in a random order


def test_one_text_for_all(spark):
    rows = spark.range(400).selectExpr("id AS doc_id", "'the very same text' AS text")
    assert rows_of(P.pack(rows).groupBy("doc_id").sum("length"))[0][1] > 0
    assert P.pack(rows).select("doc_id").distinct().count() == 400
