import pytest
from helpers import rows_of
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from parcelgrid.llm import hot
from parcelgrid.llm import token_cache as C


@pytest.mark.parametrize("file", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_are_the_library_s(docs, empty, clashing, file):
    if file.endswith(".model"):
        pieces = SentencePieceProcessor(model_file=path(file))
        count = lambda t: len(pieces.encode(t))
    else:
        library = Tokenizer.from_file(path(file))
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    want = []
    for r in docs.collect():
        n = count(r.text or "")
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 4096))
    assert rows_of(C.token_counts(docs, tokenizer=file)) == sorted(want, key=repr)
    assert rows_of(C.token_counts(clashing, tokenizer=file)) == sorted(want, key=repr)
    assert C.token_counts(empty, tokenizer=file).count() == 0


def test_only_misses_are_encoded(spark, docs, tmp_path):
    folder = str(tmp_path / "cache")
    first = rows_of(C.token_counts(docs.filter("doc_id < 200"), folder))
    stored = spark.read.parquet(folder)
    before = stored.count()
    assert before == docs.filter("doc_id < 200").selectExpr("coalesce(text, '')").distinct().count()
    again = rows_of(C.token_counts(docs.filter("doc_id < 200"), folder))
    assert again == first and spark.read.parquet(folder).count() == before
    C.token_counts(docs, folder).count()
    whole = spark.read.parquet(folder)
    assert whole.count() == docs.selectExpr("coalesce(text, '')").distinct().count()
    # what is stored is believed, so nothing was encoded anew
    marked = whole.selectExpr("digest", "version", "-1L AS n_tokens")
    marked.write.partitionBy("version").parquet(str(tmp_path / "marked"))
    assert {r.n_tokens for r in C.token_counts(docs, str(tmp_path / "marked")).collect()} == {-1}
    # another tokenizer's counts are no hits
    other = C.token_counts(docs, str(tmp_path / "marked"), tokenizer="byte_bpe_50k.json")
    assert other.filter("n_tokens = -1").count() == 0


def test_full_cache_reads_no_text_again(docs, tmp_path, monkeypatch):
    folder = str(tmp_path / "cache")
    first = rows_of(C.token_counts(docs, folder))
    monkeypatch.setattr(C, "encode_misses", None)
    assert rows_of(C.token_counts(docs, folder)) == first


def test_joins_that_shuffle(docs, tmp_path, monkeypatch):
    """Many misses, and a hot text among them."""
    monkeypatch.setattr(hot, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(hot, "HOT_SHARE", 20)
    want = rows_of(C.token_counts(docs, str(tmp_path / "a")))
    assert len(want) == docs.count()
    monkeypatch.undo()
    assert rows_of(C.token_counts(docs, str(tmp_path / "b"))) == want
