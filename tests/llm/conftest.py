import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers import edited, sentence  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, empties, nulls, odd blanks, a long text, repeats, special strings."""
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(20, 60)) for _ in range(25)]
    out = [None, "", " \n\t ", "One", "Two words", "İstanbul Straße ÉTÉ ñandú  x y \x85z"]
    out += base + base[:6] + [edited(rng, base[i % 5], 2) for i in range(12)]
    out += [base[7] + "\n" + base[8] + "\n\n  " + base[7].upper() + "  \n" + sentence(rng, 30)]
    out += ["\n".join([base[9], "", "same here", sentence(rng, 25), "same here"])]
    out += ["For " * 300, " ".join(base[:3] * 4), "a" * 5000, sentence(rng, 9000)]
    out += ["<|endoftext|> it's 2,5 don't### <|startoftext|>x", "a\x1cb \x1d c", "日本語 テスト é é"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """A table of those texts with repeated rows, a null id and a null source."""
    sources = ["a", "b", "a", None, "Z", "é", "a"]
    rows = [(10 * i, t, "en", sources[i % 7], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, texts[9], None, "b", None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with further columns, named as operators name their own."""
    names = ["row", "fp", "id", "key", "size", "n", "kept", "rule", "_text", "digest", "ids", "source_size", "c0", "line"]
    return docs.selectExpr("*", *(f"'x' AS `{name}`" for name in names))
