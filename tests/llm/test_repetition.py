import random

import numpy as np
from brute import repeats, words
from helpers import rows_of, sentence

from parcelgrid.llm.repetition import Rules, describe, repetition, suffix_order, without_repetitive


def test_suffix_order_sorts_suffixes():
    rng = random.Random(3)
    for k in (1, 2, 5):
        own = np.array([rng.randint(1, k) for _ in range(80)] + [0])
        order, _ = suffix_order(own)
        assert list(order) == sorted(range(len(own)), key=lambda i: tuple(own[i:]))


def test_figures_against_brute_force(texts):
    rng = random.Random(4)
    own = [t or "" for t in texts if len(t or "") < 4000]
    own += [" ".join(rng.choice("abc"[:k]) for _ in range(rng.randint(1, 60))) for k in (1, 2, 3) for _ in range(20)]
    own += [" ".join((base := sentence(rng, 30).split()) + base[4:25]) for _ in range(10)]
    found = describe([t.encode() for t in own], Rules())
    for i, text in enumerate(own):
        inside, longest = repeats(text)
        n = len(words(text))
        assert found["n_words"][i] == n
        assert found["word_chars"][i] == sum(map(len, words(text)))
        assert found["n_symbols"][i] == sum(c in "#*$%&|<>" for c in text)
        lines = [line for line in text.split("\n") if words(line)]
        assert found["n_dup_lines"][i] == len(lines) - len(set(lines))
        assert (found["n_repeat_words"][i], found["longest_repeat"][i]) == (inside, longest), text
        failed = n < 20 or 100 * inside > 30 * n
        assert found["base_failed"][i] == failed
        assert found["kept"][i] == (not failed and not (longest >= 50 and longest > 0.2 * n))


def test_long_repeat_fails_only_the_method():
    rng = random.Random(8)
    half = sentence(rng, 60)
    text = " ".join([half, sentence(rng, 300), half])
    got = describe([text.encode()], Rules(max_longest=0.1))
    assert not got["base_failed"][0] and not got["kept"][0] and got["longest_repeat"][0] == 60


def test_table_forms(docs, empty, clashing):
    found = repetition(docs)
    assert found.count() == docs.count()
    assert rows_of(repetition(clashing)) == rows_of(found)
    assert repetition(empty).count() == 0 and without_repetitive(empty).columns == empty.columns
    kept = without_repetitive(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == found.filter("kept").count()
