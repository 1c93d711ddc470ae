"""Quality rules from a suffix array over the words of each text.

The suffix array of a slice of texts is built by prefix doubling: after step k,
two suffixes have the same rank if and only if they agree in their first 2**k
words. Every text ends in a word of its own, so no repeat crosses texts. The
ranks of all steps are kept, which gives the longest common prefix (LCP) of
neighbouring suffixes by descending through them.

A suffix lies in LCP intervals up to the larger LCP with its two neighbours, so
the union of the spans of all maximal repeats of at least ``min_repeat`` words
is the union of ``[i, i + lcp)`` over the suffixes whose LCP reaches that length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelgrid.llm.texts import slices, utf8

#: Counted as symbols.
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class Rules:
    """What a text must satisfy.

    A text fails the base rules with fewer than ``min_words`` words, or if the
    repeated windows of ``window`` words cover over ``max_window_share`` percent
    of it. It fails the repeat rules if maximal repeats of ``min_repeat`` words
    or more cover over ``max_covered`` of its words, or if the longest repeat
    has at least ``long_repeat`` words and over ``max_longest`` of all.
    """

    min_words: int = 20
    window: int = 8
    max_window_share: int = 30
    min_repeat: int = 8
    max_covered: float = 0.3
    long_repeat: int = 50
    max_longest: float = 0.2


STATS = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("covered_words", pa.int64()),
    ("longest_repeat", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
]


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``words``, and the ranks by the first 1, 2, 4 … words.

    The last word must occur nowhere else. Suffixes that are alone with their
    rank take no further part in the sorting.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[heads, n])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, sizes)
    levels = [rank]
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    step = 1
    while len(slots):
        tied = order[slots]
        key = rank[tied] * (n + 1) + rank[tied + step]
        by_key = np.argsort(key, kind="stable")
        tied, key = tied[by_key], key[by_key]
        order[slots] = tied
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[heads, len(key)])
        rank = rank.copy()
        rank[tied] = np.repeat(slots[heads], sizes)
        levels.append(rank)
        slots = slots[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order, levels


def repeat_lengths(words: np.ndarray) -> np.ndarray:
    """For each position, the words from there that occur at another position as well."""
    n = len(words)
    order, levels = suffix_order(words)
    left, right = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    open_pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[open_pairs], right[open_pairs]
    common = np.zeros(len(open_pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # a position past the end is only reached by pairs that differ at once
        same = levels[k][left] == levels[k][right]
        common[same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    lcp[open_pairs] = common
    longest = np.zeros(n, np.int64)
    longest[order[:-1]] = lcp
    longest[order[1:]] = np.maximum(longest[order[1:]], lcp)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the spans."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def describe(texts: list[bytes], rules: Rules) -> dict[str, np.ndarray]:
    """The figures of each text and its verdict."""
    ids: defaultdict[bytes, int] = defaultdict(count(len(texts)).__next__)
    parts, ends, at = [], [], 0
    word_chars, symbols, dup_lines = [], [], []
    for number, text in enumerate(texts):
        words = text.split()
        parts.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        parts.append(np.array([number]))  # the word that ends this text, and no other
        at += len(words) + 1
        ends.append(at)
        raw = np.frombuffer(text, np.uint8)
        blank = sum(text.count(c) for c in (b"%c" % b for b in BLANKS))
        word_chars.append(int(np.count_nonzero((raw & 0xC0) != 0x80)) - blank)
        symbols.append(sum(text.count(c) for c in (b"%c" % b for b in SYMBOLS)))
        lines = [line for line in text.split(b"\n") if line.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    stop = np.array(ends)
    n_words = np.diff(np.r_[0, stop]) - 1
    flat = np.concatenate(parts)
    owner = np.repeat(np.arange(len(texts)), n_words + 1)
    # words are told apart by text, so that only repeats within a text tie
    flat = owner * (len(ids) + len(texts)) + flat
    length = repeat_lengths(flat)
    sums = []
    for least, span in ((rules.window, rules.window), (rules.min_repeat, None)):
        at = np.flatnonzero(length >= least)
        inside = covered(at, np.full(len(at), span) if span else length[at], len(flat))
        sums.append(np.bincount(owner[inside], minlength=len(texts)))
    repeat_words, covered_words = sums
    longest = np.maximum.reduceat(length, np.r_[0, stop[:-1]])
    base_failed = (n_words < rules.min_words) | (100 * repeat_words > rules.max_window_share * n_words)
    repeats = (covered_words > rules.max_covered * n_words) | (
        (longest >= rules.long_repeat) & (longest > rules.max_longest * n_words)
    )
    return {
        "n_words": n_words,
        "word_chars": np.array(word_chars),
        "n_symbols": np.array(symbols),
        "n_dup_lines": np.array(dup_lines),
        "n_repeat_words": repeat_words,
        "covered_words": covered_words,
        "longest_repeat": longest,
        "base_failed": base_failed,
        "kept": ~(base_failed | repeats),
    }


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: its id, the figures and ``kept``.

    Whole texts are read; a null text counts as the empty one, which has no
    words and fails. Repeated rows give repeated results, an empty table gives
    an empty result, and columns besides the two named are not looked at.
    """
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].cast("string").alias("_text"))
    names = [id_col, *(name for name, _ in STATS)]
    schema = T.StructType(
        [
            T.StructField(id_col, source.schema[id_col].dataType),
            *(T.StructField(name, T.BooleanType() if kind == pa.bool_() else T.LongType()) for name, kind in STATS),
        ]
    )

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            found = describe(utf8(part.column("_text")), rules)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *(pa.array(found[name], kind) for name, kind in STATS)], names
            )

    return source.mapInArrow(figures, schema)


def without_repetitive(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns.

    Null and empty texts go, repeated rows share one verdict, and an empty
    table stays empty. No column is added, so no name can clash.
    """

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            yield part.filter(pa.array(describe(utf8(part.column(text_col)), rules)["kept"]))

    return docs.mapInArrow(survivors, docs.schema)
