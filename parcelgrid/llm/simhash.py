"""Near-duplicate documents by SimHash and pivot distance tables.

Two fingerprints within ``MAX_BITS`` = 3 bits differ in at most three of six
segments, so they agree in three others: each of the 20 choices of three
segments shards the distinct fingerprints by the bits of its segments, and no
link is lost. Inside a shard a table holds each fingerprint's Hamming distances
to the pivots. By the triangle inequality, a pair whose distances to some pivot
differ by more than 3 is no link; only the others are compared bit by bit.

A pair counts in the first of its shards only. Shards put out a spanning
forest of their links, never all pairs, so a dense group of n near copies gives
at most n - 1 rows a shard. A shard of more than ``SHARD_ROWS`` fingerprints is
cut into chunks, and each pair of chunks is a piece of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from parcelgrid.llm import hot
from parcelgrid.llm.components import connected
from parcelgrid.llm.scratch import Kept
from parcelgrid.llm.texts import slices, utf8

MAX_BITS = 3
SHINGLE = 3
SEED = 42
PIVOTS = 16
SHARD_ROWS = 4096
#: Fingerprints compared as neighbours in sorted order; larger groups go in blocks.
NARROW = 32

WIDTHS = (11, 11, 11, 11, 10, 10)
SEGMENTS = [((1 << w) - 1) << sum(WIDTHS[:i]) for i, w in enumerate(WIDTHS)]
CHOICES = list(combinations(range(len(WIDTHS)), len(WIDTHS) - MAX_BITS))
MASKS = [sum(SEGMENTS[s] for s in choice) for choice in CHOICES]
#: By the set of differing segments: the first choice that avoids them all.
FIRST_CHOICE = np.array(
    [
        next((c for c, choice in enumerate(CHOICES) if not any(differing >> s & 1 for s in choice)), len(CHOICES))
        for differing in range(1 << len(WIDTHS))
    ]
)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shingle_hashes(words: list[bytes]) -> list[int]:
    """XXH64 of each run of three words, or of the whole sequence if it is shorter."""
    if len(words) < SHINGLE:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxh64_intdigest(b" ".join(run), SEED) for run in zip(*(words[i:] for i in range(SHINGLE)))]


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The 64-bit SimHash of each text; zero for a text without words."""
    hashes = [np.array(shingle_hashes(text.lower().split()), np.uint64) for text in texts]
    out = np.zeros(len(texts), np.uint64)
    for number, own in enumerate(hashes):
        votes = np.zeros(64, np.int64)
        for start in range(0, len(own), 1 << 16):
            part = own[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[number] = np.packbits(2 * votes > len(own), bitorder="little").view("<u8")[0]
    return out


def with_fingerprints(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with a LONG column of fingerprints after its own columns."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, 1 << 20):
            found = fingerprints(utf8(part.column(text_col))).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, name])

    return docs.mapInArrow(add, schema)


def pivots() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, PIVOTS, np.uint64)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.bitwise_count(prints[:, None] ^ pivots()[None, :]).astype(np.int8)


def verified(x: np.ndarray, y: np.ndarray, tx: np.ndarray, ty: np.ndarray, choice: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y) are links to be counted in ``choice``."""
    near = np.abs(tx - ty).max(axis=-1) <= MAX_BITS
    at = np.flatnonzero(near)
    differing = x[at] ^ y[at]
    links = np.bitwise_count(differing) <= MAX_BITS
    at, differing = at[links], differing[links]
    segments = sum((differing & np.uint64(mask) != 0).astype(np.int64) << s for s, mask in enumerate(SEGMENTS))
    return at[FIRST_CHOICE[segments] == choice[at]]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one linked with it, directly or not."""
    root = np.arange(n)
    while len(left):
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        open_links = low != high
        left, right, low, high = left[open_links], right[open_links], low[open_links], high[open_links]
        np.minimum.at(root, high, low)
        while not np.array_equal(root, up := root[root]):
            root = up
    return root


def shard_links(prints: np.ndarray, group: np.ndarray, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole groups; equal groups lie side by side."""
    n = len(prints)
    table = pivot_table(prints)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    end = np.repeat(starts + sizes, sizes)
    narrow = np.repeat(sizes <= NARROW, sizes)
    for gap in range(1, min(NARROW, int(sizes.max()))):
        i = np.flatnonzero(narrow & (np.arange(n) + gap < end))
        found = i[verified(prints[i], prints[i + gap], table[i], table[i + gap], choice[i])]
        left.append(found)
        right.append(found + gap)
    for start, size in zip(starts[sizes > NARROW], sizes[sizes > NARROW]):
        root = np.arange(size)
        for row in range(start, start + size - 1):
            later = np.arange(row + 1, start + size)
            one = np.full(len(later), prints[row])
            found = verified(one, prints[later], table[row], table[later], choice[later])
            joined = np.unique(np.append(root[found + row + 1 - start], root[row - start]))
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
        own = np.flatnonzero(root != np.arange(size))
        left.append(own + start)
        right.append(root[own] + start)
    root = forest(n, np.concatenate(left), np.concatenate(right))
    own = np.flatnonzero(root != np.arange(n))
    return own, root[own]


def links_of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (choice, masked, piece) to links; a group is held until it is whole."""

    def done(part: pa.Table) -> pa.RecordBatch:
        prints = part["fp"].to_numpy().view(np.uint64)
        choice = part["choice"].to_numpy().astype(np.int64)
        keys = [part["masked"].to_numpy(), choice, part["piece"].to_numpy()]
        change = np.zeros(len(prints), np.int64)
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        a, b = shard_links(prints, np.cumsum(change), choice)
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[a].view(np.int64)), pa.array(prints[b].view(np.int64))], ["a", "b"]
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole = pa.Table.from_batches(held)
        same = np.ones(whole.num_rows, bool)
        for name in ("choice", "masked", "piece"):
            column = whole[name].to_numpy()
            same &= column == column[-1]
        cut = whole.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield done(whole.slice(0, cut))
        held = whole.slice(cut).to_batches()
    if held:
        yield done(pa.Table.from_batches(held))


def masked_by_choice() -> Column:
    return F.explode(
        F.array(
            *(
                F.struct(F.lit(c).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("masked"))
                for c, mask in enumerate(MASKS)
            )
        )
    )


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """``a, b``: links that connect all fingerprints within three bits of one another.

    ``prints`` holds distinct, non-null LONGs in ``fp``.
    """
    shards = prints.select("fp", masked_by_choice().alias("s")).select("fp", "s.choice", "s.masked")
    crowded = shards.groupBy("choice", "masked").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(SHARD_ROWS)).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), chunks - 1),
        lambda other: F.greatest(chunk, other) * F.lit(1 << 16).cast("long") + F.least(chunk, other),
    )
    # shards are 20 times their file's rows, which Spark's estimate of their size leaves out: never broadcast
    pieces = shards.join(crowded.hint("merge"), ["choice", "masked"]).select("choice", "masked", F.explode(meets).alias("piece"), "fp")
    return (
        pieces.repartition("choice", "masked", "piece")
        .sortWithinPartitions("choice", "masked", "piece")
        .mapInArrow(links_of_shards, "a long, b long")
    )


def components_of(rows: DataFrame, id_col: str) -> DataFrame:
    """``fp, component_id``: the smallest id of any row whose fingerprint is reachable."""
    prints = Kept(rows.groupBy("fp").agg(F.min(id_col).alias("first")), "fingerprints").df
    roots = connected(fingerprint_links(prints.select("fp")), "a", "b")
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint, component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most three
    bits. Null and empty texts have fingerprint zero and link like any other.
    A null id is never the smallest, unless all are null; repeated rows repeat.
    An empty table gives no rows. Other columns are not looked at.
    """
    texts = docs.select(docs[id_col].alias(id_col), docs[text_col].cast("string").alias("_text"))
    rows = Kept(with_fingerprints(texts, "_text", "fp").select(id_col, "fp"), "prints").df
    found = components_of(rows, id_col)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, "fp").select(id_col, hexed.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each group of near duplicates, with all columns of ``docs``.

    Among rows of equal id one stays. Null ids come last. Columns of ``docs``
    may have any names; the ones added meanwhile are renamed out of the way.
    """
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    own_id, own_text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    marked = with_fingerprints(plain.withColumn(own_text, F.col(own_text).cast("string")), own_text, "fp")
    rows = Kept(marked.withColumn("row", F.monotonically_increasing_id()), "marked").df
    narrow = rows.select("row", "fp", F.col(own_id).alias("id"))
    found = components_of(narrow, "id").withColumnRenamed("component_id", "group")
    groups = narrow.join(found, "fp")
    # a group is known by its smallest id; groups of null ids alone by their fingerprints
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first")
    stays = groups.groupBy("group", F.when(F.col("group").isNull(), F.col("fp"))).agg(first).select(F.col("first.row").alias("row"))
    # mostly few rows go; then the texts are not shuffled
    goes = Kept(narrow.select("row").join(stays, "row", "left_anti"), "goes").df
    return rows.join(F.broadcast(goes) if hot.small(goes) else goes, "row", "left_anti").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
