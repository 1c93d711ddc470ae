"""Pack documents along a space-filling curve.

The words of a document, as hashed token counts of unit length, are projected
on a few dimensions; the Hilbert key of that point orders the documents, so
neighbours on the curve have similar words. The documents are range-sorted by
(key, row) and laid end to end; the line is cut every ``length`` ids. Only the
last sequence is padded.

Only narrow rows are sorted; the ids themselves are shuffled once, to meet
their places. A third of all documents may share one key: the row number splits
them over partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.llm.scratch import Kept
from parcelgrid.llm.texts import slices
from parcelgrid.llm.tokens import word_ids

BUCKETS = 1024
DIMENSIONS = 4
BITS = 15
SEED = 7


@dataclass(frozen=True)
class Packing:
    tokenizer: str = "word_bpe_49k.json"
    end_id: int = 1
    length: int = 2048


def projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS))


def grid_points(ids: list[np.ndarray]) -> np.ndarray:
    """Each document's point, as ``DIMENSIONS`` integers of ``BITS`` bits."""
    counts = np.zeros((len(ids), BUCKETS))
    for row, own in zip(counts, ids):
        # Knuth's multiplicative hash of the id, to the top bits
        hashed = own.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(22)
        row[:] = np.bincount(hashed, minlength=BUCKETS)
    norm = np.linalg.norm(counts, axis=1, keepdims=True)
    points = (counts / np.where(norm > 0, norm, 1)) @ projection()
    # coordinates are near to standard normal, so this spreads them over the grid
    uniform = 0.5 + 0.5 * np.vectorize(erf, otypes=[float])(points / np.sqrt(2)) if len(ids) else points
    return np.minimum((uniform * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Positions on the Hilbert curve, after Skilling's transform of the axes."""
    x = [points[:, d].copy() for d in range(points.shape[1])]
    n = len(x)
    for q in (1 << b for b in range(BITS - 1, 0, -1)):
        for d in range(n):
            high = (x[d] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(BITS - 1, 0, -1)):
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for d in range(n):
            key = key << 1 | ((x[d] ^ flip) >> bit & 1)
    return key


def encoded(docs: DataFrame, id_col: str, text_col: str, how: Packing) -> DataFrame:
    """``id, row, key, n, ids`` of each document; ids as 16-bit little-endian bytes."""
    source = docs.select(
        docs[id_col].alias("id"),
        F.monotonically_increasing_id().alias("row"),
        docs[text_col].cast("string").alias("text"),
    )
    schema = T.StructType([source.schema["id"], *T._parse_datatype_string("row long, key long, n long, ids binary")])
    end = np.array([how.end_id], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = word_ids(how.tokenizer).of(part.column("text").to_pylist())
            keys = hilbert_keys(grid_points([np.frombuffer(ids, "<u2") for ids in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("row"),
                    pa.array(keys),
                    pa.array([len(ids) // 2 + 1 for ids in found], pa.int64()),
                    pa.array([ids + end for ids in found], pa.binary()),
                ],
                ["id", "row", "key", "n", "ids"],
            )

    return source.mapInArrow(encode, schema)


def places(rows: DataFrame) -> DataFrame:
    """``row, first``: how many ids lie before each document along the curve."""
    ranged = Kept(
        rows.select("row", "key", "n").repartitionByRange("key", "row").withColumn("part", F.spark_partition_id()),
        "ranged",
    ).df
    # one row per partition
    totals = ranged.groupBy("part").agg(F.sum("n").alias("held"))
    before = totals.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("key", "row")) - F.col("n")
    return ranged.withColumn("inside", inside).join(F.broadcast(before), "part").select(
        "row", (F.col("before") + F.col("inside")).alias("first")
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Packing = Packing()) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    A document is its text's ids and the end id, so null and empty texts are
    one id. It is cut where a sequence is full, and a very long one spans many.
    Repeated rows are packed each for itself, null ids are carried along, an
    empty table gives no rows, and other columns are not looked at. ``ids`` are
    16-bit little-endian; the CRC-32 is over the same ids with 32 bits.
    """
    rows = Kept(encoded(docs, id_col, text_col, how), "encoded").df
    placed = rows.join(places(rows), "row").select("id", "n", "ids", "first")
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            *(T.StructField(name, T.LongType()) for name in names[1:-1]),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "ids"):
            first = part.column("first").to_numpy()
            n = part.column("n").to_numpy()
            begun = first // how.length
            pieces = (first + n - 1) // how.length - begun + 1
            owner = np.repeat(np.arange(len(n)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = begun[owner] + number
            opens = np.maximum(sequence * how.length, first[owner])
            closes = np.minimum((sequence + 1) * how.length, (first + n)[owner])
            start = opens - first[owner]
            size = closes - opens
            raw = part.column("ids").to_pylist()
            own = [raw[o][2 * a : 2 * (a + s)] for o, a, s in zip(owner.tolist(), start.tolist(), size.tolist())]
            crc = [zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes()) for ids in own]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(owner)),
                    pa.array(start),
                    pa.array(size),
                    pa.array(crc, pa.int64()),
                    pa.array(n[owner]),
                    pa.array(sequence),
                    pa.array(opens - sequence * how.length),
                    pa.array(own, pa.binary()),
                ],
                names,
            )

    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the pieces of each sequence in order; a sequence is at most ``length`` ids."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
