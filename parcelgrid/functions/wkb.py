"""Well-known binary to and from polygons and points, on Arrow batches.

Spark has no function between doubles and their bytes, so these are Arrow
UDFs; each works on whole batches with array arithmetic, never row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERTEX_TYPE = T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType())
_RINGS_TYPE = T.ArrayType(T.ArrayType(_VERTEX_TYPE))

# Geometry codes and field sizes of the binary format.
POINT, POLYGON = 1, 3
_HEADER, _COUNT, _VERTEX = 5, 4, 16


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Write the bytes of each value at its own offset."""
    if len(at) == 0:
        return
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(at), -1)
    out[at[:, None] + np.arange(raw.shape[1])] = raw


def _binary(out: np.ndarray, starts: np.ndarray, missing: np.ndarray) -> pa.Array:
    valid = pa.array(~missing).buffers()[1]
    return pa.Array.from_buffers(
        pa.binary(),
        len(missing),
        [valid, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(out)],
        null_count=int(missing.sum()),
    )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(element count per row, missing flag per row, flat elements)."""
    missing = np.asarray(column.is_null())
    counts = np.asarray(column.value_lengths().fill_null(0))
    return counts, missing, column.flatten()


def encode_polygons(column: pa.Array) -> pa.Array:
    ring_counts, missing, rings = _lists(column)
    vertex_counts, _, vertices = _lists(rings)
    ring_sizes = _COUNT + _VERTEX * vertex_counts
    ring_ends = _starts(ring_sizes)
    first_ring = _starts(ring_counts)
    row_sizes = np.where(missing, 0, _HEADER + _COUNT + ring_ends[first_ring[1:]] - ring_ends[first_ring[:-1]])
    starts = _starts(row_sizes)
    out = np.zeros(starts[-1], dtype=np.uint8)
    here = starts[:-1][~missing]
    _put(out, here, np.ones(len(here), dtype="u1"))
    _put(out, here + 1, np.full(len(here), POLYGON, dtype="<u4"))
    _put(out, here + _HEADER, ring_counts[~missing].astype("<u4"))
    row_of_ring = np.repeat(np.arange(len(ring_counts)), ring_counts)
    ring_at = (
        starts[:-1][row_of_ring] + _HEADER + _COUNT + ring_ends[:-1] - ring_ends[first_ring[:-1][row_of_ring]]
    )
    _put(out, ring_at, vertex_counts.astype("<u4"))
    ring_of_vertex = np.repeat(np.arange(len(vertex_counts)), vertex_counts)
    place = np.arange(len(ring_of_vertex)) - _starts(vertex_counts)[:-1][ring_of_vertex]
    xy = np.column_stack(
        [np.asarray(vertices.field("x").fill_null(np.nan)), np.asarray(vertices.field("y").fill_null(np.nan))]
    ).astype("<f8")
    _put(out, ring_at[ring_of_vertex] + _COUNT + _VERTEX * place, xy)
    return _binary(out, starts, missing)


def encode_points(x: pa.Array, y: pa.Array) -> pa.Array:
    missing = np.asarray(x.is_null()) | np.asarray(y.is_null())
    starts = _starts(np.where(missing, 0, _HEADER + _VERTEX))
    out = np.zeros(starts[-1], dtype=np.uint8)
    here = starts[:-1][~missing]
    _put(out, here, np.ones(len(here), dtype="u1"))
    _put(out, here + 1, np.full(len(here), POINT, dtype="<u4"))
    xy = np.column_stack([np.asarray(x.fill_null(0.0)), np.asarray(y.fill_null(0.0))])[~missing]
    _put(out, here + _HEADER, xy.astype("<f8"))
    return _binary(out, starts, missing)


class _Bytes:
    """Numbers read at many offsets of one batch, each row in its own byte order."""

    def __init__(self, column: pa.Array):
        # a little zero padding lets short values be met without reading past the end
        flat = pa.concat_arrays([column.fill_null(b""), pa.array([bytes(_VERTEX)], pa.binary())])
        offsets = np.frombuffer(flat.buffers()[1], dtype=np.int32)[flat.offset : flat.offset + len(flat) + 1]
        self.data = np.frombuffer(flat.buffers()[2], dtype=np.uint8)
        self.start, self.end = offsets[:-2].astype(np.int64), offsets[1:-1].astype(np.int64)
        self.missing = np.asarray(column.is_null())
        self.big = np.zeros(len(column), dtype=bool)
        self.big[~self.missing] = self.data[self.start[~self.missing]] == 0

    def read(self, rows: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
        size = np.dtype(kind).itemsize
        if np.any(at + size > self.end[rows]):
            raise ValueError("geometry bytes end early")
        raw = np.ascontiguousarray(self.data[at[:, None] + np.arange(size)])
        little = raw.view("<" + kind).ravel()
        return np.where(self.big[rows], raw.view(">" + kind).ravel(), little)


def decode_polygons(column: pa.Array) -> pa.Array:
    data = _Bytes(column)
    rows = np.flatnonzero(~data.missing)
    kinds = data.read(rows, data.start[rows] + 1, "u4")
    if np.any(kinds != POLYGON):
        raise ValueError(f"only polygons (code {POLYGON}) are supported, found {sorted(set(kinds.tolist()))}")
    ring_counts = np.zeros(len(column), dtype=np.int64)
    ring_counts[rows] = data.read(rows, data.start[rows] + _HEADER, "u4")
    first_ring = _starts(ring_counts)
    vertex_counts = np.zeros(first_ring[-1], dtype=np.int64)
    ring_at = np.zeros(first_ring[-1], dtype=np.int64)
    cursor = data.start + _HEADER + _COUNT
    # one pass per ring number: rows with that many rings move on together
    for k in range(int(ring_counts.max(initial=0))):
        live = np.flatnonzero(ring_counts > k)
        n = data.read(live, cursor[live], "u4").astype(np.int64)
        vertex_counts[first_ring[live] + k] = n
        ring_at[first_ring[live] + k] = cursor[live] + _COUNT
        cursor[live] += _COUNT + _VERTEX * n
    row_of_ring = np.repeat(np.arange(len(column)), ring_counts)
    ring_of_vertex = np.repeat(np.arange(len(vertex_counts)), vertex_counts)
    ends = _starts(vertex_counts)
    at = ring_at[ring_of_vertex] + _VERTEX * (np.arange(ends[-1]) - ends[:-1][ring_of_vertex])
    row_of_vertex = row_of_ring[ring_of_vertex]
    vertices = pa.StructArray.from_arrays(
        [
            pa.array(data.read(row_of_vertex, at, "f8")),
            pa.array(data.read(row_of_vertex, at + 8, "f8")),
        ],
        names=["x", "y"],
    )
    rings = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), vertices)
    return pa.ListArray.from_arrays(
        pa.array(first_ring.astype(np.int32)), rings, mask=pa.array(data.missing)
    )


def decode_points(column: pa.Array) -> pa.Array:
    data = _Bytes(column)
    rows = np.flatnonzero(~data.missing)
    kinds = data.read(rows, data.start[rows] + 1, "u4")
    if np.any(kinds != POINT):
        raise ValueError(f"only points (code {POINT}) are supported, found {sorted(set(kinds.tolist()))}")
    xy = np.zeros((len(column), 2))
    xy[rows, 0] = data.read(rows, data.start[rows] + _HEADER, "f8")
    xy[rows, 1] = data.read(rows, data.start[rows] + _HEADER + 8, "f8")
    return pa.StructArray.from_arrays(
        [pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"], mask=pa.array(data.missing)
    )


@F.arrow_udf(T.BinaryType())
def wkb_of_polygon(rings: pa.Array) -> pa.Array:
    return encode_polygons(rings)


@F.arrow_udf(T.BinaryType())
def wkb_of_point(x: pa.Array, y: pa.Array) -> pa.Array:
    return encode_points(x, y)


@F.arrow_udf(_RINGS_TYPE)
def polygon_of_wkb(data: pa.Array) -> pa.Array:
    return decode_polygons(data)


@F.arrow_udf(_VERTEX_TYPE)
def point_of_wkb(data: pa.Array) -> pa.Array:
    return decode_points(data)
