"""Helpers shared by the text operators: whole texts in bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: A word, for every operator here: a run of anything but the six ASCII blanks.
#: ``bytes.split()`` cuts at exactly these six.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text worked on at once; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes, null as the empty text."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]
