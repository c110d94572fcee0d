"""Columns of text as byte arrays: token runs, hashes, and Arrow batches with added columns.

Texts are handled as UTF-8 bytes, many documents in one array, so that the per-token work is
vectorised. A null text counts as empty. A slice holds whole documents of about ``SLICE_BYTES``
together (one longer document is a slice of its own), which bounds what a task needs beside
the Arrow batch itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of a hash may be used."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Slice:
    """Documents ``first`` to ``first + count`` of a batch, joined with a line feed after each."""

    first: int
    count: int
    data: np.ndarray
    starts: np.ndarray

    def document(self, positions: np.ndarray) -> np.ndarray:
        """The document, counted from ``first``, that each byte position lies in."""
        return np.searchsorted(self.starts, positions, side="right") - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    texts = column.cast(pa.binary()).to_pylist()
    first, size, held = 0, 0, []
    for n, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > limit:
            yield _joined(first, held)
            first, size, held = n, 0, []
        held.append(text)
        size += len(text) + 1
    if held:
        yield _joined(first, held)


def _joined(first: int, held: list[bytes]) -> Slice:
    starts = np.zeros(len(held), np.int64)
    np.cumsum([len(t) + 1 for t in held[:-1]], out=starts[1:])
    return Slice(first, len(held), np.frombuffer(b"\n".join([*held, b""]), np.uint8), starts)


def byte_classes(**members: Iterable[int]) -> np.ndarray:
    """A table from byte to class: 0, or the number of the argument that lists the byte."""
    table = np.zeros(256, np.uint8)
    for n, bytes_ in enumerate(members.values(), 1):
        table[list(bytes_)] = n
    return table


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def runs(data: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes of one class that is not 0."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[data]
    cuts = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate(([0], cuts))
    ends = np.concatenate((cuts, [len(data)]))
    inside = kind[starts] != 0
    return starts[inside], ends[inside]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run; equal bytes have equal hashes wherever they stand.

    Eight bytes at a time are mixed by themselves, under a key for their place in the run, and added up. No
    run of different bytes is bound to collide, as some are under any polynomial of 64 bits.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
    size = ends - starts
    total = size.astype(np.uint64) * _BASE
    some = np.flatnonzero(size > 0)
    count = (size[some] + 7) >> 3
    first = np.cumsum(count) - count
    place = np.arange(int(count.sum())) - np.repeat(first, count)
    lane = lanes[np.repeat(starts[some], count) + 8 * place]
    # The last lane of a run may hold bytes beyond it.
    over = (8 * count - size[some]).astype(np.uint64) << np.uint64(3)
    lane[first + count - 1] &= ~np.uint64(0) >> over
    keys = mix(np.arange(1, int(count.max(initial=0)) + 1, dtype=np.uint64) * _BASE)
    if len(some):
        total[some] += np.add.reduceat(mix(lane ^ keys[place]), first)
    return mix(total)


def shingled(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` neighbouring words of one owner, and the owners."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), owner[:0]
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _BASE + words[k : k + n]
    whole = owner[:n] == owner[size - 1 :]
    return mix(total[whole]), owner[:n][whole]


def per_document(count: int, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=count)


def append(
    frame: DataFrame,
    fields: list[T.StructField],
    compute: Callable[[pa.RecordBatch], list[pa.Array]],
    by: str | None = None,
) -> DataFrame:
    """``frame`` with ``fields`` computed from each Arrow batch.

    Columns of the frame with one of the new names are replaced. With ``by``, a column of texts or
    lists, batches are first cut so that those hold a few megabytes together.
    """
    names = {f.name for f in fields}
    kept = frame.select(*[quoted(c) for c in frame.columns if c not in names])
    schema = T.StructType([*kept.schema.fields, *fields])
    width = len(kept.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, end in spans(whole.column(by)) if by else [(0, len(whole))]:
                batch = whole.slice(first, end - first)
                arrays = [batch.column(n) for n in range(width)]
                yield pa.RecordBatch.from_arrays(arrays + compute(batch), names=schema.names)

    return kept.mapInArrow(run, schema)


def spans(column: pa.Array, limit: int = 8 << 20) -> list[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes or list elements together, at least one row each."""
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    sizes = pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    found, first, held = [], 0, 0
    for n, size in enumerate(sizes.tolist()):
        if n > first and held + size > limit:
            found.append((first, n))
            first, held = n, 0
        held += size
    if len(sizes):
        found.append((first, len(sizes)))
    return found


def spare(frame: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``frame`` does not have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
