"""Texts cut into short pieces that can be encoded one by one, each distinct piece once a batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass
class Ragged:
    """Rows of numbers of different lengths, one after another."""

    values: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray], kind) -> Ragged:
        offsets = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) for r in rows], out=offsets[1:])
        return cls(np.concatenate(rows) if rows else np.zeros(0, kind), offsets)

    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def take(self, which: np.ndarray) -> Ragged:
        """The rows ``which``, in that order."""
        counts = self.lengths()[which]
        offsets = np.zeros(len(which) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        at = np.repeat(self.offsets[which] - offsets[:-1], counts)
        at += np.arange(offsets[-1])
        return Ragged(self.values[at], offsets)

    def grouped(self, bounds: np.ndarray) -> Ragged:
        """Rows joined: row n of the result is rows ``bounds[n]`` to ``bounds[n + 1]``."""
        return Ragged(self.values, self.offsets[bounds])


@dataclass
class Pieces:
    """Distinct pieces, the piece numbers of all texts in order, and each text's range of them."""

    distinct: list[bytes]
    numbers: np.ndarray
    bounds: np.ndarray


def cut(
    column: pa.Array,
    before: Callable[[np.ndarray], np.ndarray],
    change: Callable[[np.ndarray], np.ndarray] = lambda data: data,
) -> Pieces:
    """Texts of ``column`` (null: empty) cut before each byte that ``before`` marks.

    ``before`` gets the bytes of all texts in one array with a zero byte after each text, so no
    mark depends on the neighbouring text. ``change`` may put other bytes in the place of bytes.
    """
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    data = change(np.frombuffer(b"\0".join([*texts, b""]), np.uint8))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    marked = np.zeros(len(data) + 1, bool)
    marked[: len(data)] = before(data)
    marked[starts] = True
    marked[starts[1:] - 1] = True  # each text's zero byte is a piece of its own
    edges = np.flatnonzero(marked)
    pieces = pa.BinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    at = np.searchsorted(edges, starts)
    ends = np.zeros(len(edges) - 1, bool)
    ends[at[1:] - 1] = True
    bounds = at - np.arange(len(at))
    return Pieces(coded.dictionary.to_pylist(), coded.indices.to_numpy()[~ends], bounds)

