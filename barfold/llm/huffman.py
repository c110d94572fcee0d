"""Canonical length-limited Huffman codes: lengths from counts, packing, table-driven unpacking.

A code is given by its lengths alone: symbols in order of (length, symbol) take consecutive code
words. Lengths are at most ``limit``, by package-merge, so one table lookup decodes a symbol.
Rows are packed from a byte boundary on, with a checkpoint (bit offset) every ``STEP`` symbols,
from which each stretch can be decoded by itself; many stretches are decoded side by side.
"""

from __future__ import annotations

import numpy as np

from barfold.llm.pieces import Ragged

STEP = 512
LIMIT = 18


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each symbol, 0 for those that do not occur; optimal among codes up to ``limit``."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes longer than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    packages, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        weights = np.concatenate((leaves, packages))
        rank = np.argsort(weights, kind="stable")
        levels.append(rank < len(leaves))
        weights = weights[rank]
        pairs = len(weights) // 2
        packages = weights[: 2 * pairs].reshape(pairs, 2).sum(1)
    taken = 2 * len(order) - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:taken].sum())
        lengths[order[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


class Code:
    """Code words and the decoding table of code lengths."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = np.asarray(lengths, np.int64)
        self.limit = max(1, int(self.lengths.max(initial=1)))
        order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        width = np.int64(1) << (self.limit - self.lengths[order])
        first = np.cumsum(width) - width
        self.words = np.zeros(len(self.lengths), np.uint64)
        self.words[order] = first >> (self.limit - self.lengths[order])
        table = np.repeat(order, width)
        self.symbol = np.zeros(1 << self.limit, np.uint32)
        self.symbol[: len(table)] = table
        self.step = np.ones(1 << self.limit, np.int64)
        self.step[: len(table)] = self.lengths[table]

    def pack(self, rows: Ragged) -> tuple[Ragged, Ragged]:
        """Bytes of each row, and its checkpoints in bits from the row's first byte."""
        size = self.lengths[rows.values]
        if len(size) and not size.all():
            raise ValueError("a symbol has no code")
        ends = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        from_, counts = ends[rows.offsets[:-1]], rows.lengths()
        starts = np.concatenate(([0], np.cumsum((ends[rows.offsets[1:]] - from_ + 7) >> 3)))
        place = np.repeat(starts[:-1] * 8 - from_, counts)
        place += ends[:-1]
        lane = place >> 5
        place &= 31
        place += size
        word = self.words[rows.values] << (64 - place).astype(np.uint64)
        out = np.zeros((starts[-1] >> 2) + 2, np.uint32)
        if len(lane):
            # Codes that begin in one lane of 32 bits share no bit, so their sum is their union.
            first = np.flatnonzero(np.concatenate(([True], lane[1:] != lane[:-1])))
            joined, at = np.add.reduceat(word, first), lane[first]
            out[at] = joined >> np.uint64(32)
            out[at + 1] |= joined.astype(np.uint32)
        marks = np.concatenate(([0], np.cumsum(-(-counts // STEP))))
        number = np.arange(marks[-1]) - np.repeat(marks[:-1], np.diff(marks))
        row = np.repeat(np.arange(len(counts)), np.diff(marks))
        inside = ends[rows.offsets[:-1][row] + number * STEP] - from_[row]
        return Ragged(out.byteswap().view(np.uint8)[: starts[-1]], starts), Ragged(inside, marks)

    def unpack(self, data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Symbols of stretches: from bit ``starts`` on, ``counts`` each, one stretch after another."""
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        window = np.zeros(len(data) + 4, np.uint32)
        for k in range(4):
            window |= padded[k : k + len(window)].astype(np.uint32) << np.uint32(24 - 8 * k)
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, place = starts[order].copy(), (ends - counts)[order]
        going = np.searchsorted(-counts[order], -np.arange(int(counts.max(initial=0))), side="left")
        shift = np.uint32(32 - self.limit)
        for k, n in enumerate(going.tolist()):
            seen = (window[at[:n] >> 3] << (at[:n] & 7).astype(np.uint32)) >> shift
            out[place[:n] + k] = self.symbol[seen]
            at[:n] += self.step[seen]
        return out
