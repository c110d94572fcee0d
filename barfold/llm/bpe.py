"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token ids and accepts exactly the sequences that the merges produce. It is
built by one merge gadget per merge, in order of rank: for the merge of u and v into w, the
state that u leads to is replaced, for u, by a copy without its v-transition; every state
with a u-transition gets a w-transition to where v led. All transitions of one token
lead to one state, so what is kept is each token's target state, and per state the removed
tokens and the rank at which they went. A w-transition exists where the u-transition did when w was
made, so it is looked up along the leftmost parts of w.

Every prefix of a word has one accepted tokenization, so the states reached are a table with one
entry per byte: encoding walks the byte trie of the tokens from each place and follows the
automaton's transitions, for many words at once. Decoding emits the arc labels (the bytes) of ids.

Texts are first cut into the pre-split words of a byte-level tokenizer file; each distinct word is
encoded once per batch. Added tokens of the file are matched in the text before that, as the
file asks.

Defined cases: null and empty texts have no ids. Bytes that are not UTF-8 cannot occur in a text;
ids whose bytes are not UTF-8 together decode with replacement marks. Rows are kept one
by one, so repeated rows and other columns do not matter; a column with an output's name is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barfold.llm.pieces import Ragged, cut
from barfold.llm.texts import append

#: The pattern that byte-level files split words by.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BULK = 64
#: Pairs of a state and a token whose answer is kept.
REMEMBERED = 1 << 20
_SPACES = np.zeros(256, bool)
_SPACES[[*range(9, 14), *range(28, 33), 0x85, 0]] = True
#: First bytes of white space beyond ASCII; no cut before them, nor before an added token.
_SPACES[[0xC2, 0xE1, 0xE2, 0xE3, ord("<")]] = True
_DEAD = np.iinfo(np.int32).max


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level files: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(spare)}


class HashTable:
    """A fixed map from integers to small integers, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int) -> None:
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, missing, np.int32)
        self.mask, self.missing, self.rounds = size - 1, missing, 0
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            self.rounds += 1
            free = left[self.keys[at[left]] == -1]
            self.keys[at[free]] = keys[free]  # of several, the last stays
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        there = self.keys[at]
        found = np.where(there == keys, self.values[at], self.missing)
        left = np.flatnonzero((there != keys) & (there != -1))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there = self.keys[at[left]]
            hit = there == keys[left]
            found[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there != -1)]
        return found


class Automaton:
    """The compiled tables of one tokenizer file."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[int, int, int]]) -> None:
        size = max(vocabulary.values()) + 1
        self.label = [b""] * size
        for text, token in vocabulary.items():
            self.label[token] = text
        self.plain: _Plain | None = None
        self._compile(size, merges)
        self._trie(vocabulary)

    def _compile(self, size: int, merges: list[tuple[int, int, int]]) -> None:
        target = np.zeros(size, np.int64)  # state that the token's transitions lead to
        copied, removed, rank = [-1], [-1], [-1]  # per state: copy of, token taken out, when
        born, first = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for when, (u, v, w) in enumerate(merges):
            after_v = target[v]
            copied.append(int(target[u]))
            removed.append(v)
            rank.append(when)
            target[u] = len(copied) - 1
            target[w] = after_v
            born[w], first[w] = when, u
        # States that no token leads to any more are left out; the others list their removals.
        used = np.unique(np.concatenate(([0], target)))
        keys, values = [], []
        for number, state in enumerate(used.tolist()):
            while state > 0:
                keys.append((number << 24) | removed[state])
                values.append(rank[state])
                state = copied[state]
        self.removals = HashTable(np.array(keys or [-2], np.int64), np.array(values or [0], np.int64), _DEAD)
        self.target = np.searchsorted(used, target)
        # The leftmost parts of each token with the last rank at which a removal counts.
        parts, limits, part, limit = [], [], np.arange(size), np.full(size, _DEAD - 1, np.int64)
        while (part >= 0).any():
            parts.append(part)
            limits.append(limit)
            limit = np.where(part >= 0, born[part], -1)
            part = np.where(part >= 0, first[part], -1)
        self.parts, self.limits = np.array(parts), np.array(limits)

    def _trie(self, vocabulary: dict[bytes, int]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for text, token in vocabulary.items():
            node = 0
            for byte in text:
                node = nodes.setdefault((node, byte), len(nodes) + 1)
            ends[node] = token
        keys = np.array([(a << 8) | b for a, b in nodes], np.int64)
        self.steps = HashTable(keys, np.array(list(nodes.values()), np.int64), -1)
        self.token_at = np.full(len(nodes) + 1, -1, np.int64)
        self.token_at[list(ends)] = list(ends.values())

    def follows(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each state has a transition by each token."""
        alive = np.ones(len(state), bool)
        left = np.arange(len(state))
        for part, limit in zip(self.parts, self.limits, strict=True):
            of = part[token[left]]
            left = left[of >= 0]
            if not len(left):
                break
            gone = self.removals.get((state[left] << 24) | of[of >= 0]) <= limit[token[left]]
            alive[left[gone]] = False
            left = left[~gone]
        return alive

    def encode(self, words: list[bytes]) -> Ragged:
        """Ids of each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rows: list[np.ndarray | None] = [None] * len(words)
        low = 0
        for high in (8, 16, 32, BULK):
            some = np.flatnonzero((lengths > low) & (lengths <= high))
            # Long words make wide tables, so few of them at a time.
            for k in range(0, len(some), (1 << 22) // high):
                self._encode_some(words, lengths, some[k : k + (1 << 22) // high], rows)
            low = high
        for n in np.flatnonzero(lengths > BULK).tolist():
            rows[n] = self._encode_long(words[n])
        empty = np.zeros(0, np.int64)
        return Ragged.of([empty if r is None else r for r in rows], np.int64)

    def _encode_long(self, word: bytes) -> np.ndarray:
        """Ids of one word of any length, by the same transitions place by place; time is linear in the word."""
        if self.plain is None:
            self.plain = _Plain(self)
        plain, size = self.plain, len(word)
        steps, token_at, target, span = plain.steps, plain.token_at, plain.target, plain.span
        arrived = [-1] * (size + 1)
        for start in range(size):
            before = arrived[start]
            if before < 0 and start:
                continue
            state, node = target[before] if start else 0, 0
            for end in range(start, size):
                node = steps.get(node << 8 | word[end], -1)
                if node < 0:
                    break
                token = token_at[node]
                if token >= 0 and plain.follows(state, token):
                    arrived[end + 1] = token
        found, place = [], size
        while place:
            found.append(arrived[place])
            place -= span[arrived[place]]
        return np.array(found[::-1], np.int64)

    def _encode_some(self, words, lengths, some: np.ndarray, rows: list) -> None:
        width = int(lengths[some].max())
        joined = b"".join([words[n].ljust(width, b"\0") for n in some])
        data = np.frombuffer(joined, np.uint8).reshape(len(some), width)
        size = lengths[some]
        arrived = np.full((len(some), width + 1), -1, np.int64)  # the token by which a place is reached
        state = np.zeros((len(some), width + 1), np.int64)
        for start in range(width):
            live = np.flatnonzero((size > start) & ((arrived[:, start] >= 0) | (start == 0)))
            node = np.zeros(len(live), np.int64)
            for end in range(start + 1, width + 1):
                node = self.steps.get((node << 8) | data[live, end - 1])
                going = (node >= 0) & (size[live] >= end)
                live, node = live[going], node[going]
                if not len(live):
                    break
                token = self.token_at[node]
                whole = np.flatnonzero(token >= 0)
                token, here = token[whole], live[whole]
                ok = self.follows(state[here, start], token)
                here, token = here[ok], token[ok]
                arrived[here, end] = token
                state[here, end] = self.target[token]
        # Back from the end of each word.
        span = np.array([len(x) for x in self.label])
        place, column, out = size.copy(), [], []
        left = np.arange(len(some))
        while len(left):
            token = arrived[left, place[left]]
            column.append(left)
            out.append(token)
            place[left] -= span[token]
            left = left[place[left] > 0]
        order = np.lexsort((-np.arange(sum(map(len, out))), np.concatenate(column)))
        tokens = np.concatenate(out)[order]
        counts = np.bincount(np.concatenate(column), minlength=len(some))
        for n, ids in zip(some, np.split(tokens, np.cumsum(counts)[:-1]), strict=True):
            rows[n] = ids


class _Plain:
    """The tables of an automaton for one place at a time, made when a worker first meets a long word."""

    def __init__(self, of: Automaton) -> None:
        filled = np.flatnonzero(of.steps.keys >= 0)
        self.steps = dict(zip(of.steps.keys[filled].tolist(), of.steps.values[filled].tolist(), strict=True))
        filled = np.flatnonzero(of.removals.keys >= 0)
        self.removals = dict(zip(of.removals.keys[filled].tolist(), of.removals.values[filled].tolist(), strict=True))
        self.token_at, self.target, self.span = of.token_at.tolist(), of.target.tolist(), [len(x) for x in of.label]
        self.parts, self.limits = of.parts, of.limits
        self.chains: dict[int, list[tuple[int, int]]] = {}
        self.known: dict[tuple[int, int], bool] = {}

    def follows(self, state: int, token: int) -> bool:
        """Whether the state has a transition by the token; answers are kept, up to ``REMEMBERED`` of them."""
        answer = self.known.get((state, token))
        if answer is None:
            chain = self.chains.get(token)
            if chain is None:
                parts = self.parts[:, token]
                chain = self.chains[token] = [
                    (p, m) for p, m in zip(parts.tolist(), self.limits[:, token].tolist(), strict=True) if p >= 0]
            gone, first = self.removals, state << 24
            answer = all(gone.get(first | p, _DEAD) > limit for p, limit in chain)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[state, token] = answer
        return answer


class ByteLevel:
    """A byte-level tokenizer file: its added tokens, its word pattern and its automaton."""

    def __init__(self, content: dict) -> None:
        symbols = _byte_symbols()
        to_bytes = lambda text: bytes(symbols[c] for c in text)
        model = content["model"]
        vocabulary = {to_bytes(text): token for text, token in model["vocab"].items()}
        merges = []
        for u, v in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            merges.append((model["vocab"][u], model["vocab"][v], model["vocab"][u + v]))
        self.automaton = Automaton(vocabulary, merges)
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        label = self.automaton.label
        label += [b""] * (max([len(label) - 1, *self.added.values()]) + 1 - len(label))
        for text, token in self.added.items():
            label[token] = text.encode()
        self.labels = Ragged.of([np.frombuffer(x, np.uint8) for x in label], np.uint8)
        self.words = regex.compile(WORDS)
        longest = sorted(self.added, key=len, reverse=True)
        self.splits = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None

    def _words(self, piece: str) -> list[str]:
        if self.splits is None or not self.splits.search(piece):
            return self.words.findall(piece)
        return [w for part in self.splits.split(piece)
                for w in ([part] if part in self.added else self.words.findall(part))]

    def encode(self, column: pa.Array) -> Ragged:
        """Ids of each text."""
        pieces = cut(column, _word_starts)
        numbers: dict[str, int] = {}
        of_piece, bounds = [], [0]
        for piece in pieces.distinct:
            of_piece += [numbers.setdefault(w, len(numbers)) for w in self._words(piece.decode())]
            bounds.append(len(of_piece))
        words = list(numbers)
        ids = self.automaton.encode([b"" if w in self.added else w.encode() for w in words])
        if any(w in numbers for w in self.added):
            rows = np.split(ids.values, ids.offsets[1:-1])
            for text, token in self.added.items():
                if text in numbers:
                    rows[numbers[text]] = np.array([token])
            ids = Ragged.of(rows, np.int64)
        by_piece = ids.take(np.array(of_piece, np.int64)).grouped(np.array(bounds))
        return by_piece.take(pieces.numbers).grouped(pieces.bounds)

    def decode(self, ids: np.ndarray) -> str:
        return self.labels.take(ids).values.tobytes().decode("utf-8", "replace")


def _word_starts(data: np.ndarray) -> np.ndarray:
    """A space before anything but white space always begins a word."""
    marks = np.zeros(len(data), bool)
    if len(data):
        marks[:-1] = (data[:-1] == 32) & ~_SPACES[data[1:]]
    return marks


@lru_cache(maxsize=2)
def _loaded(content: str) -> ByteLevel:
    return ByteLevel(json.loads(content))


class Tokenizer:
    """A tokenizer file, read on the driver and compiled once in each Python worker."""

    def __init__(self, spark, path: str) -> None:
        self.sent = spark.sparkContext.broadcast(Path(path).read_text())

    def here(self) -> ByteLevel:
        return _loaded(self.sent.value)


def rows_of(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each row; none for a null."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for first, end, ok in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist(), strict=True):
        yield values[first : end if ok else first]


def encode(frame: DataFrame, tokenizer: Tokenizer, *, text: str = "text", to: str = "ids") -> DataFrame:
    """``frame`` with the ids of its texts in ``to``."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = tokenizer.here().encode(batch.column(text))
        return [pa.ListArray.from_arrays(
            pa.array(found.offsets.astype(np.int32)), pa.array(found.values.astype(np.int32)))]

    return append(frame, [T.StructField(to, T.ArrayType(T.IntegerType()))], compute, by=text)


def decode(frame: DataFrame, tokenizer: Tokenizer, *, ids: str = "ids", to: str = "text") -> DataFrame:
    """``frame`` with the texts of its ids in ``to``; null ids give an empty text."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        file, column = tokenizer.here(), batch.column(ids)
        texts = [file.decode(row) for row in rows_of(column)]
        return [pa.array(texts, pa.string())]

    return append(frame, [T.StructField(to, T.StringType())], compute, by=ids)
