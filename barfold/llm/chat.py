"""Chat formatting by token-level assembly.

A turn is ``<s>`` role ``[INST]`` text ``[/INST]</s>``. The four control strings are reserved ids beyond the
vocabulary: role and text are encoded by themselves as ordinary text and the reserved ids are spliced
between, so nothing in a text can become a control id. Inside texts a control string is
also escaped, by one backslash after its first character (one more if it has some already), which
``read`` takes out again; so the formatted string is unambiguous too. The loss mask is the prefix sum
of +1 where a learned text begins and -1 where it ends.

Every turn is formatted by itself, so a conversation of any length is spread over tasks; ``assemble``
adds where each turn begins in its conversation, by prefix sums of the turns' lengths. Turns stand
in the order of their turn number, nulls first, then role, then text.

Defined cases: a null role or text is empty; an unknown role is formatted like any other and not learned;
rows that repeat a turn are all kept; a null conversation number is a conversation of its own.
Other columns are kept; a column with an output's name is replaced.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.llm.texts import append

#: The control strings, and the pattern that byte-level files split words by.
CONTROLS = ("<s>", "[INST]", "[/INST]", "</s>")
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CONTROL = r"(?=/?(?:s>|INST\]))"
#: Fixed value: Unicode white space. A run of it longer than ``LONG_SPACE`` is not left to the word pattern.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = 4096
_LONG = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")
_PLAIN = re.compile(r"([<\[])(\\*)" + _CONTROL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _CONTROL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class Format:
    """The encoder of a rank file, with the control strings as the ids after its vocabulary."""

    def __init__(self, ranks: str) -> None:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(str.split, ranks.splitlines())}
        self.codes = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=table, special_tokens={})
        first = max(table.values()) + 1
        self.open, self.begin, self.end, self.close = range(first, first + len(CONTROLS))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, as ordinary text.

        The word pattern steps back over white space one call a character, which a very long run has too many of. So
        the word that the pattern takes of such a run is taken here: all of it, or all but the last
        character if something follows. What stands before and after it is split as it would be in one text.
        """
        cut = {n: self._parts(t) for n, t in enumerate(texts) if len(t) >= LONG_SPACE and _LONG.search(t)}
        found = self.codes.encode_ordinary_batch(["" if n in cut else t for n, t in enumerate(texts)], num_threads=1)
        for n, parts in cut.items():
            found[n] = [i for part, space in parts for i in (
                self.codes._encode_single_piece(part) if space else self.codes.encode_ordinary(part))]
        return found

    @staticmethod
    def _parts(text: str) -> list[tuple[str, bool]]:
        parts, done = [], 0
        for run in _LONG.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts += [(text[done : run.start()], False), (text[run.start() : end], True)]
            done = end
        return [*parts, (text[done:], False)]

    def turn(self, role: list[int], text: list[int], learned: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of one turn."""
        ids = np.concatenate(([self.open], role, [self.begin], text, [self.end, self.close])).astype(np.int32)
        edges = np.zeros(len(ids) + 1, np.int8)
        edges[len(role) + 2] += learned
        edges[len(role) + 2 + len(text)] -= learned
        return ids, np.cumsum(edges[:-1]).astype(np.int8)

    def parts(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str]:
        """Role, text and the text under the mask of one turn, read back from its ids."""
        begin = int(np.flatnonzero(ids == self.begin)[0])
        role, text = ids[1:begin], ids[begin + 1 : -2]
        if ids[0] != self.open or ids[-2] != self.end or ids[-1] != self.close:
            raise ValueError("not a formatted turn")
        plain = lambda part: unescape(self.codes.decode(part.tolist()))
        return plain(role), plain(text), plain(ids[mask > 0])

    def length(self, ids: np.ndarray) -> int:
        """Characters of the turn's formatted string."""
        ordinary = ids[ids < self.open]
        return len(self.codes.decode(ordinary.tolist())) + sum(map(len, CONTROLS))


@lru_cache(maxsize=2)
def _loaded(ranks: str) -> Format:
    return Format(ranks)


class Template:
    """A rank file, read on the driver and loaded once in each Python worker."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.sent = spark.sparkContext.broadcast(Path(path).read_text())

    def here(self) -> Format:
        return _loaded(self.sent.value)


def format_turns(
    turns: DataFrame,
    template: Template,
    *,
    learned: tuple[str, ...] = ("assistant",),
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``turns`` with ``formatted`` (string), ``ids`` and ``loss_mask`` of each row."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        form = template.here()
        roles = [r or "" for r in batch.column(role).to_pylist()]
        texts = [escape(t or "") for t in batch.column(text).to_pylist()]
        distinct = sorted(set(roles))
        names = dict(zip(distinct, form.encode([escape(r) for r in distinct]), strict=True))
        ids, masks, strings = [], [], []
        for r, t, codes in zip(roles, texts, form.encode(texts), strict=True):
            one, mask = form.turn(names[r], codes, r in learned)
            ids.append(one)
            masks.append(mask)
            strings.append(f"<s>{escape(r)}[INST]{t}[/INST]</s>")
        return [pa.array(strings, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))]

    fields = [T.StructField("formatted", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
              T.StructField("loss_mask", T.ArrayType(T.ByteType()))]
    return append(turns, fields, compute, by=text)


def assemble(
    formatted: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``formatted`` with ``start``: the ids of the conversation before this turn."""
    order = [F.col(c).asc_nulls_first() for c in (turn, role, text)]
    before = Window.partitionBy(conversation).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return formatted.withColumn("start", F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0)).cast("long"))


def read(formatted: DataFrame, template: Template) -> DataFrame:
    """``formatted`` with ``read_role``, ``read_text``, ``learned_text`` and ``n_chars``, from ids and mask alone."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        form, found = template.here(), []
        for ids, mask in zip(batch.column("ids"), batch.column("loss_mask"), strict=True):
            ids = ids.values.to_numpy()
            found.append((*form.parts(ids, mask.values.to_numpy()), form.length(ids)))
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        return [pa.array(c, kind) for c, kind in zip(columns, [pa.string()] * 3 + [pa.int64()], strict=True)]

    fields = [T.StructField(n, T.StringType()) for n in ("read_role", "read_text", "learned_text")]
    return append(formatted, [*fields, T.StructField("n_chars", T.LongType())], compute, by="ids")
