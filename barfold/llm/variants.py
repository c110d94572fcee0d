"""Spelling variants: words of a vocabulary at one edit from each other, and the form each belongs to.

The vocabulary is an acceptor, composed with a transducer of one edit and with itself again
(:mod:`~barfold.llm.acceptor`). The composition is cut into partitions by its initial state: the
labels both words share at their ends before the transducer may edit. Words of length m and m + 1 start
as one partition; one that is too large is cut in two by halving what its words do not share yet, as
the edit is either behind the first half (which then is shared) or before its end (then the rest is).
So every pair is met in exactly one partition, whatever the number of rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barfold.llm import acceptor
from barfold.llm.texts import lowered, quoted, slices, spans, spare
from barfold.sources.scratch import materialise, release

#: Words of a partition. Where no more than two labels are left open, an alphabet of 90 letters makes at most 8190.
PARTITION_WORDS = 1 << 14
#: Words composed at a time: whole partitions up to about so many.
CHUNK_WORDS = 1 << 15
#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 1 << 20


def vocabulary(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text",
    least_chars: int = 5, least_count: int = 3, slip: int | None = None,
) -> DataFrame:
    """``word`` and ``n``, its occurrences, of all words of at least ``least_chars`` letters that occur often enough.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. A null text has none.
    With ``slip``, occurrences for which it divides h, the crc32 of ``<key>:<word>`` (a null key is empty
    text), lose their letter h % length: reproducible slips of the pen. Repeated rows count each. Words are
    compared as bytes, and counted per task before any shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for low, high in spans(whole.column(1)):
                batch = whole.slice(low, high - low)
                fresh = _counted(pa.table({"word": _words(batch, least_chars, slip)}), "word", None)
                held = fresh if held is None else _counted(pa.concat_tables([held, fresh]), "word", "n")
                if len(held) > HELD_WORDS:
                    yield from held.to_batches(max_chunksize=1 << 16)
                    held = None
        if held is not None:
            yield from held.to_batches(max_chunksize=1 << 16)

    named = documents.select(
        F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")).alias("key"), F.col(quoted(text)).alias("text"))
    return (
        named.where("text is not null").mapInArrow(count, "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
        .select(F.col("word").cast("string").alias("word"), "n")
    )


def _counted(table: pa.Table, name: str, weight: str | None) -> pa.Table:
    found = table.group_by(name).aggregate([(weight, "sum") if weight else ([], "count_all")])
    return pa.table([found.column(name), found.column(f"{weight}_sum" if weight else "count_all")], names=["word", "n"])


def _words(batch: pa.RecordBatch, least_chars: int, slip: int | None) -> pa.Array:
    """All word occurrences of at least ``least_chars`` letters, after the slips."""
    keys = [k.encode() + b":" for k in batch.column(0).to_pylist()]
    found = [pa.array([], pa.binary())]
    for part in slices(batch.column(1)):
        data = lowered(part.data)
        after = np.concatenate(([False], data[:-1] == 0xC3))
        within = (data >= 97) & (data <= 122) | (data == 0xC3) | (after & (data >= 0x80) & (data < 0xC0))
        edge = np.flatnonzero(np.diff(within, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        chars = np.concatenate(([0], np.cumsum(~after)))
        length = chars[ends] - chars[starts]
        # A word that may reach the least length is at least that long before a slip.
        starts, ends, length = (x[length >= least_chars] for x in (starts, ends, length))
        lost = None
        if slip is not None and len(starts):
            at = part.document(starts)
            h = _crc32(data, starts, ends, keys[part.first : part.first + part.count], at)
            hit = np.flatnonzero(h % slip == 0)
            gone = np.searchsorted(chars[1:], chars[starts[hit]] + h[hit] % length[hit] + 1)
            lost = np.zeros(len(data), bool)
            lost[gone] = True
            two = gone[data[gone] == 0xC3]
            lost[two + 1] = True
            length[hit] -= 1
            starts, ends = starts[length >= least_chars], ends[length >= least_chars]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        if lost is not None:
            keep &= ~lost
        bounds = np.concatenate(([0], np.cumsum(keep)))
        offsets = np.concatenate((bounds[starts], bounds[-1:])).astype(np.int32)
        found.append(pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep]))]))
    return pa.concat_arrays(found)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc32(data, starts, ends, heads: list[bytes], owner) -> np.ndarray:
    """crc32 of ``heads[owner]`` and the bytes from ``starts`` to ``ends``, one byte of all words at a time."""
    import zlib

    state = np.array([zlib.crc32(h) for h in heads], np.uint32)[owner] ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(starts - ends, kind="stable")  # longest first
    state, at, size = state[order], starts[order], (ends - starts)[order]
    alive = len(at)
    for k in range(int(size.max(initial=0))):
        alive = int(np.searchsorted(-size, -k, side="left"))
        now = state[:alive]
        state[:alive] = _CRC[(now ^ data[at[:alive] + k]) & 0xFF] ^ (now >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out.astype(np.int64)


def group(words: DataFrame, *, word: str = "word", n: str = "n", factor: int = 2) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each distinct word of a vocabulary.

    Two words are near if they differ by one inserted, deleted or replaced code point. The form of a
    word is its near word with the largest ``n`` (ties: the smallest in code-point order), if that is at least
    ``factor`` (2 or more) times its own ``n``. The root is where the forms end, the word itself if it has none;
    as counts at least double, a chain has at most 63 steps. Repeated rows of a word add up; null and
    empty words and null counts are left out; an empty vocabulary gives no rows. Other columns are ignored.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more")
    known = materialise(
        words.select(F.col(quoted(word)).cast("string").alias("word"), F.col(quoted(n)).cast("long").alias("n"))
        .where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").alias("n")))
    best = (
        near(known).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(-F.col("best_n"), "best")).alias("top"))
        .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.col1")).alias("best_n"))
    )
    taken: Column = F.col("best_n") >= F.col("n") * factor
    formed = materialise(known.join(best, "word", "left").select(
        "word", F.when(taken, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best_n")).alias("form_n")))
    roots = _followed(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def near(known: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best``, ``best_n`` per word and partition: its near words there and the commonest of them."""
    names = "word string, n_near long, best string, best_n long"
    dealt = partitions(known).repartition("m", "path", "shared").sortWithinPartitions("m", "path", "shared")
    rows = dealt.select("word", "n", "m", "path", "low", "high", "shared")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rest = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rest += len(batch)
            if rest >= CHUNK_WORDS:
                table = pa.concat_tables(held)
                cut = _blocks(table)[-1]
                yield from _near(table.slice(0, cut))
                held, rest = [table.slice(cut)], len(table) - int(cut)
        if held:
            yield from _near(pa.concat_tables(held))

    return rows.mapInArrow(compose, names)


def partitions(known: DataFrame) -> DataFrame:
    """Rows of ``known`` per partition: ``m``, ``path`` and ``shared`` name it, ``low`` and ``high`` labels are shared.

    Sizes are counted with a combine step before the shuffle; only rows of partitions that are too large
    are cut and counted again, so the rounds are the logarithm of the longest word at most.
    """
    def named(frame: DataFrame) -> DataFrame:
        # m and path fix low and high, so their texts in a row name the partition without doubt.
        shared = F.concat(F.expr("substring(word, 1, low)"), F.expr("substring(word, char_length(word) - high + 1)"))
        return frame.withColumn("shared", shared)

    open_ = named(
        known.select("word", "n", F.explode(F.expr("array(char_length(word), char_length(word) - 1)")).alias("m"))
        .select("word", "n", "m", F.lit("").alias("path"), F.lit(0).alias("low"), F.lit(0).alias("high")))
    name, done = ["m", "path", "shared"], None
    while True:
        size = open_.groupBy(*name).agg(F.count("*").alias("size"), F.max(F.expr("m - low - high")).alias("left"))
        large = materialise(size.where((F.col("size") > PARTITION_WORDS) & (F.col("left") > 1)).select(*name))
        if large.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        small = open_.join(large, name, "left_anti").select(*open_.columns)
        done = small if done is None else done.unionByName(small)
        half = "(m - low - high) div 2"
        cut = F.expr(f"""explode(array(
            named_struct('path', path || 'P', 'low', cast(low + {half} as int), 'high', high),
            named_struct('path', path || 'S', 'low', low, 'high', cast(m - low - {half} as int))))""")
        halved = open_.join(large, name, "left_semi").select("word", "n", "m", cut.alias("c"))
        open_ = materialise(named(halved.select("word", "n", "m", "c.path", "c.low", "c.high")))


def _blocks(table: pa.Table) -> np.ndarray:
    """Rows at which a partition starts."""
    if not len(table):
        return np.zeros(1, np.int64)
    new = np.zeros(len(table), bool)
    new[0] = True
    for name in ("m", "path", "shared"):
        column = table.column(name).combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _near(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if len(table) < 2:
        return
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    low, high, m = (table.column(c).to_numpy().astype(np.int64) for c in ("low", "high", "m"))
    opened = [w[a : len(w) - b] for w, a, b in zip(words, low.tolist(), high.tolist(), strict=True)]
    cuts = _blocks(table)
    block = np.zeros(len(words), np.int64)
    block[cuts[1:]] = 1
    block = np.cumsum(block)
    codes = np.frombuffer("".join(opened).encode("utf-32-le"), np.uint32)
    letters, labels = np.unique(codes, return_inverse=True)
    sizes = np.array([len(w) for w in opened], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    flat[starts] = block + len(letters)
    inside = np.ones(len(flat), bool)
    inside[starts] = False
    flat[inside] = labels
    inner = pc.match_substring(table.column("path"), "S").to_numpy()
    a, b = acceptor.one_edit_pairs(acceptor.build(flat, starts, sizes + 1), m - low - high, inner)
    if not len(a):
        return
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    one, two = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((place[two], -n[two], one))
    one, two = one[order], two[order]
    first = np.flatnonzero(np.diff(one, prepend=-1))
    counts = np.diff(np.append(first, len(one)))
    yield pa.RecordBatch.from_arrays([
        pa.array([words[k] for k in one[first].tolist()], pa.string()), pa.array(counts, pa.int64()),
        pa.array([words[k] for k in two[first].tolist()], pa.string()), pa.array(n[two[first]], pa.int64()),
    ], names=["word", "n_near", "best", "best_n"])


def _followed(links: DataFrame) -> DataFrame:
    """``word`` and the last ``root`` of its chain of links, by steps of doubled length."""
    now = materialise(links)
    while True:
        now_ = now.select("word", "root")
        jump = now_.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = spare(now, "moved")
        later = materialise(now_.join(jump, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias(moved)))
        release(now)
        more = not later.where(F.col(moved)).isEmpty()
        now = later
        if not more:
            return now.drop(moved)
