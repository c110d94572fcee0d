"""Token-id files: ids by a tokenizer file, Huffman-coded from global counts, in key order.

``encode`` gives ids of texts; ``write`` stores rows (key, ids) and ``read`` reads them back. A
stored folder has two tables: ``code`` (id, length), which fixes the canonical code, and ``blocks``,
one row per block: ``shard`` (range partition of the key order), ``before`` (ids of the shard before the
block), and per row of the block its key, number of ids, byte offset in the payload and checkpoints
(bit offsets every ``huffman.STEP`` ids). A block needs only the code to be decoded.

Rows are in ascending key order, nulls first; rows with one key stand in the order of the crc32 of their packed
bytes, then of those bytes. Ids are counted over all rows: ``encode`` counts each batch as it makes it, and only
those counts are read again. The id table is written once to the shared checkpoint folder, since
both the counts and the packing need it. Range bounds come from a quantile sketch of the keys, so
the shuffle carries packed rows only; a key that several bounds fall on has as many shards more, to which
its rows go by the crc32. Only rows equal in key and ids stay together.

Defined cases: null and empty texts have only the end id; no rows give no blocks. Memory is bounded
by a block (about ``BLOCK_IDS`` ids) or the longest row, and the code by the number of ids there are.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.llm import huffman
from barfold.llm.bpe import _byte_symbols
from barfold.llm.pieces import Ragged, cut
from barfold.llm.texts import append, lowered
from barfold.sources.scratch import checkpoint_dir

BLOCK_IDS = 1 << 18
REMEMBERED = 400_000
MARKS = b",.!?;:#$%&*"
PROBES = ("a", "the", "engine", "nonstopwords", "s", "re")
#: With letters of two bytes that lower-casing and composition leave as they are: U+00DF to U+00FF without U+00F7.
WIDE_PROBES = ("é", "straße", "ñandú", "àç", "ÿth", "über", "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])))
_MARK, _LETTER, _TAIL = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(MARKS)] = True
_LETTER[97:123] = True
_TAIL[[*range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = True
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
#: The stand-in of each byte of a word in byte-level files, by its Latin-1 character.
_SYMBOL = {byte: symbol for symbol, byte in _byte_symbols().items() if ord(symbol) != byte}


class WordIds:
    """A tokenizer file that drops white space, over pieces cut at spaces, line feeds and before marks.

    No word crosses those places, so a text's ids are those of its pieces. If the file lower-cases texts,
    A-Z are lower-cased before, and a piece of a-z alone goes straight to the file's merges, since
    nothing else in the file changes it; in a byte-level file so does one with small Latin-1 letters. All are tried on
    ``PROBES`` and ``WIDE_PROBES`` when the file is loaded, and
    left where a text holds an added token. Recent pieces are remembered, at most twice ``REMEMBERED``.
    """

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.file = Tokenizer.from_str(content)
        self.file.no_truncation()
        self.file.no_padding()
        self.merges = self.file.model.tokenize
        self.added = [t.content.lower().encode() for t in self.file.get_added_tokens_decoder().values()]
        ids = lambda text: self.file.encode(text, add_special_tokens=False).ids
        merged = lambda text: self._merged(text.encode())
        self.folds = all(
            ids(a.upper() + m + b) == ids(a) + ids(m) + ids(b) == merged(a) + ids(m) + merged(b)
            for a in PROBES for b in PROBES for m in MARKS.decode())
        self.wide = self.folds and all(
            ids(a + m + b) == ids(a) + ids(m) + ids(b) == merged(a) + ids(m) + merged(b)
            for a in WIDE_PROBES for b in WIDE_PROBES for m in MARKS.decode())
        self.now: dict[bytes, bytes] = {}
        self.past: dict[bytes, bytes] = {}

    def _merged(self, word: bytes) -> list[int]:
        text = word.decode("latin-1")
        return [t.id for t in self.merges(text if word.isascii() else text.translate(_SYMBOL))]

    def _learn(self, pieces: list[bytes], plain: bool) -> None:
        simple = _PLAIN if self.wide else lambda piece: piece.isalpha() and piece.isascii()
        others = []
        for piece in pieces:
            if plain and simple(piece):
                self.now[piece] = array("I", self._merged(piece)).tobytes()
            else:
                others.append(piece)
        for piece, found in zip(others, self.file.encode_batch_fast(
                [p.decode() for p in others], add_special_tokens=False), strict=True):
            self.now[piece] = array("I", found.ids).tobytes()

    def encode(self, column: pa.Array) -> Ragged:
        plain = self.folds

        def change(data: np.ndarray) -> np.ndarray:
            nonlocal plain
            folded = lowered(data)
            content = folded.tobytes()
            plain = self.folds and not any(a in content for a in self.added)
            return folded if plain else data

        def before(data: np.ndarray) -> np.ndarray:
            spaces = (data == 32) | (data == 10)
            if plain:
                marks = np.flatnonzero(_MARK[data[1:]]) + 1
                after = _LETTER[data[marks - 1]]
                if self.wide:
                    # The byte before the first is the zero byte after the last text.
                    after |= _TAIL[data[marks - 1]] & (data[marks - 2] == 0xC3)
                spaces[marks[after]] = True
            return spaces

        pieces = cut(column, before, change)
        distinct = [p.strip(b" \n") for p in pieces.distinct]
        if len(self.now) > REMEMBERED:
            self.past, self.now = self.now, {}
        now, past = self.now, self.past
        new = {p for p in distinct if p not in now}
        known = [p for p in new if p in past]
        now.update(zip(known, map(past.__getitem__, known), strict=True))
        self._learn([p for p in new if p not in past], plain)
        rows = [now[p] for p in distinct]
        offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) >> 2)))
        ids = Ragged(np.frombuffer(b"".join(rows), np.uint32), offsets)
        return ids.take(pieces.numbers).grouped(pieces.bounds)


@lru_cache(maxsize=2)
def _loaded(content: str) -> WordIds:
    return WordIds(content)


def _binary(rows: Ragged, kind: str) -> pa.Array:
    values = rows.values.astype(kind)
    offsets = (rows.offsets * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _numbers(column: pa.Array, kind: str) -> Ragged:
    """Rows of packed numbers; none for a null."""
    rows = [r or b"" for r in column.to_pylist()]
    width = np.dtype(kind).itemsize
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) // width)))
    return Ragged(np.frombuffer(b"".join(rows), kind), offsets)


def encode(
    frame: DataFrame, path: str, *, end: int, text: str = "text", to: str = "ids", counts: str = "counts"
) -> DataFrame:
    """``frame`` with the ids of its texts and the id ``end`` in ``to``, as little-endian 32-bit numbers.

    The first row of each batch has in ``counts`` how often each id occurs in the batch, as pairs of 64-bit numbers.
    """
    sent = frame.sparkSession.sparkContext.broadcast(Path(path).read_text())

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = _loaded(sent.value).encode(batch.column(text))
        values = np.insert(found.values, found.offsets[1:], end)
        rows = _binary(Ragged(values, found.offsets + np.arange(len(found.offsets))), "<u4")
        times = np.bincount(values)
        ids = np.flatnonzero(times)
        pairs = np.stack([ids, times[ids]], axis=1).astype("<i8").tobytes()
        return [rows, pa.array([pairs] + [None] * (len(batch) - 1) if len(batch) else [], pa.binary())]

    fields = [T.StructField(to, T.BinaryType()), T.StructField(counts, T.BinaryType())]
    return append(frame, fields, compute, by=text)


def _counts(stored: DataFrame) -> np.ndarray:
    """How often each id occurs, from the counts of batches if there are any; bounded by the largest id."""
    column = "counts" if "counts" in stored.columns else "ids"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            if column == "counts":
                pairs = _numbers(batch.column(0), "<i8").values.reshape(-1, 2)
                more = np.zeros(int(pairs[:, 0].max(initial=0)) + 1, np.int64)
                np.add.at(more, pairs[:, 0], pairs[:, 1])
            else:
                more = np.bincount(_numbers(batch.column(0), "<u4").values)
            if len(more) > len(total):
                total = np.pad(total, (0, len(more) - len(total)))
            total[: len(more)] += more
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    rows = stored.select(column).where(F.col(column).isNotNull()).mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(int(np.max(rows["id"].to_numpy(), initial=-1)) + 1, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


def write(
    frame: DataFrame, path: str, *, key: str = "doc_id", ids: str = "ids", counts: str | None = None,
    shards: int | None = None,
) -> None:
    """Store ``key`` and ``ids`` (packed little-endian 32-bit numbers) of all rows under ``path``.

    ``counts`` names the column in which :func:`encode` has counted the ids; without it they are counted here.
    """
    spark = frame.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = f"{path.rstrip('/')}/_ids"
    kept = [F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"), *([F.col(counts).alias("counts")] if counts else [])]
    frame.select(*kept).write.option("compression", "zstd").parquet(scratch)
    stored = spark.read.schema(f"key long, ids binary{', counts binary' if counts else ''}").parquet(scratch)
    lengths = huffman.code_lengths(_counts(stored))
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": pa.array(used), "length": pa.array(lengths[used].astype(np.int32))}),
                          "id long, length int").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast(huffman.Code(lengths))

    # A null key counts as the least number, before which nothing can stand.
    sorted_as = F.coalesce("key", F.lit(-(1 << 63)))
    bounds = stored.agg(F.percentile_approx(sorted_as, [k / shards for k in range(1, shards)] or [0.5], 10000)).first()[0]
    inner = np.array(sorted(bounds or [])[: shards - 1], np.int64)

    def pack(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = _numbers(batch.column("ids"), "<u4")
        packed, marks = code.value.pack(rows)
        data, ends = packed.values.astype(np.uint8).tobytes(), packed.offsets.tolist()
        crc = np.array([zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], np.int64)
        at = batch.column("key").fill_null(-(1 << 63)).to_numpy()
        low, high = np.searchsorted(inner, at, "left"), np.searchsorted(inner, at, "right")
        shard = low + ((high - low + 1) * crc >> 32)
        return [_binary(packed, "u1"), pa.array(rows.lengths()),
                pa.ListArray.from_arrays(pa.array(marks.offsets.astype(np.int32)), pa.array(marks.values)),
                pa.array(crc), pa.array(shard.astype(np.int32))]

    fields = [T.StructField("packed", T.BinaryType()), T.StructField("n", T.LongType()),
              T.StructField("marks", T.ArrayType(T.LongType())), T.StructField("crc", T.LongType()),
              T.StructField("shard", T.IntegerType())]
    ordered = (
        append(stored.select("key", "ids"), fields, pack, by="ids").drop("ids")
        .repartitionById(len(inner) + 1, F.col("shard"))
        .sortWithinPartitions(F.col("shard"), F.col("key").asc_nulls_first(), "crc", "packed")
    )
    ordered.mapInArrow(_blocks, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    _remove(spark, scratch)


BLOCKS = ("shard int, before long, keys array<long>, counts array<long>, offsets array<long>, "
          "marks array<array<long>>, payload binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard after another, joined to blocks."""
    held: list[tuple] = []
    shard, before, size = None, 0, 0

    def block() -> pa.RecordBatch:
        keys, counts, packed, marks = zip(*held, strict=True)
        offsets = np.cumsum([0, *map(len, packed)])[:-1]
        columns = [[shard], [before], [list(keys)], [list(counts)], [offsets.tolist()], [list(marks)], [b"".join(packed)]]
        kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.list_(pa.int64())), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["shard", "before", "keys", "counts", "offsets", "marks", "payload"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("shard", "key", "n", "packed", "marks"))
        for of, key, n, packed, marks in zip(*columns, strict=True):
            if held and (of != shard or size + n > BLOCK_IDS):
                yield block()
                before, size, held = before + size, 0, []
            if of != shard:
                shard, before = of, 0
            held.append((key, n, packed, marks))
            size += n
    if held:
        yield block()


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a table that this module has written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a stored folder: ``key``, ``start`` (ids of all rows before it), ``n_tokens``, ``ids`` (packed)."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    rows = spark.read.schema("id long, length int").parquet(f"{path}/code").toArrow()
    lengths = np.zeros(int(np.max(rows["id"].to_numpy(), initial=-1)) + 1, np.int64)
    lengths[rows["id"].to_numpy()] = rows["length"].to_numpy()
    code = spark.sparkContext.broadcast(huffman.Code(lengths))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                yield _unpacked(code.value, *[batch.column(c)[n] for c in (
                    "shard", "before", "keys", "counts", "offsets", "marks", "payload")])

    found = blocks.mapInArrow(unpack, "shard int, key long, start long, n_tokens long, ids binary")
    # One row per shard, so this window is small.
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    from pyspark.sql import Window

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return found.join(F.broadcast(bases), "shard").select("key", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")


def _unpacked(code: huffman.Code, shard, before, keys, counts, offsets, marks, payload) -> pa.RecordBatch:
    counts_ = counts.values.to_numpy()
    stretches = Ragged.of([m.values.to_numpy() for m in marks.values], np.int64)
    row = np.repeat(np.arange(len(counts_)), stretches.lengths())
    number = np.arange(len(row)) - stretches.offsets[:-1][row]
    size = np.minimum(counts_[row] - number * huffman.STEP, huffman.STEP)
    starts = offsets.values.to_numpy()[row] * 8 + stretches.values
    data = np.frombuffer(payload.as_buffer(), np.uint8)
    ids = code.unpack(data, starts, size)
    ends = np.concatenate(([0], np.cumsum(counts_)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(counts_), shard.as_py(), np.int32)), keys.values.cast(pa.int64()),
         pa.array(before.as_py() + ends[:-1]), pa.array(counts_), _binary(Ragged(ids, ends), "<u4")],
        names=["shard", "key", "start", "n_tokens", "ids"])


def folder(spark: SparkSession, name: str) -> str:
    """A new path for a stored folder in the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
