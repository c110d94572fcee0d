import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barfold.llm import huffman, token_files
from barfold.llm.pieces import Ragged

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "É", "ß", " ", "\x1c", "1", "23", "!!!", ",", ".", "<|", "|>", "The",
          " THE", "İ", "日本", "́", "x" * 30, "\r\n", "\0", "K", ":;"]


@pytest.mark.parametrize("more", [[], ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>"]])
def test_ids_of_the_library(more):
    ours, library = token_files.WordIds(open(PATH).read()), Tokenizer.from_file(PATH)
    assert ours.folds
    draw = random.Random(3)
    texts = ["".join(draw.choices(PIECES + more, k=draw.randint(0, 25))) for _ in range(1500)] + [None, ""]
    for first in range(0, len(texts), 50):
        found = ours.encode(pa.array(texts[first:first + 50], pa.string()))
        for n, text in enumerate(texts[first:first + 50]):
            ids = library.encode(text or "", add_special_tokens=False).ids
            assert found.values[found.offsets[n]:found.offsets[n + 1]].tolist() == ids


def test_words_with_small_latin_letters_take_the_merges():
    ours, library = token_files.WordIds(open(PATH).read()), Tokenizer.from_file(PATH)
    assert ours.wide
    seen, whole = [], ours.file
    ours.file = type("Spy", (), {
        "encode_batch_fast": lambda self, texts, **more: (seen.extend(texts), whole.encode_batch_fast(texts, **more))[1]})()
    draw = random.Random(4)
    pieces = ["é", "ß", "ÿ", "ñandú", "a", "straße", ",", ".", "$$$", "###", "&&", "**", "%", " ", "\n", "ë", "'s", "÷", "×", "É", "µ", "\u0301", "\u0338", "=", "ā", "1"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 20))) for _ in range(1500)] + ["straße, ñandú$$$ à###", "élan***"]
    for column in ([texts[n]] for n in (-2, -1)):
        ours.encode(pa.array(column))
    assert not [p for p in seen if any(c.isalpha() for c in p)]
    found = ours.encode(pa.array(texts))
    for n, text in enumerate(texts):
        assert found.values[found.offsets[n]:found.offsets[n + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def huffman_cost(counts):
    heap, cost = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


@pytest.mark.parametrize("seed", range(8))
def test_codes(seed):
    draw = np.random.default_rng(seed)
    counts = draw.integers(0, 50, 300) ** 2
    free = huffman.code_lengths(counts, 30)
    assert (free * counts).sum() == huffman_cost(counts.tolist())
    short = huffman.code_lengths(counts, 9)
    assert short.max() <= 9 and (0.5 ** short[short > 0]).sum() <= 1
    assert ((short > 0) == (counts > 0)).all()
    code = huffman.Code(short)
    symbols = np.flatnonzero(counts)
    rows = Ragged.of([draw.choice(symbols, n) for n in (0, 1, 511, 512, 513, 3000, 0)], np.int64)
    packed, marks = code.pack(rows)
    for n in range(7):
        mine = packed.values[packed.offsets[n]:packed.offsets[n + 1]]
        starts = marks.values[marks.offsets[n]:marks.offsets[n + 1]]
        size = rows.lengths()[n]
        counts_ = np.minimum(size - np.arange(len(starts)) * huffman.STEP, huffman.STEP)
        wanted = rows.values[rows.offsets[n]:rows.offsets[n + 1]]
        assert (code.unpack(mine, starts, counts_) == wanted).all()
        if len(starts) > 1:  # a stretch by itself
            assert (code.unpack(mine, starts[1:2], counts_[1:2]) == wanted[huffman.STEP:2 * huffman.STEP]).all()


def test_limits():
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    assert huffman.code_lengths(np.zeros(3, int)).tolist() == [0, 0, 0]
    with pytest.raises(ValueError, match="longer than 2"):
        huffman.code_lengths(np.ones(5, int), 2)
    with pytest.raises(ValueError, match="no code"):
        huffman.Code(np.array([1, 0])).pack(Ragged.of([np.array([1])], np.int64))


def stored(spark, frame, path, **more):
    token_files.write(token_files.encode(frame, PATH, end=2), str(path), **more)
    return token_files.read(spark, str(path))


def test_odd_rows_come_back_in_order(spark, odd_rows, tmp_path):
    library = Tokenizer.from_file(PATH)
    found = stored(spark, odd_rows, tmp_path / "t", shards=3).collect()
    assert len(found) == odd_rows.count()
    rows = sorted(odd_rows.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    at = 0
    for row, back in zip(rows, sorted(found, key=lambda r: r["start"])):
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [2]
        assert (back["key"], back["start"], back["n_tokens"]) == (row["doc_id"], at, len(ids))
        assert zlib.crc32(back["ids"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_no_rows(spark, no_rows, tmp_path):
    assert stored(spark, no_rows, tmp_path / "t").count() == 0


def test_blocks_and_shards(spark, texts, tmp_path, monkeypatch):
    rows = [(n, texts("en", n, 300)) for n in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = stored(spark, frame, tmp_path / "t", shards=4).orderBy("key").collect()
    starts = np.cumsum([0] + [r["n_tokens"] for r in found])
    assert [r["start"] for r in found] == starts[:-1].tolist()
    blocks = spark.read.parquet(str(tmp_path / "t" / "blocks"))
    assert 1 < blocks.select("shard").distinct().count() <= 4
    assert not (tmp_path / "t" / "_ids").exists()


def test_one_key_over_several_shards(spark, texts, tmp_path):
    rows = [(None if n % 3 else n, texts("en", n % 50, 60)) for n in range(240)] + [(7, texts("de", n, 30)) for n in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = stored(spark, frame, tmp_path / "t", shards=8).orderBy("start").collect()
    assert [r["start"] for r in found] == np.cumsum([0] + [r["n_tokens"] for r in found])[:-1].tolist()
    keys = [r["key"] for r in found]
    assert keys == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    library = Tokenizer.from_file(PATH)
    want = sorted((str(k), library.encode(t, add_special_tokens=False).ids + [2]) for k, t in rows)
    assert sorted((str(r["key"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in found) == want
    blocks = spark.read.parquet(str(tmp_path / "t" / "blocks")).select("shard", "keys").collect()
    for key in (None, 7):
        assert len({b["shard"] for b in blocks if key in b["keys"]}) > 2


def test_counts_of_batches_and_of_rows_are_one_code(spark, odd_rows, tmp_path):
    frame = token_files.encode(odd_rows, PATH, end=2)
    for name, counts in (("a", "counts"), ("b", None)):
        token_files.write(frame, str(tmp_path / name), counts=counts)
    a, b = (sorted(map(tuple, spark.read.parquet(str(tmp_path / n / "code")).collect())) for n in "ab")
    assert a == b and a
