import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barfold.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "'re", "é", "ß", " ", "　", "\x1c", "\x85", "1", "23", "!", "!!!",
          "%%%", "<|endoftext|>", "<", "|", "the", " the", "日本", "\U0001f600", "́", " ", "x" * 30, "ab" * 70, "\r\n", "\0"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ours():
    return bpe.ByteLevel(json.loads(open(PATH).read()))


def test_ids_and_texts_of_the_library(library, ours):
    draw = random.Random(1)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 25))) for _ in range(1500)]
    texts += [None, "", "a" * 3000, " " * 500, "<|endoftext|>"]
    found = ours.encode(pa.array(texts, pa.string()))
    for n, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found.values[found.offsets[n]:found.offsets[n + 1]].tolist() == ids
        assert ours.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False) == (text or "")


def merged(word, ranks):
    """Plain BPE: the lowest-ranked pair first, from the left."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, at = min((ranks.get((a, b), 1 << 30), n) for n, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 30:
            break
        pair = parts[at], parts[at + 1]
        joined, n = [], 0
        while n < len(parts):
            if n + 1 < len(parts) and (parts[n], parts[n + 1]) == pair:
                joined.append(parts[n] + parts[n + 1])
                n += 2
            else:
                joined.append(parts[n])
                n += 1
        parts = joined
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_automaton_against_plain_merging(seed):
    draw = random.Random(seed)
    tokens = [b"a", b"b", b"c"]
    pairs = []
    while len(pairs) < 14:
        u, v = draw.choice(tokens), draw.choice(tokens)
        if (u, v) not in pairs and u + v not in tokens:
            pairs.append((u, v))
            tokens.append(u + v)
    vocabulary = {t: n for n, t in enumerate(tokens)}
    automaton = bpe.Automaton(vocabulary, [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs])
    words = [bytes(draw.choices(b"abc", k=draw.randint(1, 90))) for _ in range(150)]
    found = automaton.encode(words)
    ranks = {p: n for n, p in enumerate(pairs)}
    for n, word in enumerate(words):
        assert [tokens[t] for t in found.values[found.offsets[n]:found.offsets[n + 1]]] == merged(word, ranks)


def test_odd_rows_round_trip(spark, odd_rows, no_rows):
    tokenizer = bpe.Tokenizer(spark, PATH)
    encoded = bpe.encode(odd_rows, tokenizer)  # takes the place of the column "ids"
    back = bpe.decode(encoded, tokenizer, to="back").collect()
    assert len(back) == odd_rows.count()
    assert all(r["back"] == (r["text"] or "") for r in back)
    assert bpe.encode(no_rows, tokenizer).count() == 0
    nulls = spark.createDataFrame([(None,), ([220],)], "ids array<int>")
    assert sorted(r["text"] for r in bpe.decode(nulls, tokenizer).collect()) == ["", " "]


def test_long_words(library, ours):
    import random
    import time

    draw = random.Random(4)
    words = ["a" * 100_000, "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(20_000)),
             "".join(draw.choice(["the", "ing", "er", "on"]) for _ in range(5000)), "?!" * 40, "x" * 65]
    begin = time.perf_counter()
    found = [ours.encode(pa.array([w])).values.tolist() for w in words]
    assert time.perf_counter() - begin < 5
    assert found == [library.encode(w, add_special_tokens=False).ids for w in words]
