import random

import numpy as np

from barfold.llm import texts


def hashed(words):
    joined = b" ".join(words)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes + 1) - sizes - 1
    return texts.hashes(np.frombuffer(joined, np.uint8), starts, starts + sizes).tolist()


def test_equal_bytes_have_equal_hashes_and_others_have_not():
    draw = random.Random(1)
    words = [bytes(draw.choices(b"ab\0", k=draw.randint(0, 40))) for _ in range(4000)]
    by_word = {}
    for word, found in zip(words, hashed(words), strict=True):
        assert by_word.setdefault(word, found) == found
    assert len(set(by_word.values())) == len(by_word)


def test_words_on_which_polynomials_collide():
    """Thue-Morse words have one hash under any base modulo 2^64."""
    bits = [0]
    for _ in range(12):
        bits += [1 - b for b in bits]
        one, two = (bytes(97 + (b ^ flip) for b in bits) for flip in (0, 1))
        assert len(set(hashed([one, two]))) == 2


def test_no_runs():
    none = np.zeros(0, np.int64)
    assert len(texts.hashes(np.zeros(0, np.uint8), none, none)) == 0
