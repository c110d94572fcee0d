import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barfold.llm import acceptor, variants
from barfold.llm.queries import QUERIES, SLIP, table
from tests.conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, least_chars=5, least=3, slip=SLIP):
    found = Counter()
    for key, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if slip and h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if n >= least and len(w) >= least_chars}


def grouped(known):
    """The result by plain Python."""
    holed, near = defaultdict(set), defaultdict(set)
    for word in known:
        for k in range(len(word)):
            less = word[:k] + word[k + 1 :]
            holed[k, less].add(word)
            if less in known:
                near[word].add(less)
                near[less].add(word)
    for words in holed.values():
        for a in words:
            near[a] |= words - {a}
    form = {}
    for word, n in known.items():
        if near[word]:
            best = min(near[word], key=lambda x: (-known[x], x))
            if known[best] >= 2 * n:
                form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return {(w, form.get(w), root(w), n, len(near[w]), known[form[w]] if w in form else None) for w, n in known.items()}


def rows_of(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    want = grouped(counted(rows))
    assert rows_of(QUERIES["op11_spelling_variants"](spark, SMALL)) == want
    assert sum(w[1] is not None for w in want) > 50


@pytest.mark.parametrize("size", [3, 40, 1 << 14])
def test_partitions_of_any_size_find_every_pair_once(spark, monkeypatch, size):
    import random

    draw = random.Random(7)
    made = {"".join(draw.choices("ab", k=draw.randint(1, 9))) for _ in range(400)}
    made |= {"unter" + "".join(draw.choices("abc", k=5)) for _ in range(150)}  # a hot beginning
    made |= {"".join(draw.choices("ab\U0001f600é", k=4)) + "keit" for _ in range(150)}  # a hot end
    made |= {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499}
    known = {w: draw.randint(1, 50) for w in made}
    monkeypatch.setattr(variants, "PARTITION_WORDS", size)
    monkeypatch.setattr(variants, "CHUNK_WORDS", 100)
    found = variants.group(spark.createDataFrame(list(known.items()), "word string, n long"))
    assert rows_of(found) == grouped(known)


def test_vocabulary_of_odd_rows(spark, odd_rows, no_rows):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    for slip in (None, 2, SLIP):
        found = variants.vocabulary(odd_rows, slip=slip, least_count=2)
        assert {r.word: r.n for r in found.collect()} == counted(rows, least=2, slip=slip)
    assert variants.vocabulary(no_rows).isEmpty()


def test_vocabulary_edges(spark):
    texts = [(1, "Été ÀÉÎõü×÷ÿ straße x"), (1, "Été ÀÉÎõü×÷ÿ straße x"), (None, "naïve-naïve NAÏVE Ωmega" + "Āb" * 3), (2, "a" * 100_000)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    for slip in (None, 1, 2):
        found = variants.vocabulary(frame, slip=slip, least_chars=1, least_count=1)
        assert {r.word: r.n for r in found.collect()} == counted(texts, 1, 1, slip)


def test_group_of_odd_vocabularies(spark):
    rows = [("abc", 1), ("abc", 2), ("abd", 6), (None, 4), ("", 9), ("abe", None), ("ab", 1), ("b", 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "word string, n long, form string, root long")
    assert rows_of(variants.group(frame)) == grouped({"abc": 3, "abd": 6, "ab": 1, "b": 1})
    assert variants.group(frame.limit(0)).isEmpty()


def test_chains_are_followed_to_their_end(spark):
    words = ["a" * k for k in range(1, 41)]
    known = {w: 2**k for k, w in enumerate(words)}
    found = variants.group(spark.createDataFrame(list(known.items()), "word string, n long")).collect()
    assert {r.root for r in found} == {words[-1]}


def test_acceptor_is_minimal():
    words = ["tap", "taps", "top", "tops"]
    flat = np.frombuffer("".join(words).encode(), np.uint8).astype(np.int64)
    sizes = np.array([len(w) for w in words])
    made = acceptor.build(flat, np.cumsum(sizes) - sizes, sizes)
    assert len(made.first) - 1 == 5 and len(made.label) == 5
    assert [words[r] for r in made.row] == sorted(words)
