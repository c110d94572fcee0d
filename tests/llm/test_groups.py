"""Components, the Jaccard join and near duplicates among embeddings, against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from barfold.llm import components as parts
from barfold.llm import jaccard, neardup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Union:
    def __init__(self, nodes):
        self.to = {n: n for n in nodes}

    def find(self, n):
        while self.to[n] != n:
            n = self.to[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.to[max(a, b)] = min(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)]
    links += [(100 + n, 101 + n) for n in range(20)] + [(200, 201 + n) for n in range(20)] + [(7, 7)]
    union = Union({n for link in links for n in link})
    for a, b in links:
        union.join(a, b)
    found = {r["node"]: r["component"] for r in parts.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: union.find(n) for n in linked}


def test_no_links(spark):
    assert parts.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_sets(rows, size):
    sets = {}
    for number, text in rows:
        words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in WORD.findall((text or "").encode())]
        found = {tuple(words[n:n + size]) for n in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets.setdefault(number, []).append(found)
    return sets


def joined(rows, rule):
    """Set sizes and components of rows with a number, by comparing all pairs."""
    sets = shingle_sets([r for r in rows if r[0] is not None], rule.words)
    union, flat = Union(sets), [(n, s) for n, own in sets.items() for s in own if s]
    for x, (a, s) in enumerate(flat):
        for b, t in flat[:x]:
            if 100 * len(s & t) >= rule.percent * len(s | t):
                union.join(a, b)
    return sorted((n, len(s), union.find(n)) for n, own in sets.items() for s in own)


def corpus(texts, seed):
    """Copies, near copies on both sides of the limit, shared passages and families of edits."""
    draw, rows = random.Random(seed), []
    passage = texts("en", "passage", 55)
    for number in range(60):
        words = texts("en", (seed, draw.randrange(18)), draw.choice([3, 8, 30, 80, 160])).split()
        for _ in range(draw.choice([0, 0, 1, 2, 5])):
            words[draw.randrange(len(words))] = draw.choice(["edit", "Edit", "é", "other"])
        rows.append((number, " ".join(words) + (f"\n{passage}" if draw.random() < 0.3 else "")))
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85), jaccard.Rule(5, 80), jaccard.Rule(2, 100), jaccard.Rule(1, 50)])
def test_join(spark, texts, seed, rule):
    rows = corpus(texts, seed)
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    assert sorted(map(tuple, found)) == joined(rows, rule)


def test_large_groups_in_parts(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "WIDE", 3)
    monkeypatch.setattr(jaccard, "PART", 4)
    monkeypatch.setattr(jaccard, "SAMPLE_TIMES", 1 << 20)
    rows, rule = corpus(texts, 9), jaccard.Rule(4, 85)
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    assert sorted(map(tuple, found)) == joined(rows, rule)


def test_family_of_one_size_in_parts(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "WIDE", 8)
    monkeypatch.setattr(jaccard, "PART", 4)
    words, rule = texts("en", "template", 90).split(), jaccard.Rule(5, 80)
    # A third are near copies with two words of their own; some of these are too far from each other to link.
    rows = [(n, " ".join([*words[:20 + n % 3], f"own{n}", *words[21 + n % 3:-1 - n % 2], f"last{n}"])) for n in range(60)]
    rows += [(100 + n, texts("en", ("other", n), 91)) for n in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    classes = jaccard._signatures(frame, rule).select("doc_id", "n", "bits", "prefix")
    held = jaccard._members(classes, rule).groupBy("token", "band", "one", "two").count().toPandas()
    assert held["two"].max() > 5 and held["count"].max() <= 8 * jaccard.PART
    assert sorted(map(tuple, jaccard.join(frame, rule).collect())) == joined(rows, rule)


def test_nodes_inside_one_cluster_are_not_expanded(monkeypatch):
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 62, 300).astype(np.uint64)
    sets = [np.unique(np.append(base, draw.integers(0, 1 << 62, 2).astype(np.uint64))) for _ in range(2048)]
    bitmaps, sizes = [jaccard._bitmap(s) for s in sets], np.array([len(s) for s in sets])
    seen, possible = [], jaccard.SignatureTree._possible
    monkeypatch.setattr(jaccard.SignatureTree, "_possible", lambda self, level, a, b, percent: (
        seen.append(len(a) * (level > 0)), possible(self, level, a, b, percent))[1])
    assert len(list(jaccard.SignatureTree(bitmaps, sizes).joined(80))) == len(sets) - 1
    # There are 33,000 pairs of the nodes above the members.
    whole, _ = sum(seen), seen.clear()
    sides = np.repeat([0, 1], len(sets) // 2)
    pairs = list(jaccard.SignatureTree(bitmaps, sizes, sides).joined(80))
    assert len(pairs) == len(sets) - 1 and all(sides[x] != sides[y] for x, y in pairs)
    assert max(whole, sum(seen)) < 20_000


def test_odd_rows(spark, odd_rows, no_rows):
    rule = jaccard.Rule()
    found = [tuple(r) for r in jaccard.join(odd_rows, rule).collect()]
    rows = [(r["doc_id"], r["text"]) for r in odd_rows.collect()]
    assert sorted(f for f in found if f[0] is not None) == joined(rows, rule)
    assert [f[2] for f in found if f[0] is None] == [None]
    assert jaccard.join(no_rows, rule).count() == 0


def test_rows_that_repeat_a_number_are_one(spark, texts):
    one, two = texts("en", 1), texts("en", 2)
    rows = [(1, one), (2, one), (2, two), (3, two), (4, texts("en", 4))]
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.Rule()).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]


def test_traversal_loses_no_pair():
    draw = np.random.default_rng(4)
    base = np.unique(draw.integers(0, 1 << 62, 300).astype(np.uint64))
    sets = []
    for _ in range(70):
        own = base.copy() if draw.random() < 0.6 else np.unique(draw.integers(0, 1 << 62, 300).astype(np.uint64))
        own[draw.integers(0, len(own), draw.integers(0, 40))] = draw.integers(0, 1 << 62)
        sets.append(np.unique(own))
    tree = jaccard.SignatureTree([jaccard._bitmap(s) for s in sets], np.array([len(s) for s in sets]))
    maybe, true = Union(range(70)), Union(range(70))
    for a, b in tree.joined(85, chunk=16):
        maybe.join(a, b)
    for a, b in jaccard._linked(sets, 85):
        true.join(a, b)
    for a in range(70):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                assert maybe.find(a) == maybe.find(b) and true.find(a) == true.find(b)


def vectors(seed, count=400, length=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(20, length))
    rows = []
    for n in range(count):
        spread = draw.choice([0.01, 0.03, 0.06, 1.0])
        rows.append((n, [float(x) for x in centres[draw.integers(20)] + spread * draw.normal(size=length)], int(draw.integers(2))))
    return rows


def linked(rows, least):
    ids = [r[0] for r in rows]
    matrix = np.array([r[1] for r in rows])
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    near = (matrix @ matrix.T >= least) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows]))
    np.fill_diagonal(near, False)
    union = Union(ids)
    for a, b in zip(*np.nonzero(near)):
        union.join(ids[a], ids[b])
    return sorted((n, int(near[x].sum()), union.find(n), union.find(n) == n) for x, n in enumerate(ids))


@pytest.mark.parametrize("part", [4096, 7])
@pytest.mark.parametrize("length", [16, 5, 1])
def test_embeddings(spark, monkeypatch, part, length):
    monkeypatch.setattr(neardup, "PART", part)
    monkeypatch.setattr(neardup, "OCCUPANCY", 4)
    rows = vectors(part + length, length=length)
    found = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=0.98)
    assert sorted(map(tuple, found.collect())) == linked(rows, 0.98)


@pytest.mark.parametrize("part", [4096, 50])
def test_embeddings_in_many_regions(spark, monkeypatch, part):
    for name, value in (("PART", part), ("LEAST", 20), ("OCCUPANCY", 4)):
        monkeypatch.setattr(neardup, name, value)
    rows = vectors(9, count=900)
    found = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=0.98)
    assert sorted(map(tuple, found.collect())) == linked(rows, 0.98)


def test_a_vector_is_sent_to_a_region_once(monkeypatch):
    """However many cells there are, what moves is bounded by the regions, and any two cells that may link meet once."""
    monkeypatch.setattr(neardup, "LEAST", 100)
    found = np.random.default_rng(6).normal(size=(800, 16))
    found /= np.linalg.norm(found, axis=1)[:, None]
    index = neardup.Index({16: tuple(neardup._codebook(h, 24) for h in neardup._half(found))}, len(found))
    cells = index.cells(found)
    count = len(found)
    batch = pa.RecordBatch.from_pydict({
        "label": pa.array([1] * count), "length": pa.array([16] * count), "vec_id": pa.array(range(count)),
        "vector": pa.array([v.tobytes() for v in found], pa.binary()), "size": pa.array([1] * count), "cell": pa.array(cells),
        "region": pa.array(index.region(cells, 16))})
    sent = neardup._sent(batch, index, 0.5).to_pylist()
    looked = sum(len(seen) for seen in index.visits(found, 0.5))
    assert index.regions(16) == 8 and index.size(16) == 576
    assert len({(r["vec_id"], r["region"]) for r in sent}) == len(sent) <= 8 * count < looked / 4
    assert sum(r["home"] for r in sent) == count
    met = {(r["vec_id"], c) for r in sent for c in np.frombuffer(r["visits"], "<i4").tolist()}
    near = found @ found.T >= 1 - 0.5**2 / 2
    for a, b in zip(*np.nonzero(np.triu(near, 1))):
        if cells[a] != cells[b]:
            assert ((int(a), int(cells[b])) in met) != ((int(b), int(cells[a])) in met)


def scaled(seed, count, length):
    """A third of the rows are one vector at different scales, as floats; the others lie around it or anywhere."""
    draw = np.random.default_rng(seed)
    one = draw.normal(size=length)
    rows = [one * draw.uniform(0.1, 10) for _ in range(count // 3)]
    rows += [one + 0.1 * draw.normal(size=length) for _ in range(count // 6)]
    rows += [draw.normal(size=length) for _ in range(count - len(rows))]
    return np.array(rows).astype(np.float32)


def test_centroids_that_nearly_coincide_lose_no_cell():
    found = scaled(3, 3000, 64).astype(np.float64)
    found /= np.linalg.norm(found, axis=1)[:, None]
    books = tuple(neardup._codebook(h, 32) for h in neardup._half(found))
    for book in books:
        apart = np.sqrt(((book[:, None] - book) ** 2).sum(2))
        assert len(book) > 16 and apart[~np.eye(len(book), dtype=bool)].min() >= neardup.APART
    index = neardup.Index({64: books})
    cells = index.cells(found)
    near = found @ found.T >= 0.98
    for row, seen in enumerate(index.visits(found, np.sqrt(2 - 2 * 0.98))):
        assert set(cells[near[row]].tolist()) <= set(seen.tolist())


def test_bounds_hold_for_any_centroids():
    points = scaled(4, 300, 16).astype(np.float64)
    points /= np.linalg.norm(points, axis=1)[:, None]
    centroids = points[::3]  # many of these differ by rounding only
    least = neardup._bounds(points, centroids)
    own = neardup._squares(points, centroids).argmin(1)
    squares = ((points[:, None] - points) ** 2).sum(2)
    assert np.isfinite(least).all() and (least[:, own] <= squares + 1e-9).all()


def test_one_vector_at_many_scales(spark, monkeypatch):
    monkeypatch.setattr(neardup, "OCCUPANCY", 2)
    rows = [(n, [float(x) for x in v], 1) for n, v in enumerate(scaled(5, 600, 64))]
    found = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), cosine=0.98)
    assert sorted(map(tuple, found.collect())) == linked(rows, 0.98)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [], 1),
            (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [1.0, None], 1), (10, [1.0, 0.0], None),
            (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0], 1), (12, [-1e300, 1e299], 1), (13, [-1e-300, 1e-301], 1)]
    found = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    got = {(r["vec_id"], r["component_id"], r["kept"]) for r in found}
    assert len(found) == len(rows)
    alone = {(n, n, True) for n in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)} | {(None, None, True)}
    assert got == alone | {(2, 1, False), (13, 12, False)}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neardup.link(empty).count() == 0


def test_cells_come_from_the_heap_in_order_and_stop_at_the_bound():
    draw = np.random.default_rng(2)
    for most in (0.0, 0.3, 1.1, 9.0):
        one, two = (np.sort(draw.random(n)).tolist() for n in (13, 7))
        found = list(neardup._sequence(one, two, most))
        sums = [one[i] + two[j] for i, j in found]
        assert sums == sorted(sums)
        assert sorted(found) == [(i, j) for i in range(13) for j in range(7) if one[i] + two[j] <= most]


def test_many_equal_vectors(spark):
    """Copies are one class: their number does not matter, and links between classes count all of them."""
    one, two, far = [1.0, 2.0, 0.5], [1.0, 2.05, 0.5], [-3.0, 1.0, 1.0]
    rows = [(n, one if n % 3 else two, 1) for n in range(20_000)] + [(30_000 + n, far, 1) for n in range(5)]
    rows += [(40_000, one, 2), (40_001, [2.0, 4.0, 1.0], 2)]
    found = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()}
    assert got == {n: (19_999, 0) for n in range(20_000)} | {30_000 + n: (4, 30_000) for n in range(5)} | {
        40_000: (1, 40_000), 40_001: (1, 40_000)}


def test_rows_of_one_number_are_no_links(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1)]
    found = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r["vec_id"], r["component_id"], r["n_links"] > 0) for r in found} == {(1, 1, True), (2, 1, True), (3, 3, False)}
    assert next(r["n_links"] for r in found if r["vec_id"] == 2) == 2
