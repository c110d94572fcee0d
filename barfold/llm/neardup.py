"""Near duplicates among embeddings by an inverted multi-index.

A vector's two halves have a codebook each (k-means on a bounded sample); a vector lies in the cell of its two
nearest centroids. Two unit vectors with cosine c are sqrt(2 - 2c) apart. For each half, the distance
from a query to everything in a centroid's part of space is at least its distance to the half-spaces that
bound it; the cells are visited in ascending order of the two bounds' squares (the multi-sequence
traversal) until no unvisited cell can hold a vector within the linking distance, so the target recall is 1.
Candidates are verified by their cosine in double precision.

Vectors whose unit vectors agree in every bit are one class, which counts as many as it has rows and is compared
once; so copies cost no comparison, and whatever the number of copies, a link is between classes.

The codebooks only decide how much is looked at. Every vector is indexed. Of two cells that may link, the one that comes
first on the shorter way round the ring of cells is probed from, so a link is found once and cells are probed about equally often.

Neighbouring cells make a region, of about a ``REGIONS``-th of a label's vectors, so that a vector travels to a region once, as the floats it
was given in, with the cells it visits there, and not once for each cell. Regions grow with the table up to half a part of
``PART`` vectors and ``PART_BYTES``. What moves grows in proportion to the table that far (some 260,000 vectors of 64 numbers
a label), and beyond that with the number of regions as well. A region's members are split into salted parts of about
``PART``; probes go to every part and are streamed. A part gives link counts per vector and a forest of its links, never all
pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those with a
null label or number, link with nothing; vectors of different lengths do not link; rows with one number are one
vector and are not counted as each other's links; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barfold.llm.components import components, small
from barfold.llm.labelled import draw
from barfold.sources.scratch import materialise, release

SAMPLE = 16_384
OCCUPANCY = 64
REGIONS = 8
LEAST = 4096
PART = 65_536
PART_BYTES = 32 << 20
SLICE_BYTES = 4 << 20
BLOCK = 2048
MEMBERS = 4096
APART = 1e-4
ROUNDS = 12


def _units(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Rows with a usable vector, and the vectors at length 1, in double precision."""
    rows, found = [], []
    for n, value in enumerate(column):
        if not value.is_valid or value.values.null_count or not len(value.values):
            continue
        vector = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
        largest = np.abs(vector).max()
        if np.isfinite(vector).all() and largest > 0:
            vector = vector / largest  # no overflow of squares
            rows.append(n)
            found.append(vector / np.sqrt(vector @ vector))
    return rows, found


def _packed(column: pa.Array, rows: list[int]) -> list[bytes]:
    """The vectors of these rows as they were given: floats in 4 bytes, all others in 8."""
    kind = "<f4" if pa.types.is_float32(column.type.value_type) else "<f8"
    return [column[n].values.to_numpy(zero_copy_only=False).astype(kind).tobytes() for n in rows]


def _unpacked(vectors: list[bytes], length: int) -> np.ndarray:
    """Unit vectors of what :func:`_packed` gave, in double precision."""
    kind = f"<f{len(vectors[0]) // length}"
    found = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), length).astype(np.float64)
    found /= np.abs(found).max(axis=1)[:, None]
    return found / np.sqrt(np.einsum("ij,ij->i", found, found))[:, None]


def _half(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (vectors.shape[1] + 1) // 2
    return vectors[:, :middle], vectors[:, middle:]


def _squares(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1), 0)


def _codebook(points: np.ndarray, size: int) -> np.ndarray:
    """k-means from evenly spaced rows; fewer centroids if there are fewer different points.

    No two centroids are closer than ``APART``: the bounds divide by their distance. Points that differ by
    rounding only, as one vector at several scales, are one point.
    """
    points = np.unique(points.round(4), axis=0)
    centroids = points[np.linspace(0, len(points) - 1, min(size, len(points))).astype(int)]
    for _ in range(ROUNDS):
        nearest = _squares(points, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        held = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centroids)
    kept: list[np.ndarray] = []
    for centroid in np.unique(centroids, axis=0):
        if not kept or (((np.array(kept) - centroid) ** 2).sum(1) >= APART**2).all():
            kept.append(centroid)
    return np.array(kept).reshape(len(kept), points.shape[1])


def _bounds(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared lower bound of the distance from each point to each centroid's part of space.

    The squares that place a vector and a point are off by rounding; ``error`` covers both.
    """
    squares = _squares(points, centroids)
    error = 32 * (centroids.shape[1] + 4) * np.finfo(np.float64).eps
    apart = np.array([np.sqrt(((centroids - c) ** 2).sum(1)) for c in centroids])
    np.fill_diagonal(apart, np.inf)
    least = np.zeros_like(squares)
    for k in range(len(centroids)):
        least[:, k] = ((squares[:, k, None] - error - squares) / (2 * apart[k])).max(1, initial=0)
    return np.nan_to_num(least, nan=0.0, posinf=0.0) ** 2


def _sequence(one: list[float], two: list[float], most: float) -> Iterator[tuple[int, int]]:
    """Places in two ascending lists in the order of their sum, up to ``most``: the multi-sequence traversal.

    A pair comes onto the heap when the pair before it in each list has been taken, so the heap has at most
    one pair per place of the shorter list, and only pairs next to those taken are ever looked at.
    """
    heap, taken = [(one[0] + two[0], 0, 0)], set()
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > most:
            return
        taken.add((i, j))
        yield i, j
        if i + 1 < len(one) and (j == 0 or (i + 1, j - 1) in taken):
            heapq.heappush(heap, (one[i + 1] + two[j], i + 1, j))
        if j + 1 < len(two) and (i == 0 or (i - 1, j + 1) in taken):
            heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))


class Index:
    """The codebooks by vector length; ``each`` is how many vectors a label has on average."""

    def __init__(self, books: dict[int, tuple[np.ndarray, np.ndarray]], each: float = 0) -> None:
        self.books, self.each = books, each
        self.least, self.part = LEAST, PART

    def _book(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        # A length that the sample missed has one cell.
        middle = (length + 1) // 2
        return self.books.get(length) or (np.zeros((1, middle)), np.zeros((1, length - middle)))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        book = self._book(vectors.shape[1])
        one, two = (_squares(h, b).argmin(1) for h, b in zip(_half(vectors), book, strict=True))
        return one * len(book[1]) + two

    def size(self, length: int) -> int:
        """Number of cells."""
        one, two = self._book(length)
        return len(one) * len(two)

    def regions(self, length: int) -> int:
        """Number of regions that the cells are dealt to, in order."""
        wanted = min(max(self.each / REGIONS, self.least), max(1, min(self.part, PART_BYTES // (8 * length))) / 2)
        return max(1, min(self.size(length), int(np.ceil(self.each / wanted))))

    def region(self, cells: np.ndarray, length: int) -> np.ndarray:
        return cells * self.regions(length) // self.size(length)

    def ahead(self, cell: int, cells: np.ndarray, length: int) -> np.ndarray:
        """Those of ``cells`` that are probed from ``cell``: of two, one is ahead of the other."""
        size = self.size(length)
        way = (cells - cell) % size
        return cells[(way > 0) & ((2 * way < size) | ((2 * way == size) & (cells > cell)))]

    def visits(self, vectors: np.ndarray, distance: float) -> Iterator[np.ndarray]:
        """Cells of each vector, nearest first, until no other can hold a vector within ``distance``."""
        book = self._book(vectors.shape[1])
        one, two = (_bounds(h, b) for h, b in zip(_half(vectors), book, strict=True))
        most = distance**2 + 1e-9
        for x, y in zip(one, two, strict=True):
            first, second = np.argsort(x, kind="stable"), np.argsort(y, kind="stable")
            pairs = _sequence(x[first].tolist(), y[second].tolist(), most)
            yield np.array([first[i] * len(book[1]) + second[j] for i, j in pairs], np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices whose vectors have about ``SLICE_BYTES``, as each may be sent to all regions."""
    step = max(1, SLICE_BYTES * len(batch) // max(1, batch.column("vector").nbytes))
    for low in range(0, len(batch), step):
        yield batch.slice(low, step)


def build(vectors: DataFrame) -> Index:
    """Codebooks from about ``SAMPLE`` rows (``label``, ``embedding``), sized for ``OCCUPANCY`` vectors of a label in a cell."""
    count, labels = vectors.agg(F.count("*"), F.approx_count_distinct("label")).first()
    size = max(1, min(int(np.ceil(np.sqrt(count / max(1, labels) / OCCUPANCY))), SAMPLE // 16))
    sample = vectors.where(draw("vec_id", F.lit(9)) < min(1.0, SAMPLE / max(1, count))).select("vec_id", "embedding")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        # One group: its rows are the bounded sample.
        frame = frame.sort_values("vec_id", kind="stable")
        found = []
        vectors_ = _units(pa.array(frame["embedding"].tolist(), pa.list_(pa.float64())))[1]
        for length in sorted({len(v) for v in vectors_}):
            same = np.array([v for v in vectors_ if len(v) == length])
            one, two = (_codebook(h, size) for h in _half(same))
            found.append((length, len(one), one.tobytes(), two.tobytes()))
        return pd.DataFrame(found, columns=["length", "ones", "one", "two"])

    rows = sample.groupBy().applyInPandas(fit, "length int, ones int, one binary, two binary").collect()
    return Index({
        r["length"]: (np.frombuffer(r["one"]).reshape(r["ones"], -1),
                      np.frombuffer(r["two"]).reshape(-1, r["length"] // 2) if r["length"] > 1 else np.zeros((1, 0)))
        for r in rows
    }, count / max(1, labels))


def link(
    vectors: DataFrame, *, cosine: float = 0.98, key: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors``; only equal labels link."""
    spark = vectors.sparkSession
    plain = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"),
                           F.col(label).alias("label"))
    usable = plain.where("vec_id is not null and label is not null and embedding is not null")
    index = spark.sparkContext.broadcast(build(usable))
    distance = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    kind = usable.schema["label"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            rows, units = _units(column)
            ids, labels = (batch.column(c).take(pa.array(rows, pa.int64())) for c in ("vec_id", "label"))
            lengths = np.array([len(u) for u in units], np.int64)
            cells, regions = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            for length in np.unique(lengths).tolist():
                same = np.flatnonzero(lengths == length)
                cells[same] = index.value.cells(np.array([units[n] for n in same]))
                regions[same] = index.value.region(cells[same], length)
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(lengths), pa.array(_packed(column, rows), pa.binary()),
                 pa.array([hashlib.sha256(u.tobytes()).digest() for u in units], pa.binary()), pa.array(cells), pa.array(regions)],
                names=["vec_id", "label", "length", "vector", "same", "cell", "region"])

    every = materialise(usable.mapInArrow(
        place, f"vec_id long, label {kind}, length long, vector binary, same binary, cell long, region long"))
    # A number with several vectors is a class by itself in each, so that it never counts as its own link.
    rows = every.select("vec_id", "label", "same").distinct()
    several = rows.groupBy("vec_id").count().where("count > 1").select("vec_id", F.col("vec_id").cast("string").alias("alone"))
    keyed = materialise(rows.join(several, "vec_id", "left").na.fill("", ["alone"]))
    named = ["label", "same", "alone"]
    classes = materialise(keyed.groupBy(*named).agg(F.min("vec_id").alias("first"), F.count("*").alias("size")))
    placed = materialise(
        every.dropDuplicates(["vec_id", "label", "same"])
        .join(classes.select(F.col("first").alias("vec_id"), "label", "same", "size"), ["vec_id", "label", "same"]).drop("same"))
    release(every)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield _sent(part, index.value, distance)

    where = ["label", "length", "region"]
    most = F.greatest(F.lit(1), F.least(F.lit(PART), F.floor(F.lit(PART_BYTES) / (8 * F.col("length")))))
    # A region without members is not here, so probes of it meet nobody and are dropped.
    salts = small(placed.groupBy(*where).agg(F.count("*").alias("count")).select(*where, F.ceil(F.col("count") / most).cast("int").alias("salts")))
    dealt = placed.mapInArrow(
        deal, f"label {kind}, length long, vec_id long, vector binary, size long, cell long, region long, home boolean, visits binary")
    salt, mine = F.col("salt"), F.col("mine")
    parts = [*where, "salt"]
    rows = (
        dealt.join(salts, where).withColumn("mine", F.when(F.col("home"), F.pmod(F.xxhash64("vec_id"), F.col("salts"))).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        # At home it is a member of its own part. It probes the others, for vectors of its own cell those of higher number only.
        .withColumn("probe", F.coalesce(salt != mine, F.lit(True)))
        .withColumn("own", F.coalesce(salt > mine, F.lit(False)))
        .where("not probe or own or length(visits) > 0")
        .select(*parts, "probe", "vec_id", "vector", "size", "cell", "own", "visits")
        .repartition(*parts).sortWithinPartitions(*parts, "probe", "vec_id")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*parts, "probe", "vec_id", "vector", "size", "cell", "own", "visits")]
            for *at, is_probe, vec_id, vector, size, cell, own, visits in zip(*columns, strict=True):
                if now is None or now.at != at:
                    if now is not None:
                        yield from now.finish()
                    now = _Part(at, cosine)
                yield from now.add(is_probe, vec_id, vector, size, cell, own, visits)
        if now is not None:
            yield from now.finish()

    found = materialise(rows.mapInArrow(verify, "a long, b long, n long"))
    release(placed)
    counts = found.where("b is null").groupBy(F.col("a").alias("first")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "first")
    classified = (
        classes.join(counts, "first", "left").join(groups, "first", "left")
        .select(*named, (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                F.coalesce("component", "first").alias("component"))
    )
    members = keyed.join(classified, named).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    return (
        plain.select("vec_id").join(members, "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _sent(batch: pa.RecordBatch, index: Index, distance: float) -> pa.RecordBatch:
    """Each vector at home, and once for each other region with cells that it visits; ``visits`` are the cells there."""
    lengths, cells, homes = (batch.column(c).to_numpy() for c in ("length", "cell", "region"))
    rows, regions, visits = [], [], []
    for length in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == length)
        units = _unpacked(batch.column("vector").take(pa.array(same)).to_pylist(), length)
        for n, seen in zip(same.tolist(), index.visits(units, distance), strict=True):
            seen = np.sort(index.ahead(cells[n], seen, length))
            of = index.region(seen, length)
            met = np.union1d(of, homes[n])
            rows += [n] * len(met)
            regions += met.tolist()
            visits += [seen[of == r].astype("<i4").tobytes() for r in met]
    at, region = np.array(rows, np.int64), np.array(regions, np.int64)
    taken = {c: batch.column(c).take(pa.array(at)) for c in ("label", "length", "vec_id", "vector", "size", "cell")}
    return pa.RecordBatch.from_pydict(
        taken | {"region": pa.array(region), "home": pa.array(region == homes[at]), "visits": pa.array(visits, pa.binary())})


class _Rows:
    """Rows of one kind: vectors with the cells that they look into."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.vectors: list[bytes] = []
        self.sizes: list[int] = []
        self.cells: list[int] = []
        self.visits: list[bytes] = []

    def add(self, vec_id: int, vector: bytes, size: int, cell: int, visits: bytes) -> None:
        for held, value in zip((self.ids, self.vectors, self.sizes, self.cells, self.visits), (vec_id, vector, size, cell, visits),
                               strict=True):
            held.append(value)


class _Part:
    """One salted part of a region: its members in order of cells, and probes in blocks. Yields link counts (``b`` null) and links."""

    def __init__(self, at: list, cosine: float) -> None:
        self.at, self.cosine, self.length = at, cosine, at[1]
        self.rows, self.probes = _Rows(), _Rows()
        self.matrix: np.ndarray | None = None

    def add(self, is_probe: bool, vec_id: int, vector: bytes, size: int, cell: int, own: bool, visits: bytes) -> Iterator[pa.RecordBatch]:
        if not is_probe:
            self.rows.add(vec_id, vector, size, cell, visits)
            return
        self.probes.add(vec_id, vector, size, cell, visits + (np.int32(cell).astype("<i4").tobytes() if own else b""))
        if len(self.probes.ids) >= BLOCK:
            yield from self._meet()

    def _close(self) -> None:
        """Members as a matrix, in order of their cells."""
        if self.matrix is not None:
            return
        rows, self.rows = self.rows, _Rows()
        cells = np.array(rows.cells, np.int64)
        order = np.argsort(cells, kind="stable")
        self.matrix = _unpacked(rows.vectors, self.length)[order] if len(order) else np.zeros((0, self.length))
        self.ids, self.sizes = np.array(rows.ids, np.int64)[order], np.array(rows.sizes, np.int64)[order]
        self.visits = [rows.visits[n] for n in order.tolist()]
        self.cells, self.starts = np.unique(cells[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))[: len(self.starts)]
        self.counts = np.zeros(len(order), np.int64)

    def _meet(self) -> Iterator[pa.RecordBatch]:
        self._close()
        probes, self.probes = self.probes, _Rows()
        if probes.ids and len(self.ids):
            ids, sizes = np.array(probes.ids, np.int64), np.array(probes.sizes, np.int64)
            counts = np.zeros(len(ids), np.int64)
            pairs = self._visit(ids, _unpacked(probes.vectors, self.length), sizes, counts, probes.visits)
            yield from _found(ids, counts, pairs)

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self._meet()
        self._close()
        for k in range(0, len(self.ids), BLOCK):
            some = slice(k, k + BLOCK)
            # The counts are a view of all.
            pairs = self._visit(self.ids[some], self.matrix[some], self.sizes[some], self.counts[some], self.visits[some])
            yield from _found(np.zeros(0, np.int64), np.zeros(0, np.int64), pairs)
        pairs = []
        for start, end in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            for k in range(start, end if end - start > 1 else start, BLOCK):
                some = slice(k, min(k + BLOCK, end))
                for low in range(k, end, MEMBERS):
                    pairs += self._links(
                        self.ids[some], self.matrix[some], self.sizes[some], self.counts[some], slice(low, min(low + MEMBERS, end)), low - k)
                if len(pairs) >= BLOCK:
                    yield from _found(np.zeros(0, np.int64), np.zeros(0, np.int64), pairs)
                    pairs = []
        yield from _found(self.ids, self.counts, pairs)

    def _visit(self, ids: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, counts: np.ndarray, visits: list[bytes]) -> list[tuple[int, int]]:
        """Meets some vectors with the members of the cells that they visit."""
        cells = np.frombuffer(b"".join(visits), "<i4")
        order = np.argsort(cells, kind="stable")
        owner = np.repeat(np.arange(len(ids)), [len(v) // 4 for v in visits])[order]
        cells = cells[order]
        low, high = np.searchsorted(cells, self.cells, "left"), np.searchsorted(cells, self.cells, "right")
        pairs = []
        for n in np.flatnonzero(high > low).tolist():
            some = owner[low[n] : high[n]]
            left, held = vectors[some], np.zeros(len(some), np.int64)
            for k in range(self.starts[n], self.ends[n], MEMBERS):
                pairs += self._links(ids[some], left, sizes[some], held, slice(k, min(k + MEMBERS, self.ends[n])), None)
            counts[some] += held  # a vector visits a cell once
        return pairs

    def _links(self, a: np.ndarray, left: np.ndarray, size_a: np.ndarray, count_a: np.ndarray, members: slice,
               own: int | None) -> list[tuple[int, int]]:
        """Counts the links of some vectors with some members, and gives a forest of them. Vectors that are members themselves
        meet only those behind them: the first of ``members`` comes ``own`` places after the first vector."""
        b, size_b = self.ids[members], self.sizes[members]
        near = left @ self.matrix[members].T >= self.cosine
        if not near.any():
            return []
        near &= a[:, None] != b
        if own is not None:  # each pair of members once
            near &= np.arange(len(a))[:, None] < np.arange(len(b)) + own
        rows = np.flatnonzero(near.any(1))
        if not len(rows):
            return []
        count_a += near @ size_b
        self.counts[members] += near.T @ size_a
        ids, number = np.unique(np.concatenate((a, b)), return_inverse=True)
        root, pairs = np.arange(len(ids)), []
        of_a, of_b = number[: len(a)], number[len(a) :]
        for x in rows:
            # One link to each tree that the row meets and is not in yet.
            met = np.flatnonzero(near[x])
            trees, at = np.unique(root[of_b[met]], return_index=True)
            for tree, y in zip(trees.tolist(), met[at].tolist(), strict=True):
                mine = root[of_a[x]]
                if tree != mine:
                    root[root == tree] = mine
                    pairs.append((int(a[x]), int(b[y])))
        return pairs


def _found(ids: np.ndarray, counts: np.ndarray, pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    linked = counts > 0
    if linked.any() or pairs:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((ids[linked], np.array([p[0] for p in pairs], np.int64)))),
             pa.array([None] * int(linked.sum()) + [p[1] for p in pairs], pa.int64()),
             pa.array(np.concatenate((counts[linked], np.zeros(len(pairs), np.int64))))],
            names=["a", "b", "n"])
