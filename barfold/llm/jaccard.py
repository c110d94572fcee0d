"""N-gram Jaccard join by signature trees.

A document is its set of distinct shingles (``words`` neighbouring words, A-Z in lower case, words being runs
of bytes other than ASCII white space; with fewer words, the whole sequence is one shingle). Two sets link when
100 * intersection >= percent * union. The result is each document's set size and component.

1. Documents with equal sets are one class, represented by its smallest number.
2. Sets that link share a shingle among their first ``n - ceil(percent * n / 100) + 1`` in any one order of all
   shingles, so classes meet under those shingles only. The order puts shingles that are frequent in a
   bounded sample last; the sample decides no result, only how large the groups are. Shingles with
   equal lists of classes are one group, and a class stays in it only if another has a near enough size. Groups of more than ``WIDE`` classes are dealt
   out by size band, and bands of more than ``WIDE`` by pairs of parts of about ``PART``.
3. In each group a signature tree is built for every two neighbouring size bands: leaves are classes, with a token bitmap and a size, nodes hold the
   OR of their bitmaps and the range of sizes. A dual traversal from the root prunes node pairs whose
   maximum possible overlap (common bits, and tokens that share a bit) is too small. Pairs that
   remain join classes to clusters; a pair inside one cluster, or of nodes inside one, adds nothing and is skipped, so what comes out
   is a forest, not all pairs.
4. Any link lies within a cluster. Clusters are verified exactly on whole texts, by counting common
   shingles through an inverted index; a cluster of more than ``PART`` classes is dealt out by pairs of
   parts. Verified links give the components.

Shingles are 64-bit hashes. Defined cases: a text that is null, empty or only white space has no shingle and links
with nothing; a null number has no component and links with nothing; rows that repeat a number are one
document; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barfold.llm.components import components, small
from barfold.llm.labelled import draw
from barfold.llm.texts import byte_classes, hashes, lowered, mix, runs, shingled, slices
from barfold.sources.scratch import materialise

WORD = byte_classes(word=set(range(256)) - {0x20, *range(0x09, 0x0E)})
SAMPLE_DOCS = 20_000
SAMPLE_TIMES = 3
HOT = 200_000
WIDE = 4096
PART = 2048
FAN = 8
LEAST_BITS = 64
PLACES = 4


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the least similarity in percent."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        return n - (self.percent * n + 99) // 100 + 1


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for part in slices(column):
        starts, ends = runs(part.data, WORD)
        word, owner = hashes(lowered(part.data), starts, ends), part.document(starts)
        found, of = shingled(word, owner, words)
        bounds, edges = (np.searchsorted(x, np.arange(part.count + 1)) for x in (of, owner))
        for n in range(part.count):
            own = found[bounds[n] : bounds[n + 1]]
            if len(own):
                yield np.unique(own)
            else:
                # Fewer words than a shingle has: the sequence is the shingle.
                few = word[edges[n] : edges[n + 1]]
                total = np.full(min(1, len(few)), len(few), np.uint64)
                for w in few:
                    total = mix(total + w)
                yield total


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bits of tokens, at least ``PLACES`` for each, as 64-bit words."""
    size = max(LEAST_BITS, 1 << int(PLACES * len(tokens) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(tokens >> np.uint64(20)) & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer words for the same tokens."""
    return np.bitwise_or.reduce(words.reshape(-1, size), axis=0)


def _frequent(documents: DataFrame, rule: Rule) -> np.ndarray:
    """Shingles frequent in a sample of about ``SAMPLE_DOCS`` documents, at most ``HOT``; an order's parameter only."""
    total = documents.count()
    sample = documents.where(draw("doc_id", F.lit(5)) < min(1.0, SAMPLE_DOCS / max(1, total)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_sets(batch.column("text"), rule.words))
            tokens, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(times)], names=["token", "n"])

    rows = (
        sample.select("text").mapInArrow(count, "token long, n long")
        .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= SAMPLE_TIMES)
        .orderBy(F.desc("n"), "token").limit(HOT).select("token").toArrow()
    )
    return np.sort(rows["token"].to_numpy().view(np.uint64))


def _signatures(documents: DataFrame, rule: Rule) -> DataFrame:
    """Per document: set size, two numbers that name its set, its bitmap and its prefix of the order."""
    sent = documents.sparkSession.sparkContext.broadcast(_frequent(documents, rule))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for batch in batches:
            sizes, sums, mixes, bits, prefixes = [], [], [], [], []
            for tokens in _sets(batch.column("text"), rule.words):
                n = len(tokens)
                sizes.append(n)
                sums.append(tokens.sum(dtype=np.uint64))
                mixes.append(mix(tokens + np.uint64(n)).sum(dtype=np.uint64))
                bits.append(_bitmap(tokens).tobytes() if n else b"")
                if not n:
                    prefixes.append(tokens.view(np.int64))
                    continue
                late = np.searchsorted(hot, tokens)
                late = (hot[np.minimum(late, len(hot) - 1)] == tokens) if len(hot) else np.zeros(n, bool)
                # Tokens are in order of their hashes, so a stable sort leaves that order within both kinds.
                prefixes.append(tokens[np.argsort(late, kind="stable")[: rule.prefix(n)]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(np.array(sums, np.uint64).view(np.int64)), pa.array(np.array(mixes, np.uint64).view(np.int64)),
                 pa.array(bits, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "n", "key_a", "key_b", "bits", "prefix"])

    return documents.mapInArrow(
        compute, "doc_id long, n long, key_a long, key_b long, bits binary, prefix array<long>")


class Forest:
    """Union-find over a few members."""

    def __init__(self, count: int) -> None:
        self.parent = list(range(count))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b

    def roots(self) -> np.ndarray:
        found = np.array(self.parent, np.int64)
        while (found != (above := found[found])).any():
            found = above
        return found


class SignatureTree:
    """Classes in the order given, ``FAN`` to a node; a node has OR-ed bitmaps, a size range and the largest
    number of tokens that share bits. With ``sides``, only members of different sides meet."""

    def __init__(self, bitmaps: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray | None = None) -> None:
        width = min(map(len, bitmaps))
        bits = np.array([_folded(b, width) for b in bitmaps])
        spare = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, spare)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, spare = self.levels[-1]
            at = np.arange(0, len(bits), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at)))
        self.sides = None if sides is None else self._alike(sides)

    def _alike(self, marks: np.ndarray) -> list[np.ndarray]:
        """By level, the mark (from 0) that all members of a node have, or -1."""
        found = [marks]
        for level in self.levels[:-1]:
            at = np.arange(0, len(level[0]), FAN)
            low, high = np.minimum.reduceat(found[-1], at), np.maximum.reduceat(found[-1], at)
            found.append(np.where(low == high, low, -1))
        return found

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether a member of each node ``a`` may link with a member of ``b``, by maximum possible overlap."""
        bits, low, high, spare = self.levels[level]
        near = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        a, b = a[near], b[near]
        common = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64) + np.minimum(spare[a], spare[b])
        common = np.minimum(common, np.minimum(high[a], high[b]))
        # 100 i >= p (x + y - i) for the smallest sizes x, y.
        near[near] = (100 + percent) * common >= percent * (low[a] + low[b])
        return near

    def joined(self, percent: int, chunk: int = 1 << 13) -> Iterator[tuple[int, int]]:
        """A forest of pairs of members that may link."""
        count = len(self.levels[0][0])
        forest = Forest(count)
        tops = len(self.levels) - 1
        waiting = [(tops, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        root = self._alike(np.arange(count))
        while waiting:
            level, a, b = waiting.pop()
            # Nodes whose members are all in one cluster, or all on one side, have nothing to give.
            for marks in (root, self.sides) if self.sides else (root,):
                fresh = (marks[level][a] != marks[level][b]) | (marks[level][a] < 0)
                a, b = a[fresh], b[fresh]
            ok = self._possible(level, a, b, percent)
            a, b = a[ok], b[ok]
            if level == 0:
                grown = False
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    if forest.join(x, y):
                        grown = True
                        yield x, y
                if grown:
                    root = self._alike(forest.roots())
                continue
            below = len(self.levels[level - 1][0])
            steps = np.arange(FAN)
            x = (a[:, None, None] * FAN + steps[:, None]) + 0 * steps
            y = (b[:, None, None] * FAN + 0 * steps[:, None]) + steps
            keep = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
            x, y = x[keep], y[keep]
            # The last chunk is taken first; nearest pairs come first within a node.
            for k in reversed(range(0, len(x), chunk)):
                waiting.append((level - 1, x[k : k + chunk], y[k : k + chunk]))


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of one key after another, from batches sorted by the keys."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != now and rows:
                yield rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield rows


def _bands(group: list[dict], rule: Rule) -> Iterator[list[dict]]:
    """Members of each size band with those of the next, so that a tree's bitmaps are of like width."""
    sizes = np.array([r["n"] for r in group])
    band = sizes if rule.percent == 100 else np.floor(np.log(sizes) / -np.log(rule.percent / 100)).astype(np.int64)
    present = set(band.tolist())
    for low in sorted(present):
        if low + 1 in present or low - 1 not in present:
            some = np.flatnonzero((band == low) | (band == low + 1))
            if len(some) > 1:
                yield [group[n] for n in some]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _members(classes: DataFrame, rule: Rule) -> DataFrame:
    """Classes by the group (``token``, ``band``) and the two parts of it (``one``, ``two``) in which they meet.

    A token's classes are counted per task before any shuffle, and a token with more than ``WIDE`` of them is salted
    wherever its rows meet, so no task gets more than about that many rows of a token.
    """
    rows = classes.select("doc_id", "n", F.explode("prefix").alias("token"))
    lists = small(
        rows.groupBy("token").agg(
            F.count("*").alias("held"), F.bit_xor(F.xxhash64("doc_id")).alias("one"),
            F.sum(F.xxhash64("doc_id", F.lit(1)).bitwiseAND(F.lit(0xFFFFFFFF))).alias("two"))
        .where("held > 1")
        .groupBy("held", "one", "two").agg(F.min("token").alias("token"))
        .select("token", "held")
    )
    # A class without another of a near enough size in its group meets nobody there. In a salted group another may
    # be elsewhere, so all stay.
    salt = F.when(F.col("held") > WIDE, F.pmod(F.xxhash64("doc_id", F.lit(2)), F.ceil(F.col("held") / WIDE))).otherwise(0)
    by_size = Window.partitionBy("token", "salt").orderBy("n")
    near = (100 * F.col("n") >= rule.percent * F.lead("n").over(by_size)) | (
        100 * F.lag("n").over(by_size) >= rule.percent * F.col("n")) | (F.col("held") > WIDE)
    met = rows.join(lists, "token")
    picked = met.withColumn("salt", salt).withColumn("near", near).where("near").drop("near", "n", "salt")
    band = F.floor(F.log(F.col("n").cast("double")) / -np.log(rule.percent / 100)).cast("int") if rule.percent < 100 \
        else F.col("n").cast("int")
    # Sizes of a link are in one band or in neighbouring ones.
    bands = F.when(F.col("held") > WIDE, F.array(band, band + 1)).otherwise(F.array(F.lit(-1)))
    # A band of near copies can still hold any share of the table: large ones are met by pairs of parts. A band of at
    # most WIDE / 2 is not counted, which leaves parts within a constant of PART.
    crowds = (
        met.where(F.col("held") > WIDE // 2).groupBy("token", band.alias("band")).agg(F.count("*").alias("many")).where(F.col("many") > WIDE // 2)
        .withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
        .groupBy("token", "band").agg(F.sum("many").alias("many")).where(F.col("many") > WIDE)
        .groupBy("token").agg(F.map_from_entries(F.collect_list(
            F.struct("band", F.ceil(F.col("many") / PART).cast("int")))).alias("crowds"))
    )
    keys = ["token", "band", "one", "two"]
    return (
        picked.join(crowds, "token", "left")
        .join(classes.select("doc_id", "n", "bits", F.element_at("prefix", 1).alias("lead")), "doc_id")
        .withColumn("band", F.explode(bands))
        .withColumn("parts", F.coalesce(F.element_at("crowds", F.col("band")), F.lit(1)))
        .withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"one": F.least("mine", "other"), "two": F.greatest("mine", "other")})
        .repartition(*keys).sortWithinPartitions(*keys, "mine", "lead", "n", "doc_id")
        .select(*keys, "mine", "doc_id", "n", "bits")
    )


def _candidates(classes: DataFrame, rule: Rule) -> DataFrame:
    """``a``, ``b``: classes that may link, a forest of each group's."""

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[int, int]] = set()
        for group in _grouped(batches, ["token", "band", "one", "two"]):
            if len(group) < 2:
                continue
            crossed = group[0]["one"] != group[0]["two"]
            for some in _bands(group, rule):
                tree = SignatureTree([np.frombuffer(r["bits"], np.uint64) for r in some],
                                     np.array([r["n"] for r in some]),
                                     np.array([r["mine"] for r in some]) if crossed else None)
                ids = [r["doc_id"] for r in some]
                held.update((min(ids[x], ids[y]), max(ids[x], ids[y])) for x, y in tree.joined(rule.percent))
            if len(held) > 1 << 16:
                yield _edges(sorted(held))
                held.clear()
        yield _edges(sorted(held))

    return _members(classes, rule).mapInArrow(traverse, "a long, b long").distinct()


def _verified(documents: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """``a``, ``b``: links that hold, a forest of each cluster's."""
    sizes = clusters.groupBy("component").agg(F.count("*").alias("held"))
    parts = F.ceil(F.col("held") / PART).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = (
        clusters.join(sizes, "component").withColumn("parts", parts).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(F.col("node").alias("doc_id"), "component", F.least("mine", "other").alias("one"),
                F.greatest("mine", "other").alias("two"))
    )
    texts = (
        documents.join(small(dealt), "doc_id").repartition("component", "one", "two")
        .sortWithinPartitions("component", "one", "two", "doc_id")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["component", "one", "two"]):
            ids = [r["doc_id"] for r in group]
            sets = list(_sets(pa.array([r["text"] for r in group], pa.string()), rule.words))
            links = [(ids[x], ids[y]) for x, y in _linked(sets, rule.percent)]
            if links:
                yield _edges(links)

    return texts.select("component", "one", "two", "doc_id", "text").mapInArrow(check, "a long, b long")


def _linked(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A forest of the links between sets, by exact counts of common tokens."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, number = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(number, kind="stable")
    holders, bounds = owner[order], np.searchsorted(number[order], np.arange(len(tokens) + 1))
    own = np.split(number, np.cumsum(sizes)[:-1])
    forest, root = Forest(len(sets)), np.arange(len(sets))
    for x in range(len(sets)):
        if not sizes[x] or (root == root[x]).all():
            continue
        lists = [holders[bounds[t] : bounds[t + 1]] for t in own[x].tolist()]
        common = np.bincount(np.concatenate(lists), minlength=len(sets))
        ok = 100 * common >= percent * (sizes[x] + sizes - common)
        ok &= (sizes > 0) & (root != root[x])
        grown = False
        for y in np.flatnonzero(ok).tolist():
            if forest.join(x, y):
                grown = True
                yield x, y
        if grown:
            root = forest.roots()


def join(documents: DataFrame, rule: Rule, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``documents``."""
    plain = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = materialise(_signatures(plain, rule))
    named = found.where("n > 0 and doc_id is not null")
    classes = named.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("first"))
    keys = ["key_a", "key_b"]
    copies = (
        named.select("doc_id", *keys).join(classes, keys).where("doc_id <> first").select("doc_id", *keys).distinct())
    shown = named.join(small(copies), ["doc_id", *keys], "left_anti").select("doc_id", "n", "bits", "prefix")
    maybe = components(_candidates(shown, rule))
    links = _verified(plain, maybe, rule)
    # Rows that repeat a number are one document: their classes are linked by it.
    several = named.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    same = named.select("doc_id", *keys).join(several, "doc_id").join(classes, keys)
    groups = components(links.unionByName(same.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))))
    return (
        found.select("doc_id", F.col("n").alias("n_shingles"), *keys)
        .join(classes, keys, "left")
        .withColumn("first", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("first")))
        .join(groups.withColumnRenamed("node", "first"), "first", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "first", "doc_id").alias("component_id"))
    )
