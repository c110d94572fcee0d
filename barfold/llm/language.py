"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds the byte n-grams of every language: a slot is a word with one
bit per language, an n-gram sets its language's bit in ``PROBES`` slots, and the AND of an
n-gram's slots gives all languages that contain it. A text's n-grams are looked up, the bits
are counted per language, each count is corrected for the filter's false positives, and the
highest corrected share decides.

Fitting reads at most about ``docs_per_lang`` different texts of each language, chosen by a hash of the
text (a documented bound; the filter itself is bounded by its number of slots). Copies of a text
are one, in the sample and in the least number of texts that make an n-gram known. Scoring reads whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. A text with
letters of which no n-gram is known gets the most frequent learned language with score 0. Equal
shares go to the first language in code point order. Without any learned row everything
is ``und``. Repeated rows are scored alike; other columns are kept, and a column with
an output's name is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.llm.labelled import draw
from barfold.llm.texts import Slice, append, mix, slices

UNDETERMINED = "und"
SIZES = (3, 5)
PROBES = 2
BITS = 62
LETTERS = np.zeros(256, np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)


@dataclass
class Model:
    """Learned languages, the filter's slots (a row per slot, a word per 62 languages), false
    positive rates and the most frequent language."""

    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    usual: int


def _grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes and their documents: letters of one word, at most one edge at each end."""
    codes = np.concatenate((np.zeros(1, np.uint8), LETTERS[part.data]))
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        inner = np.ones(n, bool)
        for k in range(1, size - 1):
            inner &= codes[k : k + n] != 0
        at = np.flatnonzero(inner)
        total = np.full(len(at), size, np.uint64)
        for k in range(size):
            total = (total << np.uint64(8)) | codes[at + k].astype(np.uint64)
        found.append(mix(total))
        owners.append(part.document(np.maximum(at, 0)))
    return np.concatenate(found), np.concatenate(owners)


def _probes(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    width = np.uint64(slots - 1)
    return [((grams >> np.uint64(24 * k)) & width).astype(np.int64) for k in range(PROBES)]


def fit(
    documents: DataFrame,
    usable: Column,
    *,
    text: str = "text",
    lang: str = "lang",
    docs_per_lang: int = 1000,
    min_share: float = 0.01,
    slots: int = 1 << 18,
) -> Model:
    """Filters from rows that are ``usable`` and have text and language."""
    rows = documents.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull())
    by_text = rows.groupBy(F.col(lang).alias("lang"), F.xxhash64(F.col(text), F.lit(1)).alias("of")).agg(F.count("*").alias("n"))
    found = by_text.groupBy("lang").agg(F.sum("n"), F.count("*")).collect()
    counts, distinct = {r[0]: r[1] for r in found}, {r[0]: r[2] for r in found}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((slots, 1), np.int64), np.zeros(0), 0)
    # Kept by the hash of the whole text, so a share of the texts of each language is known beforehand.
    share = F.create_map(*[
        F.lit(x) for name in langs for x in (name, min(1.0, docs_per_lang / distinct[name]))
    ])
    sample = rows.where(draw(F.col(text), F.lit(1)) < F.element_at(share, F.col(lang))).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")).distinct()
    number = {name: n for n, name in enumerate(langs)}

    def count(batches):
        for batch in batches:
            owner_lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for part in slices(pc.utf8_lower(batch.column("text"))):
                grams, owner = _grams(part)
                order = np.lexsort((owner, grams))
                grams, owner = grams[order], owner[order]
                fresh = np.ones(len(grams), bool)
                fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
                grams, which = grams[fresh], owner_lang[part.first + owner[fresh]]
                for n in np.unique(which):
                    values, times = np.unique(grams[which == n], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), n)), pa.array(values.view(np.int64)),
                         pa.array(times)], names=["lang", "gram", "docs"])

    least = F.create_map(*[
        F.lit(x) for n, name in enumerate(langs)
        for x in (n, max(1.0, min_share * min(distinct[name], docs_per_lang)))
    ])
    kept = (
        sample.mapInArrow(count, "lang long, gram long, docs long")
        .groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= F.element_at(least, F.col("lang").cast("int")))
    )
    probes = F.array(*[
        F.shiftrightunsigned(F.col("gram"), 24 * k).bitwiseAND(F.lit(slots - 1)) for k in range(PROBES)
    ])
    words = (
        kept.select((F.col("lang") / BITS).cast("long").alias("word"), F.pmod("lang", F.lit(BITS)).alias("bit"),
                    F.explode(probes).alias("slot"))
        .groupBy("slot", "word").agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("mask"))
        .toArrow()
    )
    table = np.zeros((slots, (len(langs) - 1) // BITS + 1), np.int64)
    table[words["slot"].to_numpy(), words["word"].to_numpy()] = words["mask"].to_numpy()
    filled = np.array([((table[:, n // BITS] >> (n % BITS)) & 1).mean() for n in range(len(langs))])
    usual = max(range(len(langs)), key=lambda n: (counts[langs[n]], -n))
    return Model(langs, table, filled**PROBES, usual)


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def predict(
    frame: DataFrame, model: Model, *, text: str = "text", to: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``frame`` with the predicted language and its score, the corrected share of n-grams of that language."""
    sent = frame.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        learned = sent.value
        n = len(learned.langs)
        column = batch.column(text)
        lower = pc.utf8_lower(column)
        best = np.zeros(len(batch), np.int64)
        score = np.zeros(len(batch))
        plain = np.zeros(len(batch), bool)
        for part in slices(lower):
            rows = slice(part.first, part.first + part.count)
            ascii_letters = (part.data >= 97) & (part.data <= 122)
            plain[rows] = np.add.reduceat(ascii_letters, part.starts, dtype=np.int64) > 0
            if not n:
                continue
            grams, owner = _grams(part)
            total = np.maximum(np.bincount(owner, minlength=part.count), 1)
            shares = np.zeros((part.count, n))
            masks = learned.slots[(probes := _probes(grams, len(learned.slots)))[0]]
            for slot in probes[1:]:
                masks &= learned.slots[slot]
            for k in range(n):
                hits = np.bincount(owner[(masks[:, k // BITS] >> (k % BITS)) & 1 > 0], minlength=part.count)
                rate = learned.false_rate[k]
                shares[:, k] = np.clip((hits / total - rate) / max(1 - rate, 1e-9), 0, 1)
            best[rows] = np.where(shares.max(1) > 0, shares.argmax(1), learned.usual)
            score[rows] = shares.max(1)
        # Only texts without a-z need a look at their other letters.
        for row in np.flatnonzero(~plain):
            plain[row] = _has_letter(column[row].as_py())
        plain &= n > 0
        named = [learned.langs[k] if ok else UNDETERMINED for k, ok in zip(best, plain, strict=True)]
        return [pa.array(named, pa.string()), pa.array(np.where(plain, score, 0.0))]

    return append(frame, [T.StructField(to[0], T.StringType()), T.StructField(to[1], T.DoubleType())], compute, by=text)
