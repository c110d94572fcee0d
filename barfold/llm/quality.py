"""Quality by logistic regression on hashed word n-grams, trained by FTRL-proximal updates.

A word is a run of letters and digits or a run of other visible bytes, so marks glued to words are
words of their own; a word that repeats one of the two before counts as the mark of a repeat. Its n-grams (``1`` and ``2``) are hashed into ``DIMENSIONS`` places; a document is
the vector of their shares, and its score the logistic of one sparse dot product. Fitting runs
over a bounded sample, ``per_class`` labelled rows of each class, in one task of that bounded size;
scoring reads whole texts.

Defined cases: null and empty texts are the zero vector and score by the bias alone; rows without a
usable label are not learned from; without labelled rows of both classes every score is 0.5. Other
columns are kept, and a column with an output's name is replaced; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barfold.llm.texts import Slice, append, byte_classes, hashes, lowered, runs, shingled, slices

DIMENSIONS = 1 << 18
SIZES = (1, 2)
GAIN = 20.0
_REPEAT = np.uint64(0x2545F4914F6CDD1D)
_LETTERS = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]
CLASSES = byte_classes(word=_LETTERS, mark=[b for b in range(33, 127) if b not in _LETTERS])


def _places(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Place of each n-gram and its document."""
    starts, ends = runs(part.data, CLASSES)
    words, owner = hashes(lowered(part.data), starts, ends), part.document(starts)
    words = _repeats_marked(words)
    found = [shingled(words, owner, size) for size in SIZES]
    place = np.concatenate([f[0] for f in found]) & np.uint64(DIMENSIONS - 1)
    return place.astype(np.int64), np.concatenate([f[1] for f in found])


def _repeats_marked(words: np.ndarray) -> np.ndarray:
    """Words with every one that stood one or two places before replaced by one mark."""
    again = np.zeros(len(words), bool)
    for back in (1, 2):
        again[back:] |= words[back:] == words[: len(words) - back]
    return np.where(again, _REPEAT, words)


class Model:
    """Weights by place and a bias; ``None`` weights if there was nothing to learn from."""

    def __init__(self, weights: np.ndarray | None, bias: float) -> None:
        self.weights, self.bias = weights, bias


def _ftrl(rows, labels, *, epochs, alpha, beta, l1, l2, seed) -> tuple[np.ndarray, float]:
    """Per-coordinate FTRL-proximal; the last place of the state is the bias."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at):
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(seed)
    importance = np.where(labels == 1, len(labels) / (2 * labels.sum()), len(labels) / (2 * (1 - labels).sum()))
    for _ in range(epochs):
        for row in order.permutation(len(rows)):
            at, value = rows[row]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = importance[row] * (p - labels[row]) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    final = weights(np.arange(DIMENSIONS + 1))
    return final[:-1].astype(np.float32), float(final[-1])


def fit(
    labelled: DataFrame,
    *,
    epochs: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.1,
    seed: int = 1,
) -> Model:
    """A model from rows ``text``, ``label`` (a bounded sample, see ``barfold.llm.labelled``)."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for part in slices(batch.column("text")):
                place, owner = _places(part)
                pairs, times = np.unique((owner << 18) | place, return_counts=True)
                by_doc = np.searchsorted(pairs >> 18, np.arange(part.count + 1))
                rows = [((pairs[a:b] & (DIMENSIONS - 1)).astype(np.int32).tobytes(),
                         (GAIN * times[a:b] / max(1, times[a:b].sum())).astype(np.float32).tobytes())
                        for a, b in zip(by_doc[:-1], by_doc[1:], strict=True)]
                places, values = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.binary()), pa.array(values, pa.binary()),
                     pa.array(labels[part.first : part.first + part.count])],
                    names=["places", "values", "label"])

    def group(frame):
        import pandas as pd

        # One group: its rows are the bounded sample.
        frame = frame.sort_values(["label", "places"], kind="stable")
        labels = frame["label"].to_numpy().astype(float)
        if not {0.0, 1.0} <= set(labels.tolist()):
            return pd.DataFrame([], columns=["weights", "bias"])
        rows = [(np.append(np.frombuffer(p, np.int32), DIMENSIONS), np.append(np.frombuffer(v, np.float32), 1.0))
                for p, v in zip(frame["places"], frame["values"], strict=True)]
        found, bias = _ftrl(rows, labels, epochs=epochs, alpha=alpha, beta=beta, l1=l1, l2=l2, seed=seed)
        return pd.DataFrame([(found.tobytes(), bias)], columns=["weights", "bias"])

    hashed = labelled.mapInArrow(vectors, "places binary, values binary, label int")
    fitted = hashed.groupBy().applyInPandas(group, "weights binary, bias double").collect()
    if not fitted:
        return Model(None, 0.0)
    return Model(np.frombuffer(fitted[0]["weights"], np.float32), fitted[0]["bias"])


def score(frame: DataFrame, model: Model, *, text: str = "text", to: str = "score") -> DataFrame:
    """``frame`` with the probability of label 1 in ``to``."""
    sent = frame.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        learned, scores = sent.value, np.full(len(batch), 0.5)
        if learned.weights is not None:
            for part in slices(batch.column(text)):
                place, owner = _places(part)
                total = np.maximum(np.bincount(owner, minlength=part.count), 1)
                dot = np.bincount(owner, weights=learned.weights[place], minlength=part.count) / total
                z = np.clip(learned.bias + GAIN * dot, -30, 30)
                scores[part.first : part.first + part.count] = 1 / (1 + np.exp(-z))
        return [pa.array(scores)]

    return append(frame, [T.StructField(to, T.DoubleType())], compute)
