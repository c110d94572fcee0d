"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

A sentence is a bag of hashed words with a logistic score p; a document is toxic unless all its
sentences are clean, so its score is 1 - prod(1 - p). Only documents have labels: the gradient
reaches the sentences through the noisy-or. ``sentences`` gives the sentences behind a score.

Features are the words and, for longer ones, their first ``STEM`` bytes. Sentences end at ``.``, ``!``, ``?`` or a line feed; words are runs of letters and digits, A-Z in
lower case. Fitting takes a bounded sample, ``per_class`` labelled rows of each class, turned into word
hashes where the rows are and fitted in one task of that bounded size. Scoring reads whole texts.

Defined cases: null and empty texts have no sentence and get ``EMPTY_SCORE``; rows without a usable
label are not learned from; without labelled rows of both classes all scores are ``EMPTY_SCORE``.
Other columns are kept, and a column with an output's name is replaced; repeated rows
are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barfold.llm.texts import Slice, append, byte_classes, hashes, lowered, runs, slices

EMPTY_SCORE = 0.0
DIMENSIONS = 1 << 18
STEM = 6
_STEMMED = np.uint64(0xD6E8FEB86659FD93)
WORD = byte_classes(word=[*range(48, 58), *range(97, 123), *range(128, 256)])
END = np.zeros(256, bool)
END[list(b".!?\n")] = True


def _bags(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each sentence: word number, sentence number; each sentence's document.

    A sentence is named by the number of sentence ends before it, so a document's are in order.
    """
    data = lowered(part.data)
    starts, ends = runs(data, WORD)
    before = np.concatenate(([0], np.cumsum(END[data])))
    at, index = _features(data, starts, ends)
    pairs = np.unique((before[at].astype(np.int64) << 18) | index)
    sentence, word = pairs >> 18, pairs & (DIMENSIONS - 1)
    names, number = np.unique(sentence, return_inverse=True)
    # The document of a sentence is that of the place after the end that opened it.
    opened = np.concatenate(([0], np.flatnonzero(END[data]) + 1))
    return word, number, part.document(opened[names]) if len(names) else names


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the text and hashed feature: each word, and the stem of each longer one."""
    long = ends - starts > STEM
    stems = hashes(data, starts[long], starts[long] + STEM) * _STEMMED
    found = np.concatenate((hashes(data, starts, ends), stems)) >> np.uint64(64 - 18)
    return np.concatenate((starts, starts[long])), found.astype(np.int64)


class Model:
    """Weights of hashed words and a bias; ``None`` weights if there was nothing to learn from."""

    def __init__(self, weights: np.ndarray | None, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def sentence_scores(self, word: np.ndarray, number: np.ndarray, count: int) -> np.ndarray:
        return self.bias + np.bincount(number, weights=self.weights[word], minlength=count)


def _clean_log(z: np.ndarray) -> np.ndarray:
    """-log(1 - p) of a sentence."""
    return np.logaddexp(0, z)


def _counts(words: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents, and toxic documents, that hold each feature."""
    held, toxic = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for own, is_toxic in zip(words, label.tolist(), strict=True):
        seen = np.unique(own)
        held[seen] += 1
        toxic[seen] += is_toxic
    return held, toxic


def _learn(word, sentence, document, label, held, toxic, *, epochs, rate, decay, floor, prior) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the noisy-or's log loss.

    ``floor`` keeps the step of a rare feature small, ``decay`` draws it to its starting value: log odds
    of documents, shrunk to the share of toxic ones, so that features many documents agree
    on explain them before rare ones do.
    """
    n_docs, n_sentences = len(label), len(document)
    usual = label.mean()
    odds = (toxic + prior * usual) / (held + prior)
    state = np.zeros(DIMENSIONS + 1)
    state[:-1] = np.log(odds / (1 - odds)) - np.log(usual / (1 - usual))
    start = state.copy()
    # Sentences start clean enough for a document of average length to be so.
    state[-1] = np.log(0.1 / max(1.0, n_sentences / max(1, n_docs)))
    first, second = np.zeros_like(state), np.zeros_like(state)
    balance = np.where(label == 1, n_docs / max(1, 2 * label.sum()), n_docs / max(1, 2 * (n_docs - label.sum())))
    for step in range(1, epochs + 1):
        gradient = _gradient(state, word, sentence, document, label, balance)
        gradient[:-1] += decay * (state - start)[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        state -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + floor)
    return state[:-1].astype(np.float32), float(state[-1])


def _gradient(state, word, sentence, document, label, balance) -> np.ndarray:
    """Slope of the mean weighted log loss of the documents, through the noisy-or to weights and bias."""
    z = state[-1] + np.bincount(sentence, weights=state[word], minlength=len(document))
    clean = np.bincount(document, weights=_clean_log(z), minlength=len(label))
    toxic = -np.expm1(-np.maximum(clean, 1e-9))
    slope = balance * np.where(label == 1, 1 - 1 / toxic, 1.0)
    of_sentence = slope[document] / (1 + np.exp(-z))
    gradient = np.zeros_like(state)
    gradient[:-1] = np.bincount(word, weights=of_sentence[sentence], minlength=len(state) - 1)
    gradient[-1] = of_sentence.sum()
    return gradient / len(label)


def fit(
    labelled: DataFrame,
    *,
    epochs: int = 80,
    rate: float = 0.2,
    decay: float = 1e-4,
    min_docs: int = 3,
    floor: float = 3e-3,
    prior: float = 10.0,
) -> Model:
    """A model from rows ``text``, ``label`` (a bounded sample, see ``barfold.llm.labelled``)."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for part in slices(batch.column("text")):
                word, number, document = _bags(part)
                by_doc = np.searchsorted(document[number] if len(number) else number, np.arange(part.count + 1))
                rows = []
                for k in range(part.count):
                    span = slice(by_doc[k], by_doc[k + 1])
                    mine = number[span]
                    rows.append((word[span].astype(np.int32).tobytes(),
                                 (mine - mine[0] if len(mine) else mine).astype(np.int32).tobytes()))
                words, sentences = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(sentences, pa.binary()),
                     pa.array(labels[part.first : part.first + part.count])],
                    names=["words", "sentences", "label"])

    def train(frames):
        # One group: its rows are the bounded sample.
        rows = frames.sort_values(["label", "words"], kind="stable")
        label = rows["label"].to_numpy()
        if not {0, 1} <= set(label.tolist()):
            return None
        words = [np.frombuffer(w, np.int32) for w in rows["words"]]
        held, toxic = _counts(words, label)
        # Rare features are left out before anything is put together.
        held[held < min_docs] = toxic[held < min_docs] = 0
        word, sentence, document, at = [], [], [], 0
        for n, (own, sentences) in enumerate(zip(words, rows["sentences"], strict=True)):
            mine, known = np.frombuffer(sentences, np.int32), held[own] > 0
            count = int(mine[-1]) + 1 if len(mine) else 0
            word.append(own[known])
            sentence.append(mine[known] + np.int32(at))
            document.append(np.full(count, n, np.int32))
            at += count
        return _learn(np.concatenate(word), np.concatenate(sentence), np.concatenate(document), label, held, toxic,
                      epochs=epochs, rate=rate, decay=decay, floor=floor, prior=prior)

    def group(frames):
        import pandas as pd

        found = train(frames)
        rows = [] if found is None else [(found[0].tobytes(), found[1])]
        return pd.DataFrame(rows, columns=["weights", "bias"])

    bagged = labelled.mapInArrow(bags, "words binary, sentences binary, label int")
    fitted = bagged.groupBy().applyInPandas(group, "weights binary, bias double").collect()
    if not fitted:
        return Model(None, 0.0)
    return Model(np.frombuffer(fitted[0]["weights"], np.float32), fitted[0]["bias"])


def score(frame: DataFrame, model: Model, *, text: str = "text", to: str = "score") -> DataFrame:
    """``frame`` with the document's score in ``to``."""
    sent = frame.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        learned, scores = sent.value, np.full(len(batch), EMPTY_SCORE)
        if learned.weights is not None:
            for part in slices(batch.column(text)):
                word, number, document = _bags(part)
                clean = _clean_log(learned.sentence_scores(word, number, len(document)))
                total = np.bincount(document, weights=clean, minlength=part.count)
                found = np.where(np.bincount(document, minlength=part.count) > 0, -np.expm1(-total), EMPTY_SCORE)
                scores[part.first : part.first + part.count] = found
        return [pa.array(scores)]

    return append(frame, [T.StructField(to, T.DoubleType())], compute)


def sentences(
    frame: DataFrame, model: Model, *, text: str = "text", least: float = 0.5, where: str | None = None
) -> DataFrame:
    """``frame`` with ``sentences``: start, end (bytes of the UTF-8 text) and score of each sentence
    that scores ``least`` or more, in the order of the text.

    With ``where``, a column of booleans, rows in which it is not true have none; in the others the text's
    worst sentence is always among them, as many small scores together can make a document toxic.
    """
    sent = frame.sparkSession.sparkContext.broadcast(model)
    kind = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType())]))
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        learned, found = sent.value, [[] for _ in range(len(batch))]
        if learned.weights is not None:
            for part in slices(batch.column(text)):
                data = lowered(part.data)
                starts, ends = runs(data, WORD)
                closing = np.flatnonzero(END[data])
                at, index = _features(data, starts, ends)
                pairs = np.unique((np.searchsorted(closing, at) << 18) | index)
                names, number = np.unique(pairs >> 18, return_inverse=True)
                p = 1 / (1 + np.exp(-learned.sentence_scores(pairs & (DIMENSIONS - 1), number, len(names))))
                document = part.document(closing[names]) if len(names) else names
                shown = p >= least
                if where:
                    asked = np.array([bool(v) for v in batch.column(where).to_pylist()])
                    worst = np.zeros(part.count)
                    np.maximum.at(worst, document, p)
                    shown = asked[part.first + document] & (shown | (p == worst[document]))
                for k in np.flatnonzero(shown).tolist():
                    name, doc = int(names[k]), int(document[k])
                    start, base = int(closing[name - 1]) + 1 if name else 0, int(part.starts[doc])
                    found[part.first + doc].append(
                        {"start": max(start, base) - base, "end": int(closing[name]) - base, "score": float(p[k])})
        return [pa.array(found, arrow)]

    return append(frame, [T.StructField("sentences", kind)], compute)
