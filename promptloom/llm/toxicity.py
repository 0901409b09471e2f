"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, learned from document labels."""

from __future__ import annotations

import pickle
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from promptloom.llm.common import slices, whole
from promptloom.llm.labelled import Features, fit, held_out

MOST_ROWS = 6000
THRESHOLD = 0.3
_ENDS = (". ", "! ", "? ")
_EDGE = "\"'`.,;:!?()[]{}<>|/\\*#%&$-_=+~"


def sentences(text: str) -> list[str]:
    """Sentences end at a line's end, or at a full stop, exclamation or question mark before a space.
    Joined by one character they are the text again, which gives their places."""
    for end in _ENDS:
        text = text.replace(end, end[0] + "\n")
    return text.split("\n")


def parts(word: str) -> set[str]:
    """A word and its letter 4- and 5-grams, with marks at both ends."""
    marked = f"^{word.strip(_EDGE).lower()}$"
    grams = {marked[i : i + 4] for i in range(len(marked) - 3)}
    grams.update(marked[i : i + 5] for i in range(len(marked) - 4))
    grams.add(marked)
    return grams


def _flat(texts: list[str], values: dict, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What `values` has for each word, words of each sentence, sentences of each text."""
    words: list[int] = []
    word_counts: list[int] = []
    sentence_counts: list[int] = []
    for text in texts:
        split = [sentence.split() for sentence in sentences(text)]
        sentence_counts.append(len(split))
        word_counts += map(len, split)
        words += map(values.__getitem__, chain.from_iterable(split))
    return np.array(words, dtype=kind), np.array(word_counts, dtype=np.int64), np.array(sentence_counts, dtype=np.int64)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def _hazards(z: np.ndarray, bias: float) -> np.ndarray:
    """-log(1 - p) of sentences, by what their weights add to the bias: 0 for a sentence without weights."""
    return np.maximum(_softplus(z) - _softplus(bias), 0.0)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(counts)), counts), weights=values, minlength=len(counts))


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def train(
    texts: list[str], labels: np.ndarray, epochs: int = 600, rate: float = 0.2, least: float = 0.5, shrink: float = 2e-4
) -> bytes:
    """Weights of words and parts of words, from labels of whole texts.

    A sentence is toxic with probability p = 1 - (1 - sigmoid(z)) / (1 - sigmoid(bias)), z the bias
    and the sum of its words' weights, and with p = 0 if these do not exceed 0. A text is if one of its
    sentences is, and by the bias, once however long it is: 1 - (1 - sigmoid(bias)) prod(1 - p). A
    word's weight is the sum of its parts' weights. Parts get a weight if they occur in toxic texts
    three times or more, and twice as often as in others. The log-likelihood of the labels, less a
    penalty on the size of the weights, is climbed on all texts at once; the slope of a sentence whose
    weights do not exceed 0 is that without this bound.
    """
    numbers = _Numbers()
    word, word_counts, sentence_counts = _flat(texts, numbers, np.int64)
    n, toxic = len(texts), labels > 0.5
    if not toxic.any():
        return pickle.dumps(({}, -6.0))
    sentence_of = np.repeat(np.arange(len(word_counts)), word_counts)
    text_of_sentence = np.repeat(np.arange(n), sentence_counts)
    found = [sorted(parts(one)) for one in numbers]
    part_word = np.repeat(np.arange(len(found)), np.array(list(map(len, found)), dtype=np.int64))
    grams = _Numbers()
    part = np.array(list(map(grams.__getitem__, chain.from_iterable(found))), dtype=np.int64)
    keys = np.array(list(grams), dtype=object)
    both = np.unique(word * n + text_of_sentence[sentence_of])
    in_toxic = np.bincount(both // n, weights=toxic[both % n], minlength=len(found))
    in_all = np.bincount(both // n, minlength=len(found))
    part_toxic = np.bincount(part, weights=in_toxic[part_word], minlength=len(keys))
    part_all = np.bincount(part, weights=in_all[part_word], minlength=len(keys))
    share = toxic.mean()
    telling = (part_toxic >= 3) & (part_toxic * (1 - share) >= 2 * share * (part_all - part_toxic))

    place = np.cumsum(telling) - 1
    used = telling[part]
    part, part_word, keys = place[part[used]], part_word[used], keys[telling]
    told = np.zeros(len(found), dtype=bool)
    told[part_word] = True
    used = told[word]
    word, sentence_of = word[used], sentence_of[used]
    active, sentence_of = np.unique(sentence_of, return_inverse=True)
    text_of = text_of_sentence[active]

    weights, bias = np.zeros(len(keys)), -6.0
    for _ in range(epochs):
        word_weight = np.bincount(part_word, weights=weights[part], minlength=len(found))
        z = bias + np.bincount(sentence_of, weights=word_weight[word], minlength=len(active))
        total = np.bincount(text_of, weights=_hazards(z, bias), minlength=n) + _softplus(bias)
        slope = np.where(toxic, -1.0 / np.expm1(np.clip(total, 1e-6, 50.0)), 1.0)
        by_sentence = slope[text_of] * _sigmoid(z)
        by_word = np.bincount(word, weights=by_sentence[sentence_of], minlength=len(found))
        by_part = np.bincount(part, weights=by_word[part_word], minlength=len(keys))
        # Only what a part explains beyond `least` texts moves it: those seen by chance in a few
        # toxic texts stay at 0. The one that explains most moves by `rate`, others in proportion.
        beyond = np.sign(by_part) * np.maximum(np.abs(by_part) - least, 0.0)
        weights -= rate * beyond / max(1.0, float(np.abs(beyond).max(initial=0.0))) + shrink * weights
        by_bias = by_sentence.sum() + slope.sum() * _sigmoid(bias)
        bias -= rate * np.tanh(by_bias / toxic.sum())
    keep = np.abs(weights) > 1e-3
    return pickle.dumps((dict(zip(keys[keep].tolist(), weights[keep].tolist(), strict=True)), float(bias)))


class Model:
    def __init__(self, data: bytes) -> None:
        self.weights, self.bias = pickle.loads(data)
        self.features = Features(self._weight)

    def _weight(self, word: str) -> float:
        known = self.weights.keys() & parts(word)
        return sum(self.weights[gram] for gram in sorted(known)) if known else 0.0

    def score(self, texts: list[str], locate: float) -> tuple[np.ndarray, list[list[dict]]]:
        """Score of each text, and of its sentences those that alone reach `locate`, with their places."""
        self.features.forget()
        weights, word_counts, sentence_counts = _flat(texts, self.features, np.float64)
        z = self.bias + _sums(weights, word_counts)
        hazards = _hazards(z, self.bias)
        scores = -np.expm1(-_sums(hazards, sentence_counts) - _softplus(self.bias))
        offending: list[list[dict]] = [[] for _ in texts]
        own = -np.expm1(-hazards)
        firsts = np.cumsum(sentence_counts) - sentence_counts
        hot = np.flatnonzero(own >= locate)
        of = np.searchsorted(firsts, hot, side="right") - 1
        for i in np.unique(of).tolist():
            lengths = np.array([len(s) for s in sentences(texts[i])])
            starts = np.cumsum(lengths + 1) - lengths - 1
            for k in hot[of == i].tolist():
                j = k - int(firsts[i])
                offending[i].append(
                    {"start": int(starts[j]), "stop": int(starts[j] + lengths[j]), "score": float(own[k])}
                )
        return np.clip(scores, 0.0, 1.0), offending


_models: dict[int, Model] = {}


def _loaded(data: bytes) -> Model:
    key = hash(data)
    if key not in _models:
        _models.clear()
        _models[key] = Model(data)
    return _models[key]


def toxicity(text: Column, model: bytes, locate: float = THRESHOLD) -> Column:
    """Score of each text and its offending sentences (start and stop in characters, score)."""

    @pandas_udf("score double, sentences array<struct<start: int, stop: int, score: double>>")
    def scored(text: pd.Series) -> pd.DataFrame:
        found = _loaded(model)
        texts, scores, located = whole(text), [np.empty(0)], []
        for a, b in slices(texts):
            score, offending = found.score(texts[a:b], locate)
            scores.append(score)
            located += offending
        return pd.DataFrame({"score": np.concatenate(scores), "sentences": located})

    return scored(text)


def toxicity_model(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> bytes:
    """A model fitted on at most `most_rows` labelled documents outside the held-out fold."""
    return fit(docs, labels, F.col("toxic"), train, most_rows)


def score_documents(docs: DataFrame, model: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score of every row, whole texts, no shuffle: doc_id, held_out, score, predicted, sentences.

    Null and empty texts are scored as one empty sentence; a null id counts as held out; repeated
    rows are scored alike; with no labelled row a model of the bias alone scores all texts low,
    however long.
    """
    result = docs.select(F.col(id_column).alias("doc_id"), toxicity(F.col(text_column), model).alias("r"))
    return result.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "r.score",
        F.when(F.col("r.score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        "r.sentences",
    )
