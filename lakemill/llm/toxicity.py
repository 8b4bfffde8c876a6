"""A toxicity classifier regularised by counterfactuals.

A text is toxic if some word of it is: p = 1 - exp(-sum of softplus(score of the word)), where a
word's score sums learned weights of its hashed features (the word and its n-grams). Training
lowers the log loss of labelled texts, and beside it the squared change of the log-odds when the
identity terms of a text are swapped for others of their kind, or for a word without weight. A
group that is often named in toxic texts thus gains no weight of its own, and a neutral mention
stays neutral. Training is numpy gradient descent on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from lakemill.llm.quality import sample_rows
from lakemill.llm.subwords import WordScores, features

#: Terms that name groups; a term is swapped for another of its line.
IDENTITY_TERMS = (
    "women men girls boys mothers fathers",
    "woman man girl boy mother father",
    "muslim christian jewish hindu buddhist atheist catholic",
    "muslims christians jews hindus buddhists atheists catholics",
    "black white asian latino arab african european",
    "gay lesbian bisexual straight transgender queer",
    "immigrants refugees natives foreigners citizens",
    "disabled deaf blind elderly young",
    "mujeres hombres musulmanes cristianos judíos negros blancos inmigrantes",
    "femmes hommes musulmans chrétiens juifs noirs blancs immigrés",
    "frauen männer muslime christen juden schwarze weiße migranten",
)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Settings:
    """`train_rows` bounds the labelled rows that the fit sees, `train_chars` their length."""

    grams: tuple[int, ...] = (3, 4, 5)
    buckets: int = 1 << 18
    epochs: int = 6
    batch: int = 64
    rate: float = 0.5
    start: float = -9.0
    shrink: float = 1e-3
    swap: float = 0.1
    train_rows: int = 4000
    train_chars: int = 100_000
    seed: int = 11


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


@dataclass(frozen=True)
class Model:
    settings: Settings
    weight: np.ndarray
    offset: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        bucket, of = features(words, self.settings.grams, self.settings.buckets)
        return self.offset + np.bincount(of, self.weight[bucket], len(words)) / np.sqrt(np.maximum(np.bincount(of, minlength=len(words)), 1))

    def scorer(self):
        memory = WordScores(lambda words: _softplus(self.word_scores(words)))

        def score(texts: list[str]) -> np.ndarray:
            # A word counts once in a text, as in training.
            lists = [list(dict.fromkeys(words_of(t))) for t in texts]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            parts = memory.of([w for words in lists for w in words])
            return np.abs(np.expm1(-np.bincount(np.repeat(np.arange(len(lists)), sizes), parts, len(lists))))

        return score


def swaps(words: list[str], rng: np.random.Generator) -> list[tuple[str, str | None]]:
    """(term, its replacement) for the identity terms among `words`; None stands for no term."""
    kinds = {t: line.split() for line in IDENTITY_TERMS for t in line.split()}
    out: list[tuple[str, str | None]] = []
    for w in words:
        if w in kinds:
            others = [t for t in kinds[w] if t != w] + [None]
            out.append((w, others[rng.integers(len(others))]))
    return out


def train(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """Fits the weights. Without rows of both labels every word is neutral."""
    y = np.asarray(labels, np.int64)
    weight = np.zeros(settings.buckets)
    if len(y) == 0 or y.min() == y.max():
        return Model(settings, weight, settings.start)
    rng = np.random.default_rng(settings.seed)
    vocabulary: dict[str, int] = {}
    docs, exchanged = [], []
    for t in texts:
        words = list(dict.fromkeys(words_of(t)))
        pairs = swaps(words, rng)
        number = lambda w: vocabulary.setdefault(w, len(vocabulary))
        docs.append(np.fromiter(map(number, words), np.int64, len(words)))
        exchanged.append([(number(a), number(b) if b else -1) for a, b in pairs])
    for line in IDENTITY_TERMS:  # their weights stay near none even if no text names them
        for term in line.split():
            vocabulary.setdefault(term, len(vocabulary))
    bucket, of = features(list(vocabulary), settings.grams, settings.buckets)
    first = np.searchsorted(of, np.arange(len(vocabulary) + 1))
    scale = 1 / np.sqrt(np.maximum(np.diff(first), 1))
    squared = np.full(settings.buckets, 1e-3)
    offset = settings.start

    def gathered(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the features of `words`, and the word of each."""
        sizes = first[words + 1] - first[words]
        owner = np.repeat(np.arange(len(words)), sizes)
        return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first[words], sizes), owner

    for _ in range(settings.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), settings.batch):
            chosen = order[at : at + settings.batch]
            extra = [(d, a, b) for d, i in enumerate(chosen) for a, b in exchanged[i]]
            distinct, place = np.unique(
                np.concatenate([*[docs[i] for i in chosen], [b for *_, b in extra if b >= 0]]).astype(np.int64), return_inverse=True
            )
            sizes = [len(docs[i]) for i in chosen]
            doc_of = np.repeat(np.arange(len(chosen)), sizes)
            member = place[: len(doc_of)]
            places, owner = gathered(distinct)
            ids = bucket[places]
            s = offset + np.bincount(owner, weight[ids], len(distinct)) * scale[distinct]
            a = _softplus(s)
            slope = 1 / (1 + np.exp(-s))
            total = np.bincount(doc_of, a[member], len(chosen))
            # d loss / d total: 1 for label 0, -1/(e^total - 1) for label 1
            up = np.where(y[chosen] == 0, 1.0, -1 / np.expm1(np.clip(total, 1e-6, 50)))
            up = np.clip(up, -1e3, 1.0)
            back = np.bincount(member, up[doc_of], len(distinct))
            if extra:
                # Log-odds of p = 1 - e^-T are log(e^T - 1); d/dT = 1 / (1 - e^-T).
                spot = {w: k for k, w in enumerate(distinct.tolist())}
                change = np.zeros(len(chosen))
                for d, w, v in extra:
                    change[d] += (a[spot[v]] if v >= 0 else 0) - a[spot[w]]
                other = np.maximum(total + change, 1e-6)
                t = np.maximum(total, 1e-6)
                odds = np.log(np.expm1(np.minimum(other, 50))) - np.log(np.expm1(np.minimum(t, 50)))
                g0, g1 = 2 * settings.swap * odds / -np.expm1(-t), 2 * settings.swap * odds / -np.expm1(-other)
                back -= np.bincount(member, (g0 - g1)[doc_of], len(distinct))
                for d, w, v in extra:
                    back[spot[w]] -= g1[d]
                    if v >= 0:
                        back[spot[v]] += g1[d]
            g = np.clip(back * slope, -5, 5) * scale[distinct]
            gradient = np.bincount(ids, g[owner], settings.buckets)
            touched = np.unique(ids)
            step = gradient[touched] + settings.shrink * weight[touched]
            squared[touched] += step * step
            weight[touched] -= settings.rate * step / np.sqrt(squared[touched])
    return Model(settings, weight, offset)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", settings: Settings = Settings()) -> Model:
    """Trains on a sample of at most `settings.train_rows` rows of `labelled`."""
    rows = sample_rows(labelled, text, label, settings.train_rows, settings.train_chars)
    return train([r.text for r in rows], [r.label for r in rows], settings)
