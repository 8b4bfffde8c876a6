"""A quality classifier on learned vectors of words and character n-grams.

A document is the mean of its words' vectors, a word the mean of the vectors of its hashed
features: the word, its n-grams, and a mark if it repeats the word before it. A softmax over two
outputs gives the probability of label 1. Vectors and outputs are trained by stochastic gradient
descent in numpy, on a bounded sample of labelled rows; scoring runs where the rows are.

Once trained, a word's part in the document's score depends on the word alone, because mean and
output are linear; tasks keep that number for words seen before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import add_columns, drawn, text_of
from lakemill.llm.subwords import WordScores, features
from lakemill.session import settle

#: Added to the words of a text for each word that equals the one before it.
REPEAT = "\x01repeat"


def words_of(text: str) -> list[str]:
    words = text.split()
    return words + [REPEAT] * sum(map(str.__eq__, words[1:], words))


@dataclass(frozen=True)
class Settings:
    """`train_rows` bounds the labelled rows that the fit sees, `train_chars` their length."""

    grams: tuple[int, ...] = (3, 4)
    buckets: int = 1 << 16
    size: int = 8
    epochs: int = 4
    batch: int = 32
    rate: float = 0.5
    train_rows: int = 2500
    train_chars: int = 100_000
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """`weight` is the difference of the two outputs for a feature's vector, `bias` of their biases."""

    settings: Settings
    weight: np.ndarray
    bias: float

    def scorer(self):
        def word_scores(words: list[str]) -> np.ndarray:
            bucket, of = features(words, self.settings.grams, self.settings.buckets)
            return np.bincount(of, self.weight[bucket], len(words)) / np.maximum(np.bincount(of, minlength=len(words)), 1)

        memory = WordScores(word_scores)

        def score(texts: list[str]) -> np.ndarray:
            lists = [words_of(t) for t in texts]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            parts = memory.of([w for words in lists for w in words])
            sums = np.bincount(np.repeat(np.arange(len(lists)), sizes), parts, len(lists))
            return 1 / (1 + np.exp(-np.clip(self.bias + sums / np.maximum(sizes, 1), -500, 500)))

        return score


def sample_rows(labelled: DataFrame, text: str, label: str, rows: int, chars: int) -> list:
    """At most `rows` (text, label) rows of at most `chars` characters, drawn by a hash of the row.

    Other columns, such as an id, take part in the hash. Rows without a label are left out.
    """
    others = [F.col(f"`{c}`").alias(f"other_{k}") for k, c in enumerate(labelled.columns) if c not in (text, label)]
    eligible = labelled.select(text_of(text).alias("text"), F.col(f"`{label}`").cast("int").alias("label"), *others)
    eligible = eligible.where(F.col("label").isin(0, 1) & (F.length("text") <= chars))
    return drawn(eligible, rows).select("text", "label").collect()


def train(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """Fits the vectors and the softmax. Without rows of both labels the score is their share."""
    y = np.asarray(labels, np.int64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias0 = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Model(settings, np.zeros(settings.buckets), bias0)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.size)) / settings.size
    outputs = np.zeros((settings.size, 2))
    bias = np.array([0.0, bias0])
    bags = []
    for t in texts:
        words: dict[str, int] = {}
        for w in words_of(t):
            words[w] = words.get(w, 0) + 1
        bucket, of = features(list(words), settings.grams, settings.buckets)
        counts = np.fromiter(words.values(), np.float64, len(words))
        weight = (counts / np.maximum(np.bincount(of, minlength=len(words)), 1))[of] / max(counts.sum(), 1)
        # One weight for each distinct feature of the document.
        ids, place = np.unique(bucket, return_inverse=True)
        bags.append((ids.astype(np.int32), np.bincount(place, weight, len(ids)).astype(np.float32)))
    steps, step = settings.epochs * len(y), 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), settings.batch):
            chosen = order[at : at + settings.batch]
            ids = np.concatenate([bags[i][0] for i in chosen])
            weight = np.concatenate([bags[i][1] for i in chosen]).astype(np.float64)
            of = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
            taken = vectors[ids]
            means = np.stack([np.bincount(of, weight * taken[:, k], len(chosen)) for k in range(settings.size)], axis=1)
            z = means @ outputs + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            rate = settings.rate * (1 - step / steps)
            back = p @ outputs.T
            outputs -= rate * means.T @ p
            bias -= 0.1 * rate * p.mean(axis=0)
            moved = rate * 20 * weight[:, None] * back[of]  # a mean's part of each vector is small
            for k in range(settings.size):
                vectors[:, k] -= np.bincount(ids, moved[:, k], settings.buckets)
            step += len(chosen)
    return Model(settings, vectors @ (outputs[:, 1] - outputs[:, 0]), float(bias[1] - bias[0]))


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Model:
    """Trains on a sample of at most `settings.train_rows` rows of `labelled`."""
    rows = sample_rows(labelled, text, label, settings.train_rows, settings.train_chars)
    return train([r.text for r in rows], [r.label for r in rows], settings)


def score(docs: DataFrame, model, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of `docs` and the probability of label 1, for every row.

    Null and empty texts get the score of no words. Whole texts are read, however long. Repeated
    rows get equal scores. A column named as `out` is replaced.
    """

    def make():
        scorer = model.scorer()
        return lambda texts: [pa.array(scorer(texts), pa.float64())]

    return add_columns(docs, text, [T.StructField(out, T.DoubleType())], make)


def with_labels(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, id_col: str = "doc_id", text: str = "text", settings=Settings()
) -> DataFrame:
    """(__id, text, label) of documents whose label row satisfies `usable`, for a fit with `settings`.

    At most `settings.train_rows` ids are drawn, by a hash, from all that have a document and a
    label of 0 or 1; only ids are shuffled for that, and the texts are met by these few rows. Texts
    over `settings.train_chars` are left out. Ids that are null have no label; an id with several
    labels takes the larger one; rows that repeat an id are all given.
    """
    marks = labels.where(usable & F.col(f"`{label}`").isin(0, 1)).groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.max(f"`{label}`").alias(label))
    texts = docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(text).alias("text"))
    picked = settle(drawn(marks.join(texts.select("__id"), "__id", "left_semi"), settings.train_rows), "labelled-ids")
    met = texts.join(F.broadcast(picked), "__id").where(F.length("text") <= settings.train_chars)  # at most `train_rows` rows
    return settle(met.select("__id", "text", label), "labelled-texts")
