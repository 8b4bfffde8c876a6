"""Hashed word and character n-gram features of words, computed for many words at once."""

from __future__ import annotations

import numpy as np

#: Numbers of the mixing function of a published 64-bit hash finaliser; fixed values.
_MULTIPLY = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


def features(words: list[str], grams: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of the word) of every feature: the word, and its n-grams of UTF-8 bytes.

    A word is set between marks for its start and its end, so that prefixes and suffixes differ
    from what stands inside. The features of a word come in one run, words in their order.
    """
    data = b"".join(b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03" for w in words)
    lengths = np.fromiter((len(w.encode("utf-8", "surrogatepass")) + 2 for w in words), np.int64, len(words))
    raw = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(raw))
    found, owners = [], []
    powers = np.array([pow(_BASE, k, 1 << 64) for k in range(int(lengths.max(initial=0)))], np.uint64)
    if len(words):  # the whole word: a polynomial of its bytes
        terms = raw * powers[np.arange(len(raw)) - np.repeat(starts, lengths)]
        whole = np.add.reduceat(terms, starts)
        found.append(_mix(whole ^ np.uint64(0xFF)))
        owners.append(np.arange(len(words)))
    for n in grams:
        h = np.zeros(max(0, len(raw) - n + 1), np.uint64)
        for k in range(n):
            h = h * np.uint64(_BASE) + raw[k : k + len(h)]
        inside = left[: len(h)] >= n
        found.append(_mix(h[inside] + np.uint64(n)))
        owners.append(owner[: len(h)][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, of = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    return (hashes[order] % np.uint64(buckets)).astype(np.int64), of[order]


class WordScores:
    """Scores of words by a linear form over their features, kept for words seen before."""

    #: Words kept; beyond, the memory starts anew, which changes no result.
    KEPT = 400_000

    def __init__(self, score):
        self.score, self.known = score, {}

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.KEPT:
            known.clear()
        new = list(set(words).difference(known))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            known.update(zip(part, self.score(part).tolist()))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))
