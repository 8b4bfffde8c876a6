"""Token ids by tokenizers that encode the words between white space one by one, with a memory of words."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

from lakemill.llm.tokens import _TAIL, Encoder

#: Words whose ids a worker keeps, some 200 bytes each; beyond, the memory starts anew.
KEPT_WORDS = 1_000_000
#: Python splits at these signs, which are no white space to the tokenizer, or may be in another version.
_UNSURE = re.compile("[\x1c-\x1f᠎]")
#: Words that one call of the tokenizer's model encodes: their lower case is one sign for one sign, and composed.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


class WordEncoder(Encoder):
    """Ids by the tokenizers library, the same as for whole texts.

    If the tokenizer's rules never join signs across white space and drop it, a text is the
    sequence of its words, and the ids of words seen before are kept. Texts with a special string
    or with signs on which libraries differ are encoded whole, as are all texts of other tokenizers.
    """

    def __init__(self, path: str):
        super().__init__(path)
        about = json.loads(self.tokenizer.to_str())
        steps = (about.get("normalizer") or {}).get("normalizers") or []
        parts = (about.get("pre_tokenizer") or {}).get("pretokenizers") or []
        words = [p for p in parts if p.get("type") == "Split" and p.get("invert") and p.get("behavior") == "Removed"]
        known = [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
        after = [p for p in parts if p not in words]
        whole = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex") for p in after)
        # The alternatives of the pattern match no white space, and letters only among letters.
        pattern = words[0]["pattern"].get("Regex", "") if words else ""
        self.splits = bool(known and whole and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"))
        letters = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))} | {b: chr(s) for b, s in self.signs.items()}
        self.letters = {b: c for b, c in letters.items() if b > 127}

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        lower = (w.lower() for w in words)
        return [[t.id for t in tokenize(w if w.isascii() else w.encode("utf-8").decode("latin-1").translate(letters))] for w in lower]

    def _learn(self) -> None:
        codes, first = self.codes, len(self.codes) - len(self.codes.new)
        todo, codes.new = codes.new, []
        cores = [p.rstrip(_TAIL) for p in todo]
        plain = [_PLAIN.fullmatch(c) is not None for c in cores]
        unknown = list(dict.fromkeys(c for c, ok in zip(cores, plain) if ok and (c not in codes or codes[c] >= first)))
        ids: dict = dict(zip(unknown, self._encode_words(unknown)))
        tails = list({p[len(c) :] for p, c, ok in zip(todo, cores, plain) if ok and p != c})
        after = dict(zip(tails, self._encode(tails))) | {"": []}
        others = [p for p, ok in zip(todo, plain) if not ok]
        ids.update(zip(others, self._encode(others)))
        self._store(first, [(ids[c] if c in ids else self._known(codes[c])) + after[p[len(c) :]] if ok else ids[p] for p, c, ok in zip(todo, cores, plain)])

    def encode(self, texts: list[str], end: int | None = None) -> list[np.ndarray]:
        """The ids of each text, `end` appended."""
        if len(self.codes) > KEPT_WORDS:
            self._forget()
        tail = np.zeros(0, np.uint32) if end is None else np.array([end], np.uint32)
        out: list = [None] * len(texts)
        whole, split, sizes, pieces = [], [], [], []
        for i, t in enumerate(texts):
            if not self.splits or _UNSURE.search(t) or any(s in t for s in self.special):
                whole.append(i)
            else:
                words = t.split()
                pieces += words
                sizes.append(len(words))
                split.append(i)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = np.concatenate([np.array(ids, np.uint32), tail])
        codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
        if self.codes.new:
            self._learn()
        lengths = self.sizes[codes]
        stops = np.cumsum(lengths)
        ids = self.flat[np.arange(int(lengths.sum())) + np.repeat(self.starts[codes] - (stops - lengths), lengths)]
        bounds = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        for k, i in enumerate(split):
            out[i] = np.concatenate([ids[bounds[k] : bounds[k + 1]], tail])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder of this file; it goes on from task to task."""
    return WordEncoder(path)
