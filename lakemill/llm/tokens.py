"""Token ids of whole texts by a given tokenizer, for batches of texts."""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

#: Ends every document.
END_ID = 2
#: Pieces of text whose ids a worker keeps; beyond, the memory starts anew.
KEPT_PIECES = 600_000
#: New words that are encoded as one text.
JOINED_WORDS = 64
_TAIL = ".,;:!?*%&#$"
#: White space other than single blanks and newlines; runs of it do not fall apart at each sign.
_UNUSUAL = re.compile(r"[^\S \n]|[ \n]{3}|[ \n]{2}\Z")


class _Codes(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, piece):
        code = self[piece] = len(self)
        self.new.append(piece)
        return code


class Encoder:
    """Ids by the tokenizers library.

    A byte-level tokenizer with the usual pattern never joins a blank or a newline to what stands
    before it, so a text of words set apart by these falls into pieces that can be encoded one by
    one; the ids of pieces seen before are kept. Texts with other white space, or with one of the
    tokenizer's special strings, and all texts of another kind of tokenizer are encoded whole. The
    ids are the same either way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        split = about.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        self.splits = bool(plain and not about.get("normalizer"))
        # Byte-level vocabularies write a byte as its own Latin-1 character if that can be seen, and
        # the others, in order, as the characters from 256 on.
        seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in seen]
        self.signs = {b: 256 + k for k, b in enumerate(hidden)}
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that begin with a blank
        self.opens[[k for token, k in vocabulary.items() if token.startswith(chr(self.signs[32]))]] = True
        self.special = [t["content"] for t in about.get("added_tokens") or ()]
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of letters-only words, each after a blank: one piece for the tokenizer's pattern.

        Words are encoded many at a time; each begins where a token begins with a blank.
        """
        groups = [words[at : at + JOINED_WORDS] for at in range(0, len(words), JOINED_WORDS)]
        out: list = []
        for some, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups])):
            cuts = np.flatnonzero(self.opens[ids]).tolist()
            if len(cuts) == len(some) and cuts[0] == 0:
                out += [ids[a:b] for a, b in zip(cuts, [*cuts[1:], len(ids)])]
            else:
                out += self._encode([" " + w for w in some])
        return out

    def _learn(self) -> None:
        """Looks up the ids of the pieces that were new in the last batch."""
        codes, first = self.codes, len(self.codes) - len(self.codes.new)
        ids: dict = {}
        todo = codes.new
        codes.new = []
        split, words, others = [], [], []
        for p in todo:
            if isinstance(p, tuple):
                others.append(p)
            elif p.isalpha():
                words.append(p)
            elif (core := p.rstrip(_TAIL)).isalpha():
                split.append((p, core))
            else:
                others.append(p)
        unknown = list(dict.fromkeys([*words, *(c for _, c in split if c not in codes)]))
        ids.update(zip(unknown, self._encode_words(unknown)))
        tails = list({p[len(c) :] for p, c in split})
        after = dict(zip(tails, self._encode(tails)))
        # A piece that is text stands after a blank unless it starts with a newline; (text,) starts a document.
        ids.update(zip(others, self._encode([p[0] if isinstance(p, tuple) else p if p[:1] == "\n" else " " + p for p in others])))
        for p, core in split:
            ids[p] = (ids[core] if core in ids else self._known(codes[core])) + after[p[len(core) :]]
        self._store(first, [ids[p] for p in todo])

    def _known(self, code: int) -> list[int]:
        return self.flat[self.starts[code] : self.starts[code] + self.sizes[code]].tolist()

    def _store(self, first: int, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total, n = int(sizes.sum()), first + len(lists)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        self.starts[first:n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:n] = sizes
        self.used += total

    def encode(self, texts: list[str], end: int | None = None) -> list[np.ndarray]:
        """The ids of each text, `end` appended."""
        if len(self.codes) > KEPT_PIECES:
            self._forget()
        out: list = [None] * len(texts)
        whole, pieces, sizes, split = [], [], [], []
        for i, t in enumerate(texts):
            # Mostly there is one blank or newline between words and nothing else, which is cheap to see.
            single = " ".join(t.split()) == t.replace("\n", " ")
            if not self.splits or not single and _UNUSUAL.search(t) or any(s in t for s in self.special):
                whole.append(i)
                continue
            parts: list = t.replace("\n", " \n").split(" ")
            if parts[0]:
                parts[0] = (parts[0],)
            else:
                del parts[0]
            pieces += parts
            sizes.append(len(parts))
            split.append(i)
        tail = np.zeros(0, np.uint32) if end is None else np.array([end], np.uint32)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = np.concatenate([np.array(ids, np.uint32), tail])
        if split:
            codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
            if self.codes.new:
                self._learn()
            lengths = self.sizes[codes]
            stops = np.cumsum(lengths)
            ids = self.flat[np.arange(int(lengths.sum())) + np.repeat(self.starts[codes] - (stops - lengths), lengths)]
            bounds = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(sizes)])]
            for k, i in enumerate(split):
                out[i] = np.concatenate([ids[bounds[k] : bounds[k + 1]], tail])
        return out
