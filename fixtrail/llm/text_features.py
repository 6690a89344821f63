"""Sparse text features for the classifiers: hashed words and hashed word shapes of whole texts."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(r"\w+")
_KINDS = re.compile(r"[a-zß-öø-ÿ]+|[A-ZÀ-ÖØ-Þ]+|[0-9]+")


class WordHasher:
    """Small texts → bucket numbers; forgets all when it holds too many."""

    def __init__(self, buckets: int, seed: int = 0, most: int = 200_000):
        self.buckets, self.seed, self.most = buckets, seed, most
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word, seed=self.seed) % self.buckets
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


class PrefixHasher:
    """Distinct buckets of a text's words and of their first letters; forgets all when it holds too many words."""

    def __init__(self, buckets: int, lengths: tuple[int, ...] = (4, 5, 6, 7), most: int = 100_000):
        self.buckets, self.lengths, self.most = buckets, lengths, most
        self.known: dict[str, bytes] = {}

    def _of(self, word: str) -> bytes:
        # A prefix has a mark that no word has, so that it differs from the word of the same letters.
        parts = [word, *(f"{word[:n]}-" for n in self.lengths if n < len(word))]
        return np.array([xxhash.xxh3_64_intdigest(p) % self.buckets for p in parts], np.int32).tobytes()

    def __call__(self, text: str) -> np.ndarray:
        words = set(lower_words(text))
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for word in words.difference(known):
            known[word] = self._of(word)
        return np.unique(np.frombuffer(b"".join([known[w] for w in words]), np.int32))


def lower_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shape(word: str) -> str:
    """A word with small letters as ``a``, capitals as ``A``, digits as ``0`` and, of each run, one."""
    word = _KINDS.sub(lambda m: "a" if m[0][0].islower() else "0" if m[0][0].isdigit() else "A", word)
    return word[:12]


class Shapes:
    """Shapes of the blank-separated words of a text, with marks for words that repeat the one before."""

    def __init__(self, most: int = 200_000):
        self.known: dict[str, str] = {}
        self.most = most

    def __call__(self, text: str) -> list[str]:
        words = text.split()
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = shape(word)
        shapes = [known[w] for w in words]
        again = sum(a == b for a, b in zip(words, words[1:]))
        return shapes + ["=again"] * again
