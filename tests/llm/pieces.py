"""Lossless lookup of edited items by their intact pieces: the reference for the walks of `cgk`.

An item that may have k edited words is cut into k + 1 pieces. An edit touches one piece at most, so
wherever the item occurs within k edits, one of its pieces stands there word by word, at most k words
from its usual place.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np

from loomtext.llm.cgk import SEED, best_alignment, edits_allowed, stretches
from loomtext.llm.common import WordHash, words

#: Base of the rolling hash, modulo 2^64, and its inverse.
BASE = 0xA24BAED4963EE407
INVERSE = pow(BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^64."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Rolling:
    """Hashes of the windows of a sequence: equal windows have equal hashes, wherever they stand."""

    def __init__(self, h: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(BASE, len(h)), dtype=np.uint64)])
        self.back = powers(INVERSE, len(h))

    def of(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.back[starts]


class PieceItems:
    """The items of one pass: their words, the word pairs they have, and their pieces by length.

    Words are numbered from 1; all words that are in no item share the number 0.
    """

    def __init__(self, items: list[tuple[int, bytes]], share: float):
        self.share = share
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        vocab = sorted({w for ws in self.words for w in ws})
        self.number = {w: i for i, w in enumerate(vocab, 1)}
        self.hash = np.concatenate([np.ones(1, np.uint64), WordHash(limit=len(vocab) + 1, seed=SEED).of(vocab)])
        self.pairs = np.unique(np.concatenate([[0], *(self.pair_of(self.numbers(ws)) for ws in self.words)]))
        self.edits = [edits_allowed(len(ws), share) for ws in self.words]
        self.anywhere = [i for i, ws in enumerate(self.words) if ws and self.edits[i] >= len(ws)]
        self.pieces = self.by_length()

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, tokens, repeat(0)), np.int64, len(tokens))

    def pair_of(self, numbers: np.ndarray) -> np.ndarray:
        return numbers[:-1] * len(self.hash) + numbers[1:]

    def by_length(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(words, sorted hashes, items, offsets) of the pieces, a length at a time; k + 1 pieces of an item share no word."""
        found: dict[int, list] = {}
        for i, ws in enumerate(self.words):
            k, n = self.edits[i], len(ws)
            if n > k:
                offsets = np.arange(k + 1) * n // (k + 1)
                size = n // (k + 1)
                keys = Rolling(self.hash[self.numbers(ws)]).of(offsets, size)
                found.setdefault(size, []).append((keys, np.full(k + 1, i), offsets))
        out = []
        for size, parts in sorted(found.items()):
            keys, owner, offsets = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(keys, kind="stable")
            out.append((size, keys[order], owner[order], offsets[order]))
        return out

    def candidates(self, tokens: list[bytes]) -> Iterator[tuple[int, int]]:
        """(item, start) where a piece of the item stands in its place; the start may be before the text."""
        n, numbers = len(tokens), self.numbers(tokens)
        pair = self.pair_of(numbers)
        strange = np.ones(len(pair), bool)
        inside = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
        place = np.minimum(np.searchsorted(self.pairs, pair[inside]), len(self.pairs) - 1)
        strange[inside] = self.pairs[place] != pair[inside]
        ends = np.concatenate([[-1], np.flatnonzero(strange), [len(pair)]])
        run = np.diff(ends)  # words that only known pairs join
        longest = int(run.max())
        until = np.repeat(ends[1:], run)  # first strange pair from each word on
        rolling = None
        for size, keys, owner, offsets in self.pieces:
            if size > longest:
                break
            starts = np.flatnonzero(until - np.arange(n) >= size - 1)
            rolling = rolling or Rolling(self.hash[numbers])
            key = rolling.of(starts, size)
            a = np.searchsorted(keys, key)
            hit = np.flatnonzero(keys[np.minimum(a, len(keys) - 1)] == key)
            b = np.searchsorted(keys, key[hit], "right")
            for j, end in zip(hit, b):
                for o in range(a[j], end):
                    yield int(owner[o]), int(starts[j] - offsets[o])
        for i in self.anywhere:
            yield from ((i, s) for s in range(n))

    def hits(self, tokens: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(item id, start, words, edits) of every item found, at its best place."""
        if not tokens or not self.words:
            return []
        out = []
        proposed: dict[int, set[int]] = {}
        for i, s in self.candidates(tokens):
            proposed.setdefault(i, set()).add(s)
        for i, starts in sorted(proposed.items()):
            item, k = self.words[i], self.edits[i]
            found = next(((0, s, len(item)) for s in sorted(starts) if s >= 0 and tokens[s : s + len(item)] == item), None)
            for low, high in stretches(starts, len(item), k) if found is None else ():
                there = tokens[low:high]
                held = set(there)
                if sum(w not in held for w in item) > k:
                    continue
                got = best_alignment(item, there, k)
                if got:
                    place = (got[0], low + got[1], got[2] - got[1])
                    found = min(found or place, place)
            if found:
                out.append((self.ids[i], found[1], found[2], found[0]))
        return out
