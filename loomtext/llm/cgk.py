"""Benchmark decontamination by the CGK embedding.

The embedding walks along a sequence of words: at each step it writes the word it stands on, and a
random bit of that word and step says whether it moves on. Two sequences at a small edit distance
fall into step again after each edit with good probability, so their embeddings differ in few places.
Bit sampling then reads a few steps of the embedding of every item-sized window; windows and items
that agree on one of the samples are candidates, and a candidate counts only if its exact edit
distance is within the bound.

How many walks are needed follows from the recall wanted: for each class of item lengths the walks of
random items and their edited copies are played through, with changed, deleted, inserted and mixed
words at the full number of edits, until `RECALL` of the copies agree on some sample for the worst of these kinds.
Longer items with more edits get more walks. An unedited item always agrees. If more than `WALKABLE` of
the words may be edited, walks tell nothing and all windows left are verified.

Before walking, a window start is set aside if a match can be ruled out: an edit breaks at most two
pairs of neighbouring words, so of an item's pairs all but 2k are left within k edits. This loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import WordHash, batches, doc_bytes, mix64, tidy, words

#: Share of an item's words that may be edited.
MAX_EDITS = 0.1
#: Share of the occurrences with all edits allowed that walks from their first word alone have to find.
RECALL = 0.995
#: Items of one pass over the documents; more items take more passes.
BLOCK_WORDS = 4_000_000
#: Samples of the steps of each walk, and steps that a sample reads.
SAMPLES, STEPS_PER_SAMPLE = 8, 2
#: Largest share of edited words for which walks propose candidates.
WALKABLE = 0.2
#: Edited copies of each kind that are played through to find the number of walks.
TRIALS = 100
SEED = 20240601

HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64())])
HITS_DDL = "doc_id long, item_id long, start long, n_words long, edits long"


def edits_allowed(n: int, share: float = MAX_EDITS) -> int:
    return int(n * share)


def bits_of(h: np.ndarray, walk: int, t: int) -> np.ndarray:
    """64 random bits of each word for the steps t to t + 63 of a walk."""
    return mix64(h ^ np.uint64((walk * 64 + t // 64 + 1) * 0xA24BAED4963EE407 % 2**64))


@cache
def samples_of(walk: int, n_steps: int) -> tuple[np.ndarray, np.ndarray]:
    """[samples, steps per sample] steps that are read of a walk, and a random multiplier for each."""
    rng = np.random.default_rng([SEED, walk, n_steps])
    steps = np.stack([rng.choice(n_steps, min(STEPS_PER_SAMPLE, n_steps), replace=False) for _ in range(SAMPLES)])
    return steps, rng.integers(0, 2**63, steps.shape, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def sampled(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: int, n_steps: int) -> np.ndarray:
    """[samples, starts] one key per bit sample of the embeddings by one walk from each start.

    Bit t of a word's hash for the walk says whether step t moves on from it; past the end of its
    window a walk writes nothing. Only the steps that a sample reads are written at all.
    """
    steps, factors = samples_of(walk, n_steps)
    keys = np.full((SAMPLES, len(starts)), walk + 1, np.uint64)
    at, last = starts.copy(), len(h) - 1
    bits = np.zeros(0, np.uint64)
    for t in range(int(steps.max()) + 1):
        if t % 64 == 0:
            bits = bits_of(h, walk, t)
        here = np.minimum(at, last)
        inside = at < ends
        for s, j in zip(*np.nonzero(steps == t)):
            keys[s] += h[here] * inside * factors[s, j]
        at += ((bits[here] >> np.uint64(t % 64)) & np.uint64(1)).astype(at.dtype) * inside
    return keys + np.arange(SAMPLES, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)


def edited_copies(n: int, k: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(items, copies, lengths of the copies): TRIALS items of n words for each kind of k edits, all words different."""
    rng = np.random.default_rng([seed, n, k])
    items = rng.integers(1, 2**63, (4 * TRIALS, n)).astype(np.uint64)
    copies, sizes = np.zeros((4 * TRIALS, n + k), np.uint64), np.zeros(4 * TRIALS, np.int64)
    for row, item in enumerate(items):
        copy = item.tolist()
        for _ in range(k):
            kind = row // TRIALS if row < 3 * TRIALS else int(rng.integers(3))
            at = int(rng.integers(len(copy)))
            copy[at : at + (kind < 2)] = [] if kind == 1 else [int(rng.integers(1, 2**63))]
        sizes[row] = len(copy)
        copies[row, : len(copy)] = np.array(copy, np.uint64)
    return items, copies, sizes


def agreement(a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray, walk: int, n_steps: int) -> np.ndarray:
    """Share of the steps of a walk at which the embeddings of each pair of rows agree."""
    row, i, j = np.arange(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    same = np.zeros(len(a))
    for t in range(n_steps):
        if t % 64 == 0:
            bits_a, bits_b = bits_of(a, walk, t), bits_of(b, walk, t)
        x, y, in_a, in_b = np.minimum(i, a.shape[1] - 1), np.minimum(j, b.shape[1] - 1), i < a_size, j < b_size
        same += a[row, x] * in_a == b[row, y] * in_b
        i += ((bits_a[row, x] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64) * in_a
        j += ((bits_b[row, y] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64) * in_b
    return same / n_steps


def walk_steps(n: int, share: float) -> int:
    return max(1, 2 * (n - edits_allowed(n, share)))


@cache
def walks_needed(n: int, n_steps: int, share: float = MAX_EDITS, recall: float = RECALL) -> int:
    """Walks whose samples find `recall` of the copies of items of n words with all edits allowed, for the worst kind
    of edits; 0 if walks are no use."""
    k = edits_allowed(n, share)
    if not k:
        return 1
    if k > WALKABLE * n:
        return 0
    items, copies, sizes = edited_copies(n, k)
    missed, walk = np.zeros(len(items)), 0  # logarithms of the chances that no sample so far agrees
    while (1 - np.exp(missed)).reshape(4, TRIALS).mean(axis=1).min() < recall:
        a = agreement(items, np.full(len(items), n), copies, sizes, walk, n_steps)
        missed += SAMPLES * np.log1p(-np.minimum(a**STEPS_PER_SAMPLE, 1 - 1e-12))
        walk += 1
    return walk


def length_classes(lengths: list[int]) -> list[tuple[int, int]]:
    """(shortest, longest) of the classes of item lengths, each up to a quarter wide."""
    out, lengths = [], sorted(set(lengths))
    while lengths:
        low = lengths[0]
        group = [n for n in lengths if n <= low + max(2, low // 4)]
        lengths = lengths[len(group) :]
        out.append((low, group[-1]))
    return out


def best_alignment(item: list, text: list, bound: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the piece of `text` nearest to `item` if within `bound` edits, else None.

    Of equally near pieces the one that starts first and then ends first.
    """
    number = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    there = np.fromiter(map(number.get, text, repeat(0)), np.int64, len(text))
    one = len(text) + 1  # a cell is edits * one + start, so the smallest is the one wanted
    prev = np.arange(one)
    edge = np.arange(one) * one
    for a in item:
        cell = prev + one
        cell[1:] = np.minimum(cell[1:], prev[:-1] + (there != number[a]) * one)
        prev = np.minimum.accumulate(cell - edge) + edge
        if prev.min() >= (bound + 1) * one:
            return None
    end = int(prev.argmin())
    return int(prev[end]) // one, int(prev[end]) % one, end


class Items:
    """The items of one pass: their words, the lengths to scan for, and the samples of their walks.

    Words are numbered from 1; all words that are in no item share the number 0. `classes` are (shortest
    length, longest length, walks).
    """

    def __init__(self, items: list[tuple[int, bytes]], share: float, classes: list[tuple[int, int, int]] | None = None):
        self.share = share
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        vocab = sorted({w for ws in self.words for w in ws})
        self.number = {w: i for i, w in enumerate(vocab, 1)}
        self.hash = np.concatenate([[1], WordHash(limit=len(vocab) + 1, seed=SEED).of(vocab)]).astype(np.uint64)
        classes = walk_classes([len(ws) for ws in self.words if ws], share) if classes is None else classes
        self.classes = [self.of_class(*c) for c in classes]  # (shortest, most edits, longest, walk steps, walks, keys, items of the keys)
        self.pairs, self.pair_classes = self.known_pairs()

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, tokens, repeat(0)), np.int64, len(tokens))

    def pair_of(self, numbers: np.ndarray) -> np.ndarray:
        return numbers[:-1] * len(self.hash) + numbers[1:]

    def known_pairs(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sorted word pairs of the items, and for each class which of them it has."""
        by_class = []
        for low, _, high, *_ in self.classes:
            own = [self.pair_of(self.numbers(ws)) for ws in self.words if low <= len(ws) <= high]
            by_class.append(np.unique(np.concatenate(own)))
        pairs = np.unique(np.concatenate([*by_class, [0]]))
        return pairs, [np.isin(pairs, own) for own in by_class]

    def of_class(self, low: int, high: int, walks: int) -> tuple:
        members = [i for i, ws in enumerate(self.words) if low <= len(ws) <= high]
        n_steps = walk_steps(low, self.share)
        keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i in members:
            h = self.hash[self.numbers(self.words[i])]
            for walk in range(walks):
                keys.append(sampled(h, np.zeros(1, np.int64), np.full(1, len(h)), walk, n_steps)[:, 0])
                owner.append(np.full(SAMPLES, i))
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        return low, edits_allowed(high, self.share), high, n_steps, walks, keys[order], owner[order]

    def candidates(self, tokens: list[bytes]) -> Iterator[tuple[int, int]]:
        """(item, start) whose sampled embeddings agree."""
        n, numbers = len(tokens), self.numbers(tokens)
        pair = self.pair_of(numbers)
        at = np.zeros(len(pair), np.int64)  # place among the known pairs; the first place is no pair
        inside = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
        place = np.minimum(np.searchsorted(self.pairs, pair[inside]), len(self.pairs) - 1)
        at[inside] = np.where(self.pairs[place] == pair[inside], place, 0)
        n_known, h = np.count_nonzero(at), None
        for c, (low, k, high, n_steps, walks, keys, owner) in enumerate(self.classes):
            if low - 1 - 2 * k > n_known:
                continue
            known = np.concatenate([[0], np.cumsum(self.pair_classes[c][at])])
            if low - 1 - 2 * k > known[-1]:
                continue
            starts = np.arange(max(0, n - low + k + 1))
            held = known[np.minimum(starts + low - 1, len(pair))] - known[np.minimum(starts, len(pair))]
            starts = starts[held >= low - 1 - 2 * k]
            if len(starts) and h is None:
                h = self.hash[numbers]
            if not walks:
                yield from ((i, s) for i, ws in enumerate(self.words) if low <= len(ws) <= high for s in starts.tolist())
            for part in range(0, len(starts) if walks else 0, 65_536):
                s = starts[part : part + 65_536]
                ends = np.minimum(s + high, n)
                for walk in range(walks):
                    key = sampled(h, s, ends, walk, n_steps).ravel()
                    a = np.searchsorted(keys, key)
                    hit = np.flatnonzero(keys[np.minimum(a, len(keys) - 1)] == key)
                    b = np.searchsorted(keys, key[hit], "right")
                    for j, end in zip(hit.tolist(), b.tolist()):
                        for o in range(a[j], end):
                            yield int(owner[o]), int(s[j % len(s)])

    def hits(self, tokens: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(item id, start, words, edits) of every item found, at its best place."""
        if not tokens or not self.classes:
            return []
        out = []
        proposed: dict[int, set[int]] = {}
        for i, s in self.candidates(tokens):
            proposed.setdefault(i, set()).add(s)
        for i, starts in sorted(proposed.items()):
            item = self.words[i]
            k = edits_allowed(len(item), self.share)
            found = next(((0, s, len(item)) for s in sorted(starts) if tokens[s : s + len(item)] == item), None)
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


def walk_classes(lengths: list[int], share: float) -> list[tuple[int, int, int]]:
    """(shortest, longest, walks) of the classes of item lengths."""
    return [(low, high, walks_needed(high, walk_steps(low, share), share)) for low, high in length_classes(lengths)]


def stretches(starts: set[int], n: int, k: int) -> Iterator[tuple[int, int]]:
    """The parts of the text within k words of n words from any of the starts; what overlaps is one part."""
    low = high = None
    for s in sorted(starts):
        if high is not None and s - k <= high:
            high = s + n + k
            continue
        if high is not None:
            yield low, high
        low, high = max(0, s - k), s + n + k
    if high is not None:
        yield low, high


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of bounded size, each sent to the driver by itself."""
    rows = items.select(F.col(item_id).cast("long").alias("id"), doc_bytes(F.col(text)).alias("t")).orderBy("id", "t")
    block, size = [], 0
    for row in rows.toLocalIterator():
        n = len(words(bytes(row["t"])))
        if not n:
            continue
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row["id"], bytes(row["t"])))
        size += n
    if block:
        yield block


def find_items(docs: DataFrame, items: DataFrame, share: float = MAX_EDITS, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start, n_words, edits: the items that occur in each document, at their best place.

    Words are A-Z lower-cased and cut at ASCII white space. An item of n words occurs where a piece
    of the document is within floor(n * share) edited words of it. Items and documents without words
    occur nowhere and hold nothing; null ids stay null; repeated rows are reported each, an item
    repeated under one id once per row. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), doc_bytes(F.col(text)).alias("data"))
    found = None
    for block in item_blocks(items, item_id, item_text):
        classes = walk_classes([len(words(t)) for _, t in block], share)  # found once, not in every task
        sent = spark.sparkContext.broadcast((block, classes))

        def search(it: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Items(sent.value[0], share, sent.value[1])
            for batch in it:
                out = []
                for i, data in zip(batch.column(0), batch.column(1)):
                    for item, start, n, edits in index.hits(words(data.as_py())):
                        out.append({"doc_id": i.as_py(), "item_id": item, "start": start, "n_words": n, "edits": edits})
                yield from batches(out, HITS)

        part = rows.mapInArrow(lambda it, search=search: tidy(search(it)), HITS_DDL)
        found = part if found is None else found.unionAll(part)
    return spark.createDataFrame([], HITS_DDL) if found is None else found
