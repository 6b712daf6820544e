"""Periodic runs of words: minimizers at several scales propose periods, extension word by word decides.

A run is a stretch of words that repeats with a period, at least `MIN_REPEATS` times, and that no
neighbouring word extends. Periods below 2^`FIRST_SCALE` are found by comparing the words with
themselves at each lag. For periods q from 2^j to 2^(j+1) - 1 (scale j), every window of 2^j places
marks the place with the smallest hash, the first of equal ones. A run holds two windows of equal
content q words apart, so both mark the same place of the period. The 2^(j+1) words from a marked place
on are longer than the period and therefore recur in the run only at multiples of q: of the marked
places with equal words, neighbours are exactly q apart. Such pairs are extended to both sides by
comparing words, so hashes only propose. That takes a few passes per scale over texts long enough for
it, and memory linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import doc_bytes, mix64

#: A run holds its period this often, and has at least so many words.
MIN_REPEATS, MIN_WORDS = 4, 6
#: Periods below 2^FIRST_SCALE are found by direct comparison; places are ordered by the hash of as many words.
FIRST_SCALE = 3
#: Documents that are searched together: up to so many words, or one document.
BLOCK_WORDS = 500_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_DDL = "struct<start: long, length: long, period: long>"


class Numbers(dict):
    """Word -> number in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def smallest_period(x: np.ndarray, s: int, q: int) -> bool:
    """Whether no smaller period divides q; x repeats with q from s on, several times."""
    return not any(q % p == 0 and np.array_equal(x[s : s + q], x[s + p : s + p + q]) for p in range(1, q // 2 + 1))


def least_length(q: int) -> int:
    return max(MIN_WORDS, MIN_REPEATS * q)


def matches_ahead(x: np.ndarray, i: int, d: int) -> int:
    """First place from i on whose word differs from the one d later."""
    size = 64
    while i + d < len(x):
        m = min(size, len(x) - i - d)
        differ = np.flatnonzero(x[i : i + m] != x[i + d : i + d + m])
        if len(differ):
            return i + int(differ[0])
        i, size = i + m, size * 4
    return i


def matches_back(x: np.ndarray, i: int, d: int) -> int:
    """First place up to i from which on all words up to i equal those d later."""
    size = 64
    while i > 0:
        m = min(size, i)
        differ = np.flatnonzero(x[i - m : i] != x[i - m + d : i + d])
        if len(differ):
            return i - m + int(differ[-1]) + 1
        i, size = i - m, size * 4
    return i


def short_runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs with periods below 2^FIRST_SCALE: stretches of words that equal those q later."""
    for q in range(1, min(1 << FIRST_SCALE, len(x))):
        same = np.flatnonzero(x[q:] == x[:-q])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) > 1) + 1
        starts = same[np.concatenate([[0], cut])]
        sizes = np.diff(np.concatenate([[0], cut, [len(same)]])) + q
        for i in np.flatnonzero(sizes >= least_length(q)):
            if smallest_period(x, int(starts[i]), q):
                yield int(starts[i]), int(sizes[i]), q


def joined(h: np.ndarray, g: int) -> np.ndarray:
    """Hashes of 2g words from hashes of g words, at every place; beyond the end nothing follows."""
    out = h * np.uint64(0x9E3779B97F4A7C15)
    out[:-g] ^= h[g:]
    return mix64(out)


def long_runs(x: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs with the other periods. Texts stand in `x` longest first, up to `ends`, a number of its own after each."""
    h = mix64((x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(FIRST_SCALE):
        h = joined(h, 1 << k) if len(h) > 1 << k else h
    bits = np.uint64(len(x).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (h & ~low) | np.arange(len(x), dtype=np.uint64)  # smallest hash of a window, and its place
    width = 1
    sizes = np.diff(np.concatenate([[0], ends]))  # with the number after the text
    for j in range(FIRST_SCALE, len(x).bit_length()):
        n = int(ends[np.searchsorted(-sizes, -(MIN_REPEATS << j), "left") - 1]) if sizes[0] > MIN_REPEATS << j else 0
        if not n:
            break
        x, h, least = x[:n], joined(h[:n], 1 << j), least[:n]
        while width < 1 << j:
            least = np.concatenate([np.minimum(least[:-width], least[width:]), least[-width:]])
            width *= 2
        place = (least & low).astype(np.int64)
        place = place[np.concatenate([[True], place[1:] != place[:-1]])]
        place = place[place < n]
        order = np.argsort(h[place], kind="stable")
        place, key = place[order], h[place[order]]
        lag = place[1:] - place[:-1]
        pairs = np.flatnonzero((key[1:] == key[:-1]) & (lag >= 1 << j) & (lag < 2 << j))
        pairs = pairs[np.argsort(place[pairs], kind="stable")]
        until: dict[int, int] = {}  # what has been compared at a lag
        for m, d in zip(place[pairs].tolist(), lag[pairs].tolist()):
            if m < until.get(d, 0):
                continue
            until[d] = end = matches_ahead(x, m, d)
            start = matches_back(x, m, d)
            if end + d - start >= least_length(d) and smallest_period(x, start, d):
                yield start, end + d - start, d


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period. Texts are numbered words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= MIN_WORDS), key=lambda i: -len(texts[i]))
    if not order:
        return out
    x = np.concatenate([part for k, i in enumerate(order) for part in (texts[i], [-1 - k])]).astype(np.int64)
    ends = np.cumsum([len(texts[i]) + 1 for i in order])
    for source in (short_runs(x), long_runs(x, ends)):
        for start, length, period in source:
            k = int(np.searchsorted(ends, start, "right"))
            out[order[k]].append((start - (int(ends[k - 1]) if k else 0), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; of equal ones the first, then that of the smallest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Places of the words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.flatnonzero(np.cumsum(edge[:-1]) == 0)


def search(batch: pa.RecordBatch, rewrite: Callable | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with their runs, in blocks of bounded size."""
    first, size, at = 0, 0, 0
    numbers, texts, flat = Numbers(), [], []

    def block() -> pa.RecordBatch:
        found = runs_of(texts)
        vocab = list(numbers)
        for i, runs in enumerate(found):
            if runs:
                flat[i] = b" ".join(vocab[w] for w in texts[i][kept_words(len(texts[i]), runs)].tolist())
        as_struct = lambda runs: None if runs is None else dict(zip(("start", "length", "period"), runs))
        return pa.RecordBatch.from_arrays([
            batch.column(0).slice(first, len(texts)), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[as_struct(r) for r in runs] for runs in found], pa.list_(RUN)),
            pa.array([as_struct(strongest(runs)) for runs in found], RUN),
            pa.array(flat, pa.binary()).cast(pa.string()),
        ], schema=schema)

    for at, data in enumerate(batch.column(1)):
        words = data.as_py().split()
        if rewrite:
            words = rewrite(words, batch.column(2)[at].as_py())
        if texts and size + len(words) > BLOCK_WORDS:
            yield block()
            first, size, numbers, texts, flat = at, 0, Numbers(), [], []
        texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        flat.append(b" ".join(words))
        size += len(words)
    if texts:
        yield block()


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", rewrite: Callable | None = None,
              rewrite_by: str | None = None) -> DataFrame:
    """`_row` (the columns `keep`), n_words, runs (array of start, length, period), strongest, collapsed.

    Words are cut at ASCII white space and compared byte by byte. `rewrite(words, value)` may change
    the words of a text first, given its value of the column `rewrite_by`. `collapsed` joins by one
    space the words that no run holds after its first period. A null or empty text has no words, no
    runs, a null `strongest` and an empty `collapsed`. Repeated rows are reported each; equal lengths
    over period are decided by start, then period. Columns not in `keep` are not read.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    value = [F.col(f"`{rewrite_by}`").alias("_value")] if rewrite_by else []
    rows = docs.select(row, doc_bytes(F.col(f"`{text}`")).alias("_data"), *value)
    out = f"_row {rows.schema['_row'].dataType.simpleString()}, n_words long, runs array<{RUN_DDL}>, strongest {RUN_DDL}, collapsed string"

    def map_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            schema = pa.schema([
                batch.schema.field(0), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("strongest", RUN), ("collapsed", pa.string())])
            yield from search(batch, rewrite, schema)

    return rows.mapInArrow(map_batches, out)
