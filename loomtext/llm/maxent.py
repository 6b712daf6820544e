"""Language-model scoring with a hashed maximum-entropy model.

The probability of a word is that of its class times that of the word in its class. Frequent words
form classes of equal length by rank and have a softmax of their own inside the class; all other
words form classes by their last bytes, inside which smoothed counts decide (an unseen word is one
more word of its class). Features are the words before (one, two and three back, and the two before
together); each selects a row of a bounded weight table by its hash. Class and word priors come from
corpus counts, and the weights from distributed gradient updates: in each round the tasks take steps
from the common weights on their share of the training texts, and their changes are averaged.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import doc_bytes, stored, text_blocks, tidy, word_codes
from loomtext.operators import skew

HEAD_CLASSES, MEMBERS, TAIL_CLASSES = 32, 32, 32
CLASSES = HEAD_CLASSES + TAIL_CLASSES
HEAD = HEAD_CLASSES * MEMBERS
SYMBOLS = HEAD + TAIL_CLASSES + 1  # the last one stands before a text
START = SYMBOLS - 1
BUCKETS = 1 << 14
#: Words whose counts every task holds; the counts of all others are joined.
MAX_DICTIONARY = 1 << 18
KEY_BYTES = 64
FLUSH_WORDS = 400_000
ROUNDS, STEP, BATCH, FIRST_SQUARE = 3, 0.15, 8192, 1.0
BLOCK_ROWS = 256
#: Bytes of the texts that are learned from or scored together.
LEARN_BYTES = 4_000_000
#: So few rows with gradients left to add are summed on their own.
FEW_RUNS = 24
GATHER = 1024
END = b"\n"  # not a word of any text


def key_of(word: bytes) -> bytes:
    """Words beyond 64 bytes are kept by their digest, after a blank, which no word has."""
    if len(word) <= KEY_BYTES:
        return word
    import hashlib

    return b" " + hashlib.sha256(word).hexdigest().encode()


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


@functools.cache
def tail_table() -> np.ndarray:
    """Classes by the last two bytes; from 65,536 on those of words of one byte."""
    two = [tail_class(bytes([a, b])) for a in range(256) for b in range(256)]
    return np.array(two + [tail_class(bytes([a])) for a in range(256)], np.int64)


def keys_of(found: pa.Array) -> pa.Array:
    """`key_of` for an array of words."""
    long = pc.greater(pc.binary_length(found), KEY_BYTES)
    if not pc.any(long).as_py():
        return found
    return pc.replace_with_mask(found, long, pa.array([key_of(w) for w in found.filter(long).to_pylist()], found.type))


def tail_classes(found: pa.Array) -> np.ndarray:
    """`tail_class` for an array of words (large binary, none empty)."""
    if not len(found):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    data = np.frombuffer(found.buffers()[2], np.uint8)
    last = data[ends[1:] - 1].astype(np.int64)
    return tail_table()[np.where(np.diff(ends) > 1, data[np.maximum(ends[1:] - 2, 0)] * np.int64(256), 65536) + last]


def tail_class_column(word: Column) -> Column:
    two = F.when(F.length(word) <= 2, word).otherwise(F.substring(word, -2, 2))
    return F.pmod(F.crc32(two), F.lit(TAIL_CLASSES)).cast("int")


def count_words(rows: DataFrame) -> DataFrame:
    """(word, n) over all rows' `data`; each text ends with one end mark."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, times = [], []

        def merge() -> None:
            coded = pa.concat_arrays([pa.array([], pa.large_binary()), *found]).dictionary_encode()
            n = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(n, coded.indices.to_numpy(), np.concatenate([np.zeros(0, np.int64), *times]))
            found[:], times[:] = [coded.dictionary], [n]

        def out() -> pa.RecordBatch:
            merge()
            got = pa.RecordBatch.from_arrays([found[0].cast(pa.binary()), pa.array(times[0])], ["word", "n"])
            found.clear(), times.clear()
            return got

        for batch in it:
            for part in text_blocks(batch.column("data")):
                coded, index, sizes = word_codes(part)
                found.extend([keys_of(coded), pa.array([END], pa.large_binary())])
                times.extend([np.bincount(index, minlength=len(coded)), np.array([len(sizes)])])
                if sum(map(len, found[1:])) > FLUSH_WORDS:
                    merge()
                    if len(found[0]) > FLUSH_WORDS:
                        yield out()
        yield out()

    return rows.select("data").mapInArrow(lambda it: tidy(count(it)), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What all tasks hold: counts of the frequent words, and the priors of classes and members."""

    blob: bytes  # the words, one after the other, split by the end mark
    counts: np.ndarray
    symbols: np.ndarray  # symbol of each word
    end_symbol: int
    end_count: int
    class_prior: np.ndarray  # [CLASSES] log
    member_prior: np.ndarray  # [HEAD_CLASSES, MEMBERS] log
    tail_total: np.ndarray  # [TAIL_CLASSES] smoothed mass of each
    total: int
    distinct: int

    def parts(self) -> tuple:
        """The fields, to be broadcast: tasks need not know the class to read them."""
        return tuple(getattr(self, f.name) for f in fields(self))

    def words(self) -> pa.Array:
        return pa.array(self.blob.split(END) if len(self.counts) else [], pa.large_binary())


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Counted words -> dictionary of at most MAX_DICTIONARY of them, and priors over all of them."""
    level = F.when(F.col("n") < 4096, F.col("n")).otherwise((F.log2("n") * 64 + 4096).cast("long"))
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("m")).toArrow().to_pandas()  # some thousand rows
    levels = levels.sort_values("level", ascending=False)
    taken = levels[levels["m"].cumsum() <= MAX_DICTIONARY]
    least = int(taken["level"].min()) if len(taken) else 1 << 62
    known = counts.where((level >= least) | (F.col("word") == F.lit(END))).toArrow().to_pandas()
    known = known.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    top = known[:HEAD]
    head = {w: i for i, w in enumerate(top["word"])}
    n_top = top["n"].to_numpy(float)
    sums = counts.groupBy(tail_class_column(F.col("word")).alias("c")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow().to_pandas()
    tail_n, tail_v = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    tail_n[sums["c"].to_numpy(int)], tail_v[sums["c"].to_numpy(int)] = sums["n"], sums["v"]
    total, distinct = int(tail_n.sum()), int(tail_v.sum())
    for w, n in zip(top["word"], n_top):
        tail_n[tail_class(w)] -= n
        tail_v[tail_class(w)] -= 1
    tail_total = tail_n + 0.5 * (tail_v + 1)
    member = np.full(HEAD, -1e9)
    member[: len(top)] = np.log(n_top + 0.5)
    member = member.reshape(HEAD_CLASSES, MEMBERS)
    head_mass = np.zeros(HEAD)
    head_mass[: len(top)] = n_top + 0.5
    mass = np.concatenate([head_mass.reshape(HEAD_CLASSES, MEMBERS).sum(1), tail_total])
    prior = np.where(mass > 0, np.log(np.maximum(mass, 1e-300) / mass.sum()), -1e9)
    rest = known[known["word"] != END]
    symbols = np.array([head.get(w, HEAD + tail_class(w)) for w in rest["word"]], np.int32)
    end_n = int(known.loc[known["word"] == END, "n"].sum())
    return Vocabulary(END.join(rest["word"]), rest["n"].to_numpy(np.int64), symbols, head.get(END, HEAD + tail_class(END)),
                      end_n, prior.astype(np.float32), member.astype(np.float32), tail_total, total, distinct)


class Reader:
    """Word -> place in the dictionary, or -1 - tail class for a word outside it."""

    def __init__(self, vocab: Vocabulary):
        self.words = vocab.words()
        self.heads = np.flatnonzero(vocab.symbols < HEAD)
        self.head_words = self.words.take(pa.array(self.heads))
        self.symbol_of = np.append(vocab.symbols, 0)

    def __getitem__(self, word: bytes) -> int:
        return int(self.places(keys_of(pa.array([word], pa.large_binary())))[0])

    def places(self, keys: pa.Array) -> np.ndarray:
        at = pc.index_in(keys, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        return np.where(at >= 0, at, -1 - tail_classes(keys))

    def block(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(keys of the different words, number of the word at each place, words of each text, place of each key)."""
        found, index, sizes = word_codes(texts)
        keys = keys_of(found)
        return keys, index, sizes, self.places(keys)

    def symbols(self, places: np.ndarray) -> np.ndarray:
        return np.where(places >= 0, self.symbol_of[np.maximum(places, 0)], HEAD - 1 - places).astype(np.int32)

    def symbols_of(self, keys: pa.Array) -> np.ndarray:
        """`symbols` of the `places`: all words but those with a symbol of their own have that of their tail class."""
        at = pc.index_in(keys, value_set=self.head_words).fill_null(-1).to_numpy()
        got = HEAD + tail_classes(keys)
        got[at >= 0] = self.symbol_of[self.heads[at[at >= 0]]]
        return got.astype(np.int32)


def ended(values: np.ndarray, sizes: np.ndarray, end) -> np.ndarray:
    """Values of all texts with one more for the end mark after each text."""
    return np.insert(values, np.cumsum(sizes), end)


def scramble(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint32) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    return x ^ (x >> np.uint32(13))


def contexts(y: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """[4, tokens] rows of the class table for the symbols of texts one after another."""
    into = np.arange(len(y)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # places into their own text
    back = []
    for k in (1, 2, 3):
        p = np.full(len(y), START, np.int32)
        p[k:] = np.where(into[k:] >= k, y[:-k], START)
        back.append(p)
    pair = scramble(back[0] * np.int32(SYMBOLS) + back[1]) % np.uint32(BUCKETS - 3 * SYMBOLS)
    return np.stack([back[0], back[1] + SYMBOLS, back[2] + 2 * SYMBOLS, pair.astype(np.int32) + 3 * SYMBOLS])


def member_rows(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rows of the member table for the nearest words' features in a class."""
    return (scramble(rows[[0, 1, 3]] * np.int32(CLASSES) + classes) % np.uint32(BUCKETS)).astype(np.int32)


def exponentials(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shifted exponentials, their sums by row, shift by row); only rows that leave the range of floats are shifted."""
    ones, shift = np.ones(z.shape[1], z.dtype), np.zeros(len(z), z.dtype)
    with np.errstate(over="ignore"):
        e = np.exp(z)
        s = e @ ones
    odd = np.flatnonzero(~((s > 1e-20) & (s < 1e30)))
    if len(odd):
        shift[odd] = z[odd].max(axis=1)
        e[odd] = np.exp(z[odd] - shift[odd, None])
        s[odd] = e[odd] @ ones
    return e, s, shift


def slices(n: int) -> Iterator[slice]:
    """Parts of rows that stay in the cache."""
    return (slice(i, i + GATHER) for i in range(0, n, GATHER))


def gathered(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the table's rows, for at most GATHER places."""
    sums = table.take(rows[0], axis=0, mode="clip")
    part = np.empty_like(sums)
    for r in rows[1:]:
        sums += np.take(table, r, axis=0, out=part, mode="clip")
    return sums


def log_sum(z: np.ndarray) -> np.ndarray:
    _, s, shift = exponentials(z)
    return shift + np.log(s)


def softmax(table: np.ndarray, rows: np.ndarray, prior: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
    """Probabilities under the rows' weights and the prior, or that of `which` row of it."""
    p = np.empty((rows.shape[1], table.shape[1]), table.dtype)
    for at in slices(len(p)):
        z = gathered(table, rows[:, at])
        z += prior if which is None else prior.take(which[at], axis=0)
        e, s, _ = exponentials(z)
        np.divide(e, s[:, None], out=p[at])
    return p


def log_probs(vocab: Vocabulary, tables: tuple[np.ndarray, np.ndarray], y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural log of P(class) and, for words of head classes, of P(word | class)."""
    out = np.empty(len(y))
    for at in slices(len(y)):
        ys, rs = y[at], rows[:, at]
        cls = np.where(ys < HEAD, ys // MEMBERS, ys - HEAD + HEAD_CLASSES)
        z = gathered(tables[0], rs)
        z += vocab.class_prior
        got = z[np.arange(len(ys)), cls] - log_sum(z)
        head = np.flatnonzero(ys < HEAD)
        c = cls[head]
        z = gathered(tables[1], member_rows(rs[:, head], c))
        z += vocab.member_prior.take(c, axis=0)
        got[head] += z[np.arange(len(head)), ys[head] % MEMBERS] - log_sum(z)
        out[at] = got
    return out


def summed(x: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the rows of `x` by runs of `order` (`n` from `first` on, longest run first): the k-th rows of all runs
    together, then the rest of the last few."""
    out = x.take(order[first], axis=0)
    runs = len(n) - np.cumsum(np.bincount(n))  # runs of more than k rows
    for k in range(1, int(n[0])):
        m = int(runs[k])
        if m <= FEW_RUNS:
            for i in range(m):
                out[i] += x.take(order[first[i] + k : first[i] + n[i]], axis=0).sum(axis=0)
            break
        out[:m] += x.take(order[first[:m] + k], axis=0)
    return out


def update(table: np.ndarray, squares: np.ndarray, seen: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """One adaptive step for every row of the features; the gradients of a row are summed first."""
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    at = flat[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(first, append=len(at))
    down = np.argsort(-n, kind="stable")
    first, n = first[down], n[down]
    g = summed(grad, order % len(grad), first, n)
    at = at[first].astype(np.intp)
    for part in slices(len(at)):
        some, step = at[part], g[part]
        square = squares.take(some, axis=0)
        square += step * step
        squares[some] = square
        step /= np.sqrt(square, out=square)
        step *= STEP
        weights = table.take(some, axis=0)
        weights -= step
        table[some] = weights
    seen[at] += n


class Learner:
    """A task's own copy of the weights."""

    def __init__(self, vocab: Vocabulary, tables: tuple[np.ndarray, np.ndarray]):
        self.vocab, self.start = vocab, tables
        self.tables = [t.copy() for t in tables]
        self.squares = [np.full_like(t, FIRST_SQUARE) for t in tables]
        self.seen = [np.zeros(BUCKETS, np.float32) for _ in tables]

    def learn(self, y: np.ndarray, rows: np.ndarray) -> None:
        for i in range(0, len(y), BATCH):
            ys, rs = y[i : i + BATCH], rows[:, i : i + BATCH].astype(np.int16)
            cls = np.where(ys < HEAD, ys // MEMBERS, ys - HEAD + HEAD_CLASSES)
            p = softmax(self.tables[0], rs, self.vocab.class_prior)
            p[np.arange(len(ys)), cls] -= 1
            update(self.tables[0], self.squares[0], self.seen[0], rs, p)  # no two features share a row
            head = np.flatnonzero(ys < HEAD)
            if len(head):
                c = cls[head]
                ms = member_rows(rs[:, head].astype(np.int32), c).astype(np.int16)
                p = softmax(self.tables[1], ms, self.vocab.member_prior, c)
                p[np.arange(len(head)), ys[head] % MEMBERS] -= 1
                for m in ms:  # rows that features share take a step for each
                    update(self.tables[1], self.squares[1], self.seen[1], m, p)

    def changes(self) -> Iterator[pa.RecordBatch]:
        """Changes of blocks of rows, each row weighted by the tokens that touched it."""
        for t in (0, 1):
            for b in range(0, BUCKETS, BLOCK_ROWS):
                n = self.seen[t][b : b + BLOCK_ROWS]
                if n.any():
                    d = (self.tables[t][b : b + BLOCK_ROWS] - self.start[t][b : b + BLOCK_ROWS]).astype(np.float16)
                    yield block(t, b, n, d)


def block(t: int, b: int, n: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([t], pa.int32()), pa.array([b], pa.int32()), pa.array([n.tobytes()], pa.binary()), pa.array([d.tobytes()], pa.binary())],
        ["t", "b", "n", "d"])


def averaged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums for the blocks that this task got: memory does not grow with the number of changes."""
    sums: dict[tuple[int, int], list] = {}
    for batch in it:
        for x in batch.to_pylist():
            n = np.frombuffer(x["n"], np.float32).astype(np.float64)
            d = np.frombuffer(x["d"], np.float16).reshape(len(n), -1) * n[:, None]
            got = sums.setdefault((x["t"], x["b"]), [0.0, 0.0])
            got[0], got[1] = got[0] + n, got[1] + d
    for (t, b), (n, d) in sums.items():
        yield block(t, b, n.astype(np.float32), (d / np.maximum(n, 1)[:, None]).astype(np.float16))


def train(rows: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights after `rounds` rounds; each round takes the texts of one part of the ids, and together all texts once."""
    sc = rows.sparkSession.sparkContext
    tables = (np.zeros((BUCKETS, CLASSES), np.float32), np.zeros((BUCKETS, MEMBERS), np.float32))
    sent = sc.broadcast(vocab.parts())
    for r in range(rounds):
        now = sc.broadcast(tables)

        def learn(it: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            v = Vocabulary(*sent.value)
            learner, reader = Learner(v, now.value), Reader(v)
            for batch in it:
                for part in text_blocks(batch.column("data"), LEARN_BYTES):
                    found, index, sizes = word_codes(part)
                    y = ended(reader.symbols_of(keys_of(found))[index], sizes, v.end_symbol)
                    learner.learn(y, contexts(y, sizes + 1))
            yield from learner.changes()

        part = rows.where(F.pmod(F.xxhash64(F.lit("round"), "id", F.length("data")), F.lit(rounds)) == r).select("data")
        ddl = "t int, b int, n binary, d binary"
        merged = part.mapInArrow(lambda it, learn=learn: tidy(learn(it)), ddl).repartition("t", "b").mapInArrow(averaged, ddl)
        tables = tuple(t.copy() for t in tables)
        for x in merged.toLocalIterator():  # two tables of fixed size
            d = np.frombuffer(x["d"], np.float16).reshape(BLOCK_ROWS, -1)
            tables[x["t"]][x["b"] : x["b"] + BLOCK_ROWS] += d
        now.unpersist()
    return tables


SCORED_DDL = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, tail array<binary>, times array<long>"


def rare_words(keys: pa.Array, index: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(words, times, ends of the texts' lists) of the words outside the dictionary, each once for a text."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    outside = places[index] < 0
    pairs, times = np.unique(owner[outside] * max(len(keys), 1) + index[outside], return_counts=True)
    ends = np.concatenate([[0], np.cumsum(np.bincount(pairs // max(len(keys), 1), minlength=len(sizes)))])
    return keys.take(pa.array(pairs % max(len(keys), 1))).cast(pa.binary()), pa.array(times, pa.int64()), pa.array(ends, pa.int32())


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows that are not held out and score all of them.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Scores are log10
    probabilities of the whole text and its end. A null or empty text is its end mark alone; null ids
    stay null; repeated rows are scored each, and learned from each. Without training rows all words
    are unseen. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), doc_bytes(F.col(text)).alias("data"), held_out.alias("held"))
    training = rows.where(~F.col("held"))
    counts = stored(count_words(training), "maxent-counts")
    vocab = vocabulary(counts)
    tables = train(training, vocab)
    sc = docs.sparkSession.sparkContext
    sent, weights = sc.broadcast(vocab.parts()), sc.broadcast(tables)

    def apply(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*sent.value)
        reader = Reader(v)
        base_total = np.log10(v.total + 0.5 * (v.distinct + 1))
        ln10 = np.log(10)
        log_count = np.log10(v.counts + 0.5) if len(v.counts) else np.zeros(1)
        tail_log = np.log10(v.tail_total)

        def scored(batch: pa.RecordBatch, part: pa.Array) -> pa.RecordBatch:
            keys, index, sizes, places = reader.block(part)
            y = ended(reader.symbols(places)[index], sizes, v.end_symbol)
            lengths = sizes + 1
            starts = np.cumsum(lengths) - lengths
            lp = log_probs(v, weights.value, y, contexts(y, lengths)) / ln10
            place = ended(places[index], sizes, -1)
            inside = place >= 0
            logs = np.where(inside, log_count[np.maximum(place, 0)], 0.0)
            logs[starts + sizes] = np.log10(v.end_count + 0.5)
            rare = y >= HEAD
            lp[rare] += logs[rare] - tail_log[y[rare] - HEAD]
            total = lambda x: np.add.reduceat(x, starts)
            tail, times, ends = rare_words(keys, index, sizes, places)
            return pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("held"), pa.array(lengths, pa.int64()),
                pa.array(total(inside.astype(np.int64)) + (v.end_count > 0), pa.int64()),
                pa.array(total(logs) - lengths * base_total, pa.float64()), pa.array(total(lp), pa.float64()),
                pa.ListArray.from_arrays(ends, tail), pa.ListArray.from_arrays(ends, times),
            ], ["doc_id", "held_out", "n_tokens", "known", "base", "score", "tail", "times"])

        for batch in it:
            at = 0
            for part in text_blocks(batch.column("data"), LEARN_BYTES):
                yield scored(batch.slice(at, len(part)), part)
                at += len(part)

    got = rows.mapInArrow(lambda it: tidy(apply(it)), SCORED_DDL).withColumn("row", F.monotonically_increasing_id())
    got = stored(got, "maxent-scored")
    rare = got.select("row", F.explode(F.arrays_zip("tail", "times")).alias("w")).select("row", F.col("w.tail").alias("word"), F.col("w.times").alias("times"))
    c = F.coalesce(F.col("n"), F.lit(0))
    # once for each text and word; a word that training lacks may still be frequent in the other texts
    extra = skew.skewed_lookup(rare, counts, "word", "row").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"))
    more = F.coalesce(F.col("more"), F.lit(0.0))
    return got.drop("tail", "times").join(extra, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce(F.col("more_known"), F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )

