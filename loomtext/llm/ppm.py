"""Language identification by prediction by partial matching: the language whose statistics code a text shortest.

For each language a byte context tree of depth `DEPTH` counts which byte follows the last bytes. A
byte that a context has seen is coded from its counts; else an escape is coded (as often as there
are different bytes in the context) and the context shortened, without the bytes that the longer
one has ruled out. In the end all bytes left are equally likely, so the chances of the 256 bytes
after any context sum to one and code lengths are exact. The statistics are frozen: a text is scored
against the counts of the training texts only.

The counts are stored by byte strings of the longest context and the byte after it; those of shorter
contexts are sums over them. Texts are padded in front, so every byte has a context of full length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.common import doc_bytes, mix64

#: Bytes of the longest context.
DEPTH = 4
#: The classifier is fitted on a sample: whole texts in the order of a hash, up to so many bytes of each
#: language, and so many of all languages together. At most as many byte strings are counted.
LANGUAGE_BYTES, SAMPLE_BYTES = 1_000_000, 16_000_000
#: Bytes scored at a time.
BLOCK_BYTES = 2_000_000
UNKNOWN = "und"
LETTER = r"\p{L}"


def strings_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each byte the number of the DEPTH bytes before it (256 and more before a text) and itself, 9 bits each.

    `data` holds texts one after another, which start at `starts`.
    """
    out = data.astype(np.uint64)
    for k in range(1, DEPTH + 1):
        before = np.zeros(len(data), np.uint64)
        before[k:] = data[:-k]
        for j in range(k):
            at = starts + j  # beyond a short text this is a place of the next one that is padded all the same
            before[at[at < len(data)]] = 256
        out |= before << np.uint64(9 * k)
    return out


def folded(text: bytes) -> np.ndarray:
    """The bytes that are coded: A-Z lower-cased, white space as one blank."""
    return np.frombuffer(b" ".join(text.lower().split()), np.uint8)


class Table:
    """Numbers of 64-bit keys by open addressing: a lookup of many keys touches each place once or twice."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(keys) * 2).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), np.iinfo(np.uint64).max, np.uint64)
        self.rows = np.full(len(self.keys), -1, np.int32)
        left, at = np.arange(len(keys)), self.place(keys)
        while len(left):
            free = np.flatnonzero(self.rows[at] < 0)
            self.rows[at[free]] = left[free]  # of several keys the last one stays
            won = self.rows[at] == left
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + 1) % len(self.keys)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        at = self.place(keys)
        out = np.where(self.keys[at] == keys, self.rows[at], -1)
        left = np.flatnonzero((out < 0) & (self.rows[at] >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) % len(self.keys)
            hit = self.keys[at] == keys[left]
            out[left[hit]] = self.rows[at[hit]]
            more = ~hit & (self.rows[at] >= 0)
            left, at = left[more], at[more]
        return out


def grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows of values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first, axis=0)


class Trees:
    """The context trees of all languages: per order the counts of byte strings, and what each context rules out below."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray):
        """`strings` are distinct; `counts` has a row for each and a column for each language."""
        self.orders = []
        for k in range(DEPTH + 1):
            low = np.uint64((1 << 9 * (k + 1)) - 1)
            seen, n = grouped(strings & low, counts)
            contexts, totals = grouped(seen >> np.uint64(9), n)
            _, kinds = grouped(seen >> np.uint64(9), (n > 0).astype(np.int64))
            order = {"strings": Table(seen), "n": n, "contexts": Table(contexts), "weight": totals + kinds, "escape": kinds}
            if k:  # what is left of the next shorter context when the bytes of this one are ruled out
                below = self.orders[-1]
                inner = below["n"][below["strings"].find(seen & (low >> np.uint64(9)))] * (n > 0)
                _, gone = grouped(seen >> np.uint64(9), inner)
                under = below["contexts"].find(contexts & (low >> np.uint64(18)))
                order["escape_below"] = below["escape"][under] - kinds
                order["weight_below"] = below["weight"][under] - gone - kinds
            self.orders.append(order)
        self.strings = Table(strings)
        self.known = self.cost(strings)

    def cost(self, strings: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each string after the bytes before it, a column for each language."""
        n_languages = self.orders[0]["n"].shape[1]
        bits = np.zeros((len(strings), n_languages))
        done = np.zeros(bits.shape, bool)
        longer: tuple[dict, np.ndarray] | None = None
        for k in range(DEPTH, -1, -1):
            order, low = self.orders[k], np.uint64((1 << 9 * (k + 1)) - 1)
            context = order["contexts"].find((strings & low) >> np.uint64(9))
            at = np.flatnonzero(context >= 0)
            c = context[at]
            escape, weight = order["escape"][c], order["weight"][c]
            if longer:
                above, up = longer[0], longer[1][at]
                ruled = above["escape"][np.maximum(up, 0)] * (up >= 0)[:, None] > 0  # the longer context is known to the language
                escape = np.where(ruled, above["escape_below"][np.maximum(up, 0)], escape)
                weight = np.where(ruled, above["weight_below"][np.maximum(up, 0)], weight)
            string = order["strings"].find(strings[at] & low)
            n = order["n"][np.maximum(string, 0)] * (string >= 0)[:, None]
            todo = ~done[at]
            with np.errstate(divide="ignore", invalid="ignore"):
                coded = np.where(n > 0, np.log2(weight / n), np.where(escape > 0, np.log2(weight / escape), 0.0))
            bits[at] += np.where(todo & (weight > 0), coded, 0.0)
            done[at] |= n > 0
            longer = (order, context)
        left = 256 - self.orders[0]["escape"][0]
        return bits + np.where(done, 0.0, np.log2(np.maximum(left, 1)))

    def lengths(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bits of each text, a column for each language. The texts stand in `data` one after another."""
        starts = np.cumsum(sizes) - sizes
        out = np.zeros((len(sizes), self.known.shape[1]))
        some = np.flatnonzero(sizes)
        if not len(some):
            return out
        strings = strings_of(data, starts[some])
        row = self.strings.find(strings)
        bits = self.known[row]
        new, back = np.unique(strings[row < 0], return_inverse=True)
        bits[row < 0] = self.cost(new)[back]
        out[some] = np.add.reduceat(bits, starts[some], axis=0)
        return out


def blocks(texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, sizes) of texts in turn, up to BLOCK_BYTES or one text at a time."""
    parts, size = [], 0
    for text in texts:
        part = folded(text)
        if parts and size + len(part) > BLOCK_BYTES:
            yield np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
            parts, size = [], 0
        parts.append(part)
        size += len(part)
    if parts:
        yield np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def sample(rows: DataFrame, sizes: dict[str, int], language_bytes: int) -> DataFrame:
    """lang, data: of each language the rows in the order of a hash until they have the given number of bytes.

    A language that has more is thinned out first, by a share of all hash values that leaves twice
    as much, so that no window sorts more than a few times the bound.
    """
    share = {name: min(1.0, 2.0 * language_bytes / size) for name, size in sizes.items()}
    shares = F.broadcast(rows.sparkSession.createDataFrame(list(share.items()), "lang string, _share double"))
    hashed = rows.withColumn("_h", F.shiftrightunsigned(F.xxhash64("id", "data"), 2)).join(shares, "lang")
    thin = hashed.where(F.col("_h") <= F.col("_share") * F.lit(float(1 << 62)))
    so_far = Window.partitionBy("lang").orderBy("_h", "data").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("data")).over(so_far), F.lit(0))
    return thin.withColumn("_before", before).where(F.col("_before") < language_bytes).select("lang", "data")


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", language_bytes: int = LANGUAGE_BYTES,
        sample_bytes: int = SAMPLE_BYTES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, byte strings, counts) from a sample of the rows of each language; rows without a language are not used.

    The sample of a language is at most `language_bytes` and its share of `sample_bytes`, plus the
    last text. The id only spreads copies of a text over the hash that orders the sample.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"),
                       doc_bytes(F.col(f"`{text}`")).alias("data")).where("lang is not null and length(data) > 0")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.length("data")).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros(0, np.uint64), np.zeros((0, 0), np.int64)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            names = batch.column(0).to_pylist()
            for name in sorted(set(names)):
                own = (d.as_py() for n, d in zip(names, batch.column(1)) if n == name)
                for data, sizes in blocks(own):
                    starts = np.cumsum(sizes) - sizes
                    found, n = np.unique(strings_of(data, starts[sizes > 0]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(found)), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "string", "n"])

    bound = min(language_bytes, sample_bytes // len(languages))
    counted = sample(rows, sizes, bound).mapInArrow(count, "lang string, string long, n long")
    got = counted.groupBy("string", "lang").agg(F.sum("n").alias("n")).toArrow()
    strings, at = np.unique(got["string"].to_numpy().astype(np.uint64), return_inverse=True)
    counts = np.zeros((len(strings), len(languages)), np.int64)
    column = got["lang"].combine_chunks().dictionary_encode()
    place = np.array([languages.index(x) for x in column.dictionary.to_pylist()], np.int64)
    counts[at, place[column.indices.to_numpy()]] = got["n"].to_numpy()
    return languages, strings, counts


def posterior(bits: np.ndarray) -> np.ndarray:
    """Chances of the languages of each text, all equally likely beforehand."""
    chance = np.exp2(bits.min(axis=1, keepdims=True) - bits)
    return chance / chance.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: list[str], text: str = "text") -> DataFrame:
    """`_row` (the columns `keep`), lang_pred, score, bits_per_byte (of the language predicted).

    `score` is the chance of the predicted language if all are equally likely beforehand; of equally
    short codes the first language by name wins. A null text, one without a letter, and any text if
    nothing was learned, is `und` with score 0 and no bits. Repeated rows are predicted each; columns
    not in `keep` are not read.
    """
    languages, strings, counts = model
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(row, F.when(body.rlike(LETTER), body.cast("binary")).alias("_data"))
    sent = docs.sparkSession.sparkContext.broadcast((languages, strings, counts))
    out = f"_row {rows.schema['_row'].dataType.simpleString()}, lang_pred string, score double, bits_per_byte double"

    def map_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, strings, counts = sent.value
        trees = Trees(strings, counts) if names else None
        for batch in it:
            have = np.flatnonzero(~batch.column(1).is_null().to_numpy(zero_copy_only=False)) if trees else np.zeros(0, np.int64)
            lang, score, rate = [UNKNOWN] * len(batch), np.zeros(len(batch)), [None] * len(batch)
            done = 0
            for data, sizes in blocks(batch.column(1)[i].as_py() for i in have.tolist()):
                bits = trees.lengths(data, sizes)
                best, chance = bits.argmin(axis=1), posterior(bits).max(axis=1)
                for i, b, p, length, size in zip(have[done:].tolist(), best.tolist(), chance, bits.min(axis=1), sizes.tolist()):
                    lang[i], score[i], rate[i] = names[b], p, float(length) / max(size, 1)
                done += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rate, pa.float64())],
                schema=pa.schema([batch.schema.field(0), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]))

    return rows.mapInArrow(map_batches, out)
