"""Quality classifier: naive Bayes features in a linear support vector machine.

Features are indicators of hashed n-grams of words and of word shapes. Each is scaled by the log
ratio of its smoothed shares in the two classes, counted over all training rows. A hinge-loss model is
fitted to the scaled rows by dual coordinate descent on a bounded sample of the training rows. A logistic
curve turns margins into scores; it is fitted on all training rows in folds, each scored by a model that
has not seen the fold, at every size of the data.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext import session
from loomtext.llm.common import discard, doc_bytes, lookup, mix64, stored, tidy, written

BITS = 18
ALPHA = 1.0
COST = 1.0
EPOCHS = 8
#: The fit takes at most this many rows, those of the smallest hashes of their ids, and this many features.
MAX_FIT_ROWS = 20_000
MAX_FIT_FEATURES = 20_000_000
#: Folds for the logistic curve, and the bins of their margins.
FOLDS, BIN = 5, 0.05
MAX_MARGIN = 20.0

TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[!-/:-@\[-^`{-~]+")
LOWER, TITLE, UPPER, DIGITS, MARKS, SAME = range(6)


def shape_of(token: bytes) -> int:
    if not (token[:1].isalnum() or token[0] >= 0x80 or token[0] == 0x5F):
        return MARKS
    if token.isdigit():
        return DIGITS
    if token.isupper() and len(token) > 1:
        return UPPER
    return TITLE if token[:1].isupper() else LOWER


class TokenHash(dict):
    """Token -> hash of its lower-case form, with its shape in the last three bits."""

    def __missing__(self, token: bytes) -> int:
        h = zlib.crc32(token.lower()) << 3 | shape_of(token)
        if len(self) >= 300_000:
            self.clear()
        if len(token) <= 64:
            self[token] = h
        return h


def grams(x: np.ndarray, sizes: range, salt: int) -> list[np.ndarray]:
    """Hashes of the runs of the given lengths."""
    out, h = [], np.full(len(x) + 1, salt, np.uint64)
    for n in range(1, sizes.stop):
        h = mix64(h[: max(0, len(x) - n + 1)] * np.uint64(0x9E3779B97F4A7C15) + x[n - 1 :]) if n <= len(x) else x[:0]
        if n in sizes:
            out.append(h)
    return out


def features(data: bytes, hashes: TokenHash) -> np.ndarray:
    """Sorted distinct buckets of a text's n-grams; none for a text without words.

    Uni- and bigrams of lower-case words, and uni- to trigrams of shapes: how a word is capitalised,
    whether it repeats the one before it, and runs of marks as they are.
    """
    tokens = TOKEN.findall(data)
    both = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    word, shape = both >> np.uint64(3), both & np.uint64(7)
    again = np.zeros(len(word), bool)
    again[1:] = word[1:] == word[:-1]
    shape = np.where(shape == MARKS, both, np.where(again, np.uint64(SAME), shape))
    all_grams = grams(word, range(1, 3), 1) + grams(shape, range(1, 4), 2)
    return np.unique((np.concatenate(all_grams) >> np.uint64(64 - BITS)).astype(np.int32))


@dataclass
class Model:
    weights: np.ndarray  # class log ratio times fitted weight, one for each bucket
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def score(self, f: np.ndarray) -> float:
        return float(squashed(self.slope * margin(f, self.weights, self.bias) + self.shift))


def margin(f: np.ndarray, weights: np.ndarray, bias: float) -> float:
    """Scaled rows have unit length, so long texts do not weigh more than short ones."""
    return bias + (float(weights[f].sum()) / np.sqrt(len(f)) if len(f) else 0.0)


def squashed(z: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights of the scaled indicators, and a bias, that minimise |w|^2 / 2 + sum of c_y * hinge loss.

    One dual variable per row; each step solves for one of them exactly and moves the weights along.
    Both classes have the same total cost. The scaled values are made anew in each step: kept, they would
    take twice the memory of the rows.
    """
    def scaled(f: np.ndarray) -> np.ndarray:
        return ratio.take(f) / np.sqrt(max(1, len(f)))

    n = len(rows)
    share = np.array([max(1, (labels < 0).sum()), max(1, (labels > 0).sum())])
    upper = cost * n / 2 / share[(labels > 0).astype(int)]
    w, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(n)
    square = np.array([float(v @ v) for v in map(scaled, rows)]) + 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(n):
            f, y = rows[i].astype(np.intp), labels[i]
            v = scaled(f)
            g = y * (float(w.take(f) @ v) + bias) - 1
            new = min(max(dual[i] - g / square[i], 0.0), upper[i])
            if new != dual[i]:
                step = (new - dual[i]) * y
                dual[i] = new
                w[f] += step * v
                bias += step
    return w, bias


def logistic(margins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve through binned margins: Newton steps, with smoothed targets."""
    n1, n0 = good.sum(), bad.sum()
    if not n1 or not n0:
        return 1.0, 0.0
    hi, lo = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    a, b, n, t = 1.0, 0.0, good + bad, good * hi + bad * lo
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        d, h = t - n * p, n * p * (1 - p) + 1e-9
        m = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum()]])
        step = np.linalg.solve(m, [(d * margins).sum() - 1e-3 * (a - 1), d.sum()])
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-3), float(b)


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """(id, data, y): documents that have a label; an id with several labels takes their majority, ties good."""
    y = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("id")).agg(
        F.when(F.avg(F.col(label).cast("double")) >= 0.5, 1).otherwise(0).alias("y"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), doc_bytes(F.col(text)).alias("data"))
    return lookup(rows, stored(y, "nbsvm-labels"), "id", "data").where("y is not null")


def count_features(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each class that have each bucket, summed in tasks and then by Spark; 2^18 rows at most come back."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in it:
            for f, y in zip(batch.column("f"), batch.column("y")):
                total[y.as_py()][np.frombuffer(f.as_py(), np.int32)] += 1
        at = np.flatnonzero(total.any(axis=0))
        for part in np.array_split(at, max(1, len(at) // 65_536)):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[0, part]), pa.array(total[1, part])], ["b", "n0", "n1"])

    sums = train.mapInArrow(lambda it: tidy(count(it)), "b long, n0 long, n1 long").groupBy("b").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = sums.toArrow().to_pandas()
    n = np.zeros((2, 1 << BITS))
    n[0, got["b"].to_numpy(int)], n[1, got["b"].to_numpy(int)] = got["n0"], got["n1"]
    return n[0], n[1]


def log_ratio(bad: np.ndarray, good: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    p, q = good + alpha, bad + alpha
    return np.log((p / p.sum()) / (q / q.sum()))


def first_rows(train: DataFrame, n: int, most: int) -> DataFrame:
    """At most `most` of the `n` rows, those of the smallest keys; they are chosen without their features."""
    kept = min(1.0, 1.3 * most / n)  # of the keys: so that few rows are sorted
    near = train.where(F.col("key").cast("double") <= (kept - 0.5) * 2.0**64)
    first = near.select("key", "id", "y", "tie", "row").orderBy("key", "id", "y", "tie", "row").limit(most)
    return near.join(F.broadcast(first.select("row")), "row", "left_semi")


def fitted(sample: DataFrame, ratio: np.ndarray, max_features: int) -> dict[int, tuple[np.ndarray, float]]:
    """Weights and bias of a fit without each fold that leaves rows, and (number FOLDS) of one with all.

    The sample comes to one task, in batches, and is there once: all fits read it in place, one after the other.
    """
    def descend(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, rest = [], []
        for batch in it:
            xs += [np.frombuffer(f.as_buffer(), np.int32) for f in batch.column("f")]
            rest.append(np.array([batch.column(c).to_numpy() for c in ("tie", "y", "key", "fold")], np.int64))
        if not xs:
            return
        tie, y, key, fold = np.concatenate(rest, axis=1)
        order = np.lexsort([tie, y, key])
        for without in range(FOLDS + 1):
            at = order[fold[order] != without]
            if not len(at):
                continue
            at = at[: np.searchsorted(np.cumsum([len(xs[i]) for i in at]), max_features, "right")]
            w, bias = dual_coordinate_descent([xs[i] for i in at], y[at] * 2.0 - 1, ratio)
            yield pa.RecordBatch.from_arrays([pa.array([without]), pa.array([w.tobytes()], pa.binary()), pa.array([bias])], ["without", "w", "bias"])

    got = sample.select("f", "tie", "y", "key", "fold").repartition(1).mapInArrow(
        lambda it: tidy(descend(it)), "without long, w binary, bias double").collect()
    return {r["without"]: (np.frombuffer(r["w"]) * ratio, r["bias"]) for r in got}


def binned_margins(train: DataFrame, fits: dict[int, tuple[np.ndarray, float]]) -> pd.DataFrame:
    """Rows of each class by bin of the margin that the fit without their fold gives them; 801 bins at most."""
    sent = train.sparkSession.sparkContext.broadcast(fits)

    def margins(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            known = [margin(np.frombuffer(f.as_py(), np.int32), *sent.value[k]) for k, f in zip(batch.column("fold").to_pylist(), batch.column("f"))]
            bins = np.rint(np.clip(known, -MAX_MARGIN, MAX_MARGIN) / BIN).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], ["bin", "y"])

    asked = train.where(F.col("fold").isin(list(fits))).select("fold", "f", "y")  # a fold is left out if no row lies outside of it
    return asked.mapInArrow(lambda it: tidy(margins(it)), "bin long, y int").groupBy("bin").agg(
        F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad")).toArrow().to_pandas()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_FIT_ROWS, max_features: int = MAX_FIT_FEATURES) -> Model:
    """Model of label 1 against label 0.

    Class ratios and the logistic curve take all training rows; the coordinate descent takes at most
    `max_rows` rows, in the order of the hash of their ids, and stops before the first that exceeds
    `max_features` features. The curve's margins come from `FOLDS` further models, each fitted without a fold of
    the same rows and asked for that fold of all rows. With one class only, or no labelled row, every
    score is the share of label 1 (0.5 without labels).
    """
    def featurise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHash()
        for batch in it:
            f = [features(x.as_py(), hashes).tobytes() for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(f, pa.binary())], ["id", "y", "f"])

    mark = written()
    rows = training_rows(docs, labels, doc_id, text, label)
    with session.text_batches(docs.sparkSession):
        found = rows.mapInArrow(lambda it: tidy(featurise(it)), "id long, y int, f binary")
        train = stored(found.withColumns({"tie": F.xxhash64("f"), "row": F.monotonically_increasing_id()}), "nbsvm-train")
        classes = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(classes) < 2:
            share = 0.5 if not classes else (classes.get(1, 0) + 1) / (sum(classes.values()) + 2)
            return Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
        ratio = log_ratio(*count_features(train))
        train = train.withColumns({"key": F.xxhash64(F.lit("fit"), "id"), "fold": F.pmod(F.xxhash64(F.lit("curve"), "id"), F.lit(FOLDS)).cast("int")})
        fits = fitted(first_rows(train, sum(classes.values()), max_rows), ratio, max_features)
        weights, bias = fits.pop(FOLDS)
        curve = binned_margins(train, fits)
    discard(docs.sparkSession, mark)
    slope, shift = logistic(curve["bin"].to_numpy(float) * BIN, curve["good"].to_numpy(float), curve["bad"].to_numpy(float))
    return Model(weights, bias, slope, shift)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """(`_row`, `score`): each row as a struct and its score between 0 and 1.

    A null text is empty; a text without words has the score of the bias alone. The rows keep all
    their columns, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.slope, model.shift))
    at = docs.columns.index(text)

    def apply(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (weights, bias, slope, shift) = TokenHash(), sent.value
        for batch in it:
            texts = batch.column(0).field(at).cast(pa.binary())
            m = np.array([margin(features(x.as_py() or b"", hashes), weights, bias) for x in texts], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(squashed(slope * m + shift), pa.float64())], ["_row", into])

    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    schema = T.StructType([*out.schema, T.StructField(into, T.DoubleType())])
    return out.mapInArrow(lambda it: tidy(apply(it)), schema)
