"""Near duplicates by SetSketch registers.

A document is the set of its word shingles. Its sketch has one register per hash function: the
exponentially spaced, truncated minimum of the hashes of the set, so the sketch of a union is the
register-wise maximum, and registers of two sets agree about as often as their Jaccard similarity.
Bands of registers propose pairs. Documents with equal sets are one class, and the work goes on with
one representative each.

In a bucket of a band, every member is first compared with one centre, which takes as many pairs as
members. Members of a bucket that are then still in different components are compared in blocks, all
pairs across components. Either way the joint likelihood of both sketches estimates the similarity
first; only members of pairs that may reach the threshold bring their full sets, on which those pairs
are checked inside the task, and only links are returned. So no pair list of a bucket is ever
written, and every candidate pair is decided: by its estimate, by a check, or because its two
documents are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext import session
from loomtext.llm.common import WordHash, discard, doc_bytes, lookup, mix64, stored, tidy, words, written
from loomtext.llm.components import components

SHINGLE = 5
REGISTERS = 128
#: Steps of the registers (two bytes each): so fine that unrelated sets of one size agree on a register once in 400
#: times, so that a bucket holds hardly any of them and candidates don't grow with the square of the documents.
BASE, RATE, TOP = 1.01, 20.0, 65_535
REGISTER = np.dtype("<u2")
#: A pair at the threshold is missed by all bands with at most this probability.
MISS = 1e-6
#: Standard deviations that the estimate may lie below the threshold before a pair is ruled out.
DEVIATIONS = 5.0
#: Members and bytes of full sets in a block: one task compares two blocks.
BLOCK_ROWS, BLOCK_BYTES = 2048, 16 << 20
PAIRS = 4096  # compared at a time

_rng = np.random.default_rng(90210)
MULTIPLIERS = _rng.integers(0, 2**63, REGISTERS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _rng.integers(0, 2**63, REGISTERS, np.int64).astype(np.uint64)


def band_rows(threshold: float, registers: int = REGISTERS, miss: float = MISS) -> int:
    """Registers per band: as many as keep the chance of missing a pair at the threshold below `miss`."""
    fits = [r for r in range(1, 17) if (1 - threshold**r) ** (registers // r) <= miss]
    return max(fits, default=1)


def shingles(data: bytes, hashes: WordHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than one shingle are one shingle together."""
    h = hashes.of(words(data))
    if not len(h):
        return h
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)])
    return np.unique(out)


def registers(s: np.ndarray) -> np.ndarray:
    """The sketch of a set: one number per hash function. All zero for the empty set."""
    low = np.full(REGISTERS, 2**64 - 1, np.uint64)
    for i in range(0, len(s), 256):
        low = np.minimum(low, (s[i : i + 256, None] * MULTIPLIERS + SHIFTS).min(axis=0))
    if not len(s):
        return np.zeros(REGISTERS, REGISTER)
    u = (low.astype(np.float64) + 1) / 2.0**64
    h = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, TOP).astype(REGISTER)


def merge(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(x, y)


def below(x: np.ndarray) -> np.ndarray:
    """Probability that a register of one set exceeds the other's, as the joint model has it."""
    return -np.log(1 - np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimate(more: np.ndarray, less: np.ndarray, n1: np.ndarray, n2: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Jaccard similarity of largest joint likelihood, from how many registers are larger and smaller."""
    more, less = np.asarray(more, float), np.asarray(less, float)
    u = n1 / (n1 + n2)
    v = 1 - u
    lo, hi = np.zeros(len(more)), np.minimum(u / v, v / u)

    def likelihood(j):
        p, q = below(u - v * j), below(v - u * j)
        tiny = 1e-12
        return more * np.log(p + tiny) + less * np.log(q + tiny) + (m - more - less) * np.log(np.maximum(1 - p - q, tiny))

    g = (np.sqrt(5) - 1) / 2
    for _ in range(25):  # golden section: the likelihood has one peak
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        left = likelihood(a) >= likelihood(b)
        hi, lo = np.where(left, b, hi), np.where(left, lo, a)
    return (lo + hi) / 2


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """den * |intersection| >= num * |union|, on full sets."""
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


def sketch_table(rows: DataFrame) -> DataFrame:
    """(row, id, n, whole, regs): `whole` is a 128-bit hash of the full set."""
    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = WordHash()
        for batch in it:
            n, whole, regs = [], [], []
            for data in batch.column("data"):
                s = shingles(data.as_py(), hashes)
                n.append(len(s))
                whole.append(xxhash.xxh3_128_digest(s.tobytes()))
                regs.append(registers(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), pa.array(whole, pa.binary()), pa.array(regs, pa.binary())],
                ["row", "id", "n", "whole", "regs"])

    with session.text_batches(rows.sparkSession):
        return stored(rows.mapInArrow(lambda it: tidy(sketch(it)), "row long, id long, n long, whole binary, regs binary"), "sketches")


def numbered(docs: DataFrame, doc_id: str, text: str, row: str | None = None) -> DataFrame:
    """(row, id, data): numbered and written once, as a later scan may be split otherwise, or by the stored numbers `row`."""
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(number.alias("row"), F.col(doc_id).cast("long").alias("id"), doc_bytes(F.col(text)).alias("data"))
    return stored(rows, "numbered") if row is None else rows


def sets_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, s): the full sets of the given nodes, made anew from their texts."""
    wanted = stored(nodes.select(F.col("node").alias("row"), F.lit(True).alias("wanted")), "nodes")

    def make(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in it:
            s = [shingles(x.as_py(), hashes).tobytes() for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(s, pa.binary())], ["node", "s"])

    chosen = lookup(rows.select("row", "data"), wanted, "row", "data").where("wanted").select("row", "data")
    with session.text_batches(rows.sparkSession):
        return stored(chosen.mapInArrow(lambda it: tidy(make(it)), "node long, s binary"), "sets")


def may_link(x: np.ndarray, y: np.ndarray, n1: np.ndarray, n2: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(may reach num / den, estimate) of pairs of sketches [pairs, registers] with set sizes."""
    t = num / den
    least = t - DEVIATIONS * np.sqrt(t * (1 - t) / REGISTERS)
    ok = np.minimum(n1, n2) >= t * np.maximum(n1, n2) * (1 - 1e-12)
    e = np.zeros(len(ok))
    if ok.any():
        e[ok] = estimate((x[ok] > y[ok]).sum(1), (x[ok] < y[ok]).sum(1), n1[ok], n2[ok])
    return ok & (e >= least), e


def star_links(buckets: DataFrame, members: DataFrame, reps: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of a bucket and its centre."""
    pairs = members.join(buckets.select("key", "centre"), "key").where("node != centre")
    pairs = pairs.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    sketch = lambda node, n, regs: reps.select(F.col("node").alias(node), F.col("n").alias(n), F.col("regs").alias(regs))

    def likely(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), REGISTER).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            n1, n2 = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            yield batch.select(["a", "b"]).filter(pa.array(may_link(x, y, n1, n2, num, den)[0], pa.bool_()))

    sketched = pairs.join(sketch("a", "na", "ra"), "a").join(sketch("b", "nb", "rb"), "b").select("a", "b", "na", "nb", "ra", "rb")
    pairs = stored(sketched.mapInArrow(likely, "a long, b long"), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets_of(rows, nodes)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), num, den)
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with session.text_batches(rows.sparkSession):
        return stored(both.select("a", "b", "x", "y").mapInArrow(lambda it: tidy(check(it)), "a long, b long"), "links")


def block_pairs(p: pd.DataFrame, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(estimate, place, place) of the pairs across components that may be links, in one block or between two."""
    i, j = int(p["i"].iat[0]), int(p["j"].iat[0])
    regs = np.frombuffer(b"".join(p["regs"]), REGISTER).reshape(len(p), -1)
    n, side, label = p["n"].to_numpy(float), p["own"].to_numpy(), p["label"].to_numpy()
    left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
    step = PAIRS // max(1, len(right)) + 1
    found = [(np.zeros(0), left[:0], left[:0])]
    for at in range(0, len(left), step):
        x, y = (g.ravel() for g in np.meshgrid(left[at : at + step], right, indexing="ij"))
        ok = (label[x] != label[y]) & ((x < y) if i == j else True)
        x, y = x[ok], y[ok]
        ok, e = may_link(regs[x], regs[y], n[x], n[y], num, den)
        found.append((e[ok], x[ok], y[ok]))
    return tuple(np.concatenate(c) for c in zip(*found))


def block_members(p: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """The rows of a pair of blocks that are in any pair that may be a link."""
    _, x, y = block_pairs(p, num, den)
    return p.iloc[np.union1d(x, y)][["key", "node", "label", "own", "i", "j"]]


def block_links(p: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links across components among the members of one block, or between those of two blocks."""
    node, label = p["node"].to_numpy(), p["label"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in p["s"]]
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    likely, ones, others = block_pairs(p, num, den)
    for k in np.argsort(-likely, kind="stable"):
        x, y = find(label[ones[k]]), find(label[others[k]])
        if x != y and linked(sets[ones[k]], sets[others[k]], num, den):
            root[max(x, y)] = min(x, y)
            out.append((node[ones[k]], node[others[k]]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def rest_links(buckets: DataFrame, members: DataFrame, reps: DataFrame, rows: DataFrame, found: DataFrame,
               num: int, den: int) -> DataFrame:
    """Links between members of a bucket that the stars left in different components.

    Pairs with the centre are decided, so the centre is left out; buckets with the same members are
    worked on once.
    """
    comp = stored(components(found), "comp")
    named = members.drop("n").join(buckets, "key").where("node != centre and size > 2").join(comp, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    named = stored(named, "named")
    alike = ["x", "y", "n", "lo", "hi"]  # of the same members with all but certainty
    open_ = named.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit("y"), "node")).alias("y"))
    open_ = open_.where("lo != hi").groupBy(*alike).agg(F.min("key").alias("key")).select("key")
    rest = named.join(open_, "key")
    n_blocks = F.ceil(F.greatest(F.col("size") / BLOCK_ROWS, F.col("elements") * 8 / BLOCK_BYTES)).cast("int")
    rest = rest.withColumn("own", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    rest = rest.select("key", "node", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    sketches = reps.select("node", "n", "regs")
    cells = rest.join(sketches, "node").groupBy("key", "i", "j")
    rest = stored(cells.applyInPandas(lambda p: block_members(p, num, den), "key long, node long, label long, own int, i int, j int"), "rest")
    full = rest.join(sketches, "node").join(sets_of(rows, rest.select("node").distinct()), "node")
    return full.groupBy("key", "i", "j").applyInPandas(lambda p: block_links(p, num, den), "a long, b long")


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text",
                    row: str | None = None) -> DataFrame:
    """(row, id, n_shingles, component_id, kept) for every row; documents are linked if their sets'
    Jaccard similarity is at least num / den, checked on full sets.

    A-Z are lower-cased, words are cut at ASCII white space. Documents without words are linked with
    nothing. Repeated rows are copies of each other. `component_id` is the smallest id of the
    component; `kept` says whether the row's id is that one. Null ids are no candidates for it; in a
    component without any id it is null, and its rows are kept. Texts of any length are taken whole;
    an empty table gives no rows. `docs` is read once and its rows are numbered then; with `row`, the
    name of a column of stored numbers, one for each row, it is read again and these are used.
    """
    rows = numbered(docs, doc_id, text, row)
    mark = written()
    table = sketch_table(rows)
    reps = stored(table.where("n > 0").groupBy("whole").agg(
        F.min("row").alias("node"), F.min("id").alias("least"), F.max("n").alias("n"), F.max("regs").alias("regs"),
        F.count(F.lit(1)).alias("copies")), "reps")
    r = band_rows(num / den)
    band = F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // r - 1))).alias("band")
    members = reps.select("node", "n", "regs", band)
    members = members.select(F.xxhash64("band", F.substring("regs", F.col("band") * (r * REGISTER.itemsize) + 1, F.lit(r * REGISTER.itemsize))).alias("key"), "node", "n")
    buckets = members.groupBy("key").agg(
        F.min("node").alias("centre"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements")).where("size > 1")
    buckets = stored(buckets, "buckets")
    links = star_links(buckets, members, reps, rows, num, den)
    more = rest_links(buckets, members, reps, rows, links, num, den)
    comp = stored(components(links.unionAll(more)), "comp")
    ids = reps.where("copies > 1").select("node", "whole", "least").unionAll(
        reps.where("copies = 1").select("node", "whole", "least").join(comp.select("node"), "node"))
    named = stored(ids.join(comp, "node", "left").withColumn("label", F.coalesce("label", "node")), "classes")
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    classes = stored(named.join(least, "label").select("whole", "component", F.lit(True).alias("shared")), "component-ids")
    discard(docs.sparkSession, mark, ("sketches", "component-ids"))  # what the result still reads
    out = lookup(table.select("row", "id", "n", "whole"), classes, "whole", "row")
    component = F.when(F.col("shared"), F.col("component")).otherwise(F.col("id"))
    return out.select("row", "id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()))
