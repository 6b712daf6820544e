"""Ranked lexical search by best positions in impact lists.

The collection is cut into shards of a bounded number of documents. In a shard each query term has a
list of its documents by falling impact. The lists of an item are read downwards together; each
document met is completed at once by direct accesses to the item's other lists, which also mark its
place there as seen. A list's best position is the last one before which every position has been
seen, however it was met, so the sum of the impacts at the best positions bounds all documents not yet
met, and more tightly than that at the positions read last. Reading stops as soon as this sum is
strictly below the k-th score so far: an equal score could still win by its smaller id.

A task carries the k best of an item from shard to shard, so later shards stop sooner, and the best
of all tasks are merged. Scores are whole numbers, so the result doesn't depend on the shards.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.common import doc_bytes, stored

#: Documents of one shard; at most so many words of queries are searched for in one pass over the texts.
SHARD_DOCS = 32_768
BLOCK_BYTES = 32_000_000
#: Positions of each list that are read in the first round; each further round reads twice as many.
FIRST_READ = 16
#: Parts in which the winners of an item are merged before the last merge.
MERGE_PARTS = 64
#: Fixed values of the score: 100 - 75 + 75 * length against the mean, and its scales.
FLAT, SLOPE, SCALE, TF, LENGTH, WEIGHT = 25, 75, 1_000_000_000, 1000, 8, 1000

#: Letters and digits stay, A-Z lower-cased, and so do all bytes from 0x80; the rest separates terms.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
HITS = "item long, doc_id long, score long"


def terms_of(data: bytes) -> list[bytes]:
    """Maximal stretches of ASCII letters and digits and of characters beyond ASCII."""
    return data.translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of one shard: for each term its documents, by impact and by number."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int, ids: np.ndarray):
        self.ids = ids
        by_impact = np.lexsort((docs, -impacts, terms))
        self.doc, self.impact = docs[by_impact], impacts[by_impact]
        self.first = np.searchsorted(terms[by_impact], np.arange(n_terms + 1))
        by_doc = np.argsort(terms[by_impact] * (len(ids) + 1) + self.doc, kind="stable")
        self.key = terms[by_impact][by_doc] * (len(ids) + 1) + self.doc[by_doc]  # direct access: (term, document) -> place
        self.place = by_doc

    def places(self, term: int, docs: np.ndarray) -> np.ndarray:
        """Places of documents in a term's list, -1 where it lacks them."""
        want = term * (len(self.ids) + 1) + docs
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.place[at], -1)

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best of `best` and this shard. `weights` holds a positive one for each term."""
        have = self.first[terms + 1] > self.first[terms]
        terms, weights = terms[have], weights[have]
        low, high = self.first[terms], self.first[terms + 1]
        seen = [np.zeros(b - a, bool) for a, b in zip(low, high)]
        best_at = np.zeros(len(terms), np.int64)  # positions seen from the top without a gap
        met = np.zeros(len(self.ids), bool)
        read, step = 0, FIRST_READ
        scores, ids = best
        while len(terms):
            new = np.unique(np.concatenate([self.doc[a + read : min(a + read + step, b)] for a, b in zip(low, high)]))
            new = new[~met[new]]
            met[new] = True
            read, step = read + step, step * 2
            total = np.zeros(len(new), np.int64)
            for i, t in enumerate(terms.tolist()):
                place = self.places(t, new)
                there = place >= 0
                total[there] += weights[i] * self.impact[place[there]]
                seen[i][place[there] - low[i]] = True
            scores, ids = leaders(np.concatenate([scores, total]), np.concatenate([ids, self.ids[new]]), k)
            bound = 0
            for i, marks in enumerate(seen):
                gap = marks[best_at[i] :].argmin() if best_at[i] < len(marks) else 0
                best_at[i] += gap if best_at[i] + gap < len(marks) and not marks[best_at[i] + gap] else len(marks) - best_at[i]
                if best_at[i] < len(marks):  # all at and above the last seen position are done; what is below is at most as high
                    bound += int(weights[i]) * int(self.impact[low[i] + max(best_at[i] - 1, 0)])
            if bound == 0 or (len(scores) >= k and bound < scores[k - 1]):
                break
        return scores, ids


def leaders(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest positive scores, equal ones by id."""
    good = scores > 0
    if len(scores) > 4 * k and good.sum() > k:
        good &= scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
    scores, ids = scores[good], ids[good]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, lengths, document of each posting, terms, tfs) of SHARD_DOCS rows in turn."""
    parts, size = [], 0

    def shard():
        t = pa.Table.from_batches(parts).combine_chunks()
        ids, n, terms, tfs = (t.column(i).combine_chunks() for i in range(4))
        owner = np.repeat(np.arange(len(t)), np.diff(terms.offsets.to_numpy()))
        missing = np.iinfo(np.int64).max  # documents without an id come last among equals
        return (ids.fill_null(missing).to_numpy(), n.to_numpy(), owner, terms.flatten().to_numpy().astype(np.int64),
                tfs.flatten().to_numpy().astype(np.int64))

    for batch in batches:
        for at in range(0, len(batch), SHARD_DOCS):
            part = batch.slice(at, SHARD_DOCS)
            if parts and size + len(part) > SHARD_DOCS:
                yield shard()
                parts, size = [], 0
            parts.append(part)
            size += len(part)
    if parts:
        yield shard()


def postings(docs: DataFrame, vocab: list[bytes], text: str, doc_id: str) -> DataFrame:
    """doc_id, n (all terms of the document), and number and count of those in the vocabulary; documents without terms are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), doc_bytes(F.col(f"`{text}`")).alias("data"))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(sent.value)}
        for batch in it:
            kept, n, terms, tfs, ends = [], [], [], [], [0]
            for i, data in enumerate(batch.column(1)):
                tokens = terms_of(data.as_py())
                if not tokens:
                    continue
                found = Counter(map(number.get, tokens))
                found.pop(None, None)
                kept.append(i)
                n.append(len(tokens))
                terms.extend(found.keys())
                tfs.extend(found.values())
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(count, POSTINGS)


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, bytes]]]:
    """(id, text) of the items in blocks of bounded size, each sent to the driver by itself."""
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("id"), doc_bytes(F.col(f"`{text}`")).alias("t")).orderBy("id", "t")
    block, size = [], 0
    for row in rows.toLocalIterator():
        data = bytes(row["t"])
        if block and size + len(data) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row["id"], data))
        size += len(data)
    if block:
        yield block


def search_block(docs: DataFrame, block: list[tuple[int | None, bytes]], k: int, text: str, doc_id: str) -> DataFrame:
    """item (place in the block), doc_id, score: the k best of each task."""
    spark = docs.sparkSession
    queries = [Counter(terms_of(data)) for _, data in block]
    vocab = sorted({t for q in queries for t in q})
    index = stored(postings(docs, vocab, text, doc_id), "postings")
    total = index.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocab), np.int64)
    for row in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        df[row["t"]] = row["df"]
    n_docs, n_terms = total["docs"], max(total["terms"], 1)
    number = {t: i for i, t in enumerate(vocab)}
    w = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    asked = []
    for q in queries:
        terms = np.array([number[t] for t in q], np.int64)
        weights = np.array([w[number[t]] * c for t, c in q.items()], np.int64)
        asked.append((terms[weights > 0], weights[weights > 0]))
    sent = spark.sparkContext.broadcast((asked, len(vocab)))

    def rank(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, n_vocab = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asked)
        for ids, n, owner, terms, tfs in shards(it):
            m = FLAT + (SLOPE * n * n_docs) // n_terms
            shard = Shard(terms, owner, (SCALE * tfs) // (TF * tfs + LENGTH * m[owner]), n_vocab, ids)
            best = [shard.top(*q, k, b) if len(q[0]) and len(terms) else b for q, b in zip(asked, best)]
        found = [len(s) for s, _ in best]
        ids = np.concatenate([i for _, i in best]) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(best)), found)), pa.array(ids, mask=ids == np.iinfo(np.int64).max),
            pa.array(np.concatenate([s for s, _ in best]) if best else ids)], ["item", "doc_id", "score"])

    return index.mapInArrow(rank, HITS)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents that score highest for each item, among those above 0.

    Terms are stretches of ASCII letters and digits, A-Z lower-cased, and characters beyond ASCII. A
    null or empty document counts nowhere; an item without terms finds nothing; null ids stay null and
    rank last among equal scores. Repeated rows are documents of their own, and a repeated item is
    answered once for each of its rows. Other columns are not read. Items of more than BLOCK_BYTES
    together are searched in several passes over the documents.
    """
    spark = docs.sparkSession
    found = None
    for block in item_blocks(items, item_id, item_text):
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS)).alias("_part")
        hits = search_block(docs, block, k, text, doc_id).select("*", part)
        for keys in (["item", "_part"], ["item"]):
            hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], "item long, item_id long")
        one = hits.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        found = one if found is None else found.unionAll(one)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found
