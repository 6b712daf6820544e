"""Pluggable batch inference: scorers, encoders, tools. Deterministic stand-ins included."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions import scalars as S
from loomtext.functions import text as X
from loomtext.functions.blocks import in_blocks

#: A scorer maps text columns to one verdict column (JSON text). Any batch `pandas_udf`
#: that calls a model fits; the built-ins below are JVM expressions.
Scorer = Callable[..., Column]

DIMENSIONS = 64


def vocabulary(c: Column) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(X.words(F.lower(c)))


def overlap(needle: Column, haystack: Column) -> Column:
    """Share of the needle's distinct words that also occur in the haystack, 0 if it has none."""
    a = vocabulary(needle)
    hit = F.size(F.array_intersect(a, vocabulary(haystack)))
    return F.coalesce(F.try_divide(hit.cast("double"), F.size(a).cast("double")), F.lit(0.0))


def yes_no_json(condition: Column, field: str = "binary_score") -> Column:
    return F.concat(F.lit('{"%s": "' % field), F.when(condition, "yes").otherwise("no"), F.lit('"}'))


def overlap_scorer(threshold: float) -> Scorer:
    """Grade `yes` when enough of the first text's words occur in the second."""

    def score(needle: Column, haystack: Column) -> Column:
        return yes_no_json(overlap(needle, haystack) >= threshold)

    return score


def topic_router(topics: list[str]) -> Scorer:
    """Fenced verdict: `vectorstore` when the question names a topic, else `websearch`."""

    def score(question: Column) -> Column:
        known = F.arrays_overlap(X.words(F.lower(question)), F.array(*[F.lit(t) for t in topics]))
        return F.concat(
            F.lit('Routing.\n```json\n{"datasource": "'),
            F.when(known, "vectorstore").otherwise("websearch"),
            F.lit('"}\n```'),
        )

    return score


def _bucket(token: str, dims: int) -> int:
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[:6], 16) % dims if token else -1


def hashed_encoder(dims: int = DIMENSIONS) -> Callable[[Column], Column]:
    """Stand-in encoder: unit-length bag of words, one bucket per md5 of the token.

    A text without tokens has no vector (NULL) and is never retrieved. Tokens are split, counted
    and normalised per Arrow batch; only a batch's distinct tokens are hashed one by one. A real
    model takes the same place as an Arrow or pandas iterator UDF.
    """

    def vectors(texts: pa.Array) -> pa.Array:
        tokens = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(tokens).dictionary_encode()
        known = np.array([_bucket(t, dims) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        bucket = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.int64)
        cell = (row * dims + bucket)[bucket >= 0]
        counts = np.bincount(cell, minlength=len(texts) * dims).reshape(len(texts), dims).astype(np.float64)
        norm = np.sqrt((counts * counts).sum(axis=1))
        unit = counts / np.where(norm > 0, norm, 1.0)[:, None]
        offsets = pa.array(np.arange(0, (len(texts) + 1) * dims, dims, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()), mask=pa.array(norm == 0))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def encode(texts: pa.Array) -> pa.Array:
        return in_blocks(vectors, texts)

    # inference must not be repeated per row, as it would be when a filter on its result is
    # pushed below its projection
    return encode.asNondeterministic()


@dataclass(frozen=True)
class Tool:
    """A named, documented function over columns."""

    name: str
    doc: str
    fn: Callable[[Column], Column]
    high_risk: bool = False


#: Built-in tools. The registry is code, so its size is fixed.
TOOLS = {
    t.name: t
    for t in [
        Tool(
            "calculator", "Check an arithmetic expression.",
            lambda args: F.when(S.expression_allowed(args), F.concat(F.lit("accepted: "), args))
            .otherwise(F.lit("unsafe expression")),
        ),
        Tool(
            "send_email", "Queue an e-mail (needs approval).",
            lambda args: F.concat(F.lit("e-mail queued: "), args), True,
        ),
        Tool(
            "delete_user", "Queue a user deletion (needs approval).",
            lambda args: F.concat(F.lit("deletion queued: "), args), True,
        ),
    ]
}


def register_tools(spark, tools: dict[str, Tool] | None = None):
    """Expose the registry as the temporary view `tool_registry(name, doc, high_risk)`."""
    rows = [(t.name, t.doc, t.high_risk) for t in (tools or TOOLS).values()]
    df = spark.createDataFrame(rows, "name string, doc string, high_risk boolean")
    df.createOrReplaceTempView("tool_registry")
    return df
