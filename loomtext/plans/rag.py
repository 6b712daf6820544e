"""Batch retrieval and corrective answering over tables of questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import inference as I
from loomtext.functions import text as X
from loomtext.operators import context, retrieval, skew, stats
from loomtext.session import cut_lineage

PROMPT = "Answer only from the context.\nQuestion: {question}\nContext: {context}\nAnswer:"
MAX_ATTEMPTS = 3
#: Winners (ids and a rank each) that may be broadcast, by count.
MAX_BROADCAST_WINNERS = 500_000
QID, CID = "question_id", "chunk_id"


def embed(df: DataFrame, text: str, encoder: Callable[[Column], Column] | None = None) -> DataFrame:
    return df.withColumn("embedding", (encoder or I.hashed_encoder())(F.col(text)))


def retrieve(questions: DataFrame, corpus: DataFrame, k: int, *, encoder=None, text: str = "text",
             metric: str = "l2") -> DataFrame:
    """Ranked chunks with their text: (question_id, question, chunk_id, rank, text, source).

    `questions` has (question_id, question); `corpus` has (chunk_id, text, source) and, when it
    comes from an index, already `embedding`. Only ids and vectors take part in the search; the
    text is joined to the few winners.
    """
    q = embed(questions, "question", encoder).select(QID, "embedding")
    stored = "embedding" in corpus.columns
    c = corpus if stored else embed(corpus, text, encoder)
    ranked = retrieval.topk(q, c.select(CID, "embedding"), k, qid=QID, cid=CID, metric=metric, stored=stored)
    # k rows per question, computed once. Counted winners go to the texts, which then stay where they
    # are; more of them meet the texts in a join, salted as one chunk may win for most questions.
    ranked = cut_lineage(ranked.select(QID, CID, "rank"))
    texts = corpus.select(CID, F.col(text).alias("text"), "source")
    if ranked.limit(MAX_BROADCAST_WINNERS + 1).count() <= MAX_BROADCAST_WINNERS:
        hits = texts.join(F.broadcast(ranked), CID)
    else:
        hits = skew.skewed_lookup(ranked, texts, CID, QID, "inner")
    return hits.join(questions.select(QID, "question"), QID)


def rag_inputs(questions: DataFrame, corpus: DataFrame, k: int = 8, layout: str = "joined",
               template: str = PROMPT, encoder=None) -> DataFrame:
    """Search, context and prompt for all questions in one plan."""
    ctx = context.assemble(retrieve(questions, corpus, k, encoder=encoder), [QID], layout)
    return context.prompts(ctx, questions, QID, "question", template)


def route(questions: DataFrame, scorer: I.Scorer) -> DataFrame:
    """Parse the router's fenced verdict; anything unknown is a NULL route."""
    found = X.verdict_field(scorer(F.col("question")), "datasource")
    return questions.withColumn("route", F.when(found.isin("websearch", "vectorstore"), found))


def grade(hits: DataFrame, scorer: I.Scorer) -> DataFrame:
    verdict = X.verdict_field(scorer(F.col("question"), F.col("text")), "binary_score")
    return hits.withColumn("relevant", X.is_yes(verdict))


def fallback_documents(questions: DataFrame, corpus: DataFrame, k: int = 3, encoder=None) -> DataFrame:
    """One document per question: the top-k texts of the second corpus joined by newline."""
    hits = retrieve(questions, corpus, k, encoder=encoder)
    items = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy(QID).agg(
        F.array_join(F.transform(items, lambda x: x["text"]), "\n").alias("fallback_text")
    )


def with_fallback(graded: DataFrame, questions: DataFrame, corpus: DataFrame, k: int = 3, encoder=None) -> DataFrame:
    """Relevant chunks; questions with any irrelevant chunk also get the fallback document.

    The fallback row ranks after all chunks and has no source. Only flagged questions are
    searched in the second corpus. The graded rows (k per question) are checkpointed: they are
    used three times, and the search behind them runs once.
    """
    graded = cut_lineage(graded)
    flagged = stats.irrelevant_flag(graded, QID, F.col("relevant")).where("any_irrelevant").select(QID)
    extra = fallback_documents(questions.join(flagged, QID, "left_semi"), corpus, k, encoder)
    last = graded.groupBy(QID).agg((F.max("rank") + 1).alias("rank"))
    kept = graded.where("relevant").select(QID, "rank", "text", "source")
    return kept.unionByName(
        extra.join(last, QID).select(QID, "rank", F.col("fallback_text").alias("text"), F.lit(None).cast("string").alias("source"))
    )


def extractive_answer(docs: Column, attempt: int) -> Column:
    """Stand-in generator: first three sentences of the document at the attempt's place."""
    n = F.size(docs)
    doc = F.get(docs, F.least(F.lit(attempt), n) - 1)
    return F.coalesce(X.first_sentences(doc["text"], 3), F.lit(""))


def answer_loop(state: DataFrame, grounded: I.Scorer, useful: I.Scorer, *, generate=extractive_answer,
                max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Generate and grade with at most `max_attempts` passes.

    `state` has (question_id, question, docs, fallback_text); `docs` is an ordered array of
    structs with `text`, bounded by k. A pass touches only the unresolved questions and is
    checkpointed, so a model is called once per question and pass. A grounded but unhelpful
    answer adds the fallback document; an ungrounded one is retried as it is.
    """
    pending = state.withColumn("trail", F.array().cast("array<string>"))
    done = []
    for attempt in range(1, max_attempts + 1):
        passed = pending.withColumn("generation", generate(F.col("docs"), attempt))
        facts = F.array_join(F.transform("docs", lambda d: d["text"]), "\n\n")
        passed = passed.withColumn(
            "_g", X.is_yes(X.verdict_field(grounded(F.col("generation"), facts), "binary_score"))
        ).withColumn(
            "_u", X.is_yes(X.verdict_field(useful(F.col("question"), F.col("generation")), "binary_score"))
        )
        last = F.lit(attempt == max_attempts)
        outcome = (
            F.when(F.col("_g") & F.col("_u"), "useful").when(last, "max retries")
            .when(F.col("_g"), "not useful").otherwise("not supported")
        )
        passed = passed.withColumn("outcome", outcome).withColumn("trail", F.array_append("trail", F.col("outcome")))
        passed = passed.withColumn("attempts", F.lit(attempt)).drop("_g", "_u")
        if attempt < max_attempts:
            passed = cut_lineage(passed)
        final = F.col("outcome").isin("useful", "max retries")
        done.append(passed.where(final))
        extra = F.array(F.struct(F.lit(99 + attempt).alias("rank"), F.col("fallback_text").alias("text"),
                                 F.lit(None).cast("string").alias("source")))
        grown = F.when(
            (F.col("outcome") == "not useful") & F.col("fallback_text").isNotNull(), F.concat("docs", extra)
        ).otherwise(F.col("docs"))
        pending = passed.where(~final).withColumn("docs", grown).select(*state.columns, "trail")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def loop_state(questions: DataFrame, docs: DataFrame, fallback: DataFrame) -> DataFrame:
    """Question rows with their ordered documents (possibly none) and the fallback text."""
    item = F.struct(F.col("rank").cast("int").alias("rank"), "text", "source")
    lists = docs.groupBy(QID).agg(F.array_sort(F.collect_list(item)).alias("docs"))
    out = questions.join(lists, QID, "left").join(fallback, QID, "left")
    empty = F.array().cast(lists.schema["docs"].dataType)
    return out.withColumn("docs", F.coalesce("docs", empty))


def corrective_answers(questions: DataFrame, corpus: DataFrame, second: DataFrame, *, router: I.Scorer,
                       grader: I.Scorer, grounded: I.Scorer, useful: I.Scorer, k: int = 8, encoder=None) -> DataFrame:
    """Route, retrieve, grade, fall back, then the bounded answer loop, for all questions.

    A question whose route is unknown is reported with the outcome `no route`, no attempt and no answer.
    """
    routed = route(questions, router)
    vector_q = routed.where("route = 'vectorstore'")
    web_q = routed.where("route = 'websearch'")
    graded = cut_lineage(grade(retrieve(vector_q, corpus, k, encoder=encoder), grader))
    docs = graded.where("relevant").select(QID, "rank", "text", "source")
    flagged = stats.irrelevant_flag(graded, QID, F.col("relevant")).where("any_irrelevant").select(QID)
    fallback = cut_lineage(fallback_documents(routed.where("route is not null"), second, 3, encoder))
    first = flagged.unionByName(web_q.select(QID))
    appended = fallback.join(first, QID, "left_semi").select(
        QID, F.lit(k + 1).alias("rank"), F.col("fallback_text").alias("text"),
        F.lit(None).cast("string").alias("source"),
    )
    state = loop_state(routed.where("route is not null").select(QID, "question", "route"),
                       docs.unionByName(appended), fallback)
    out = answer_loop(state, grounded, useful)
    left = routed.where("route is null").select(QID, "question", "route", F.lit("no route").alias("outcome"), F.lit(0).alias("attempts"))
    return out.unionByName(left, allowMissingColumns=True)
