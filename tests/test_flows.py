"""Loops with scripted verdicts, routing, grading and fallback."""

from pyspark.sql import functions as F

from loomtext.functions import inference as I
from loomtext.plans import rag, revise


def _scripted(column):
    """Verdict scorer that reads the question's script for the attempt in the generation."""
    def score(a, b):
        gen = a if column == "g" else b
        digit = F.get(F.split(gen, "#"), F.lit(1 if column == "g" else 2))
        return F.when(digit == "e", F.lit("not json")).otherwise(I.yes_no_json(digit == "y"))
    return score


def test_answer_loop_outcomes(spark):
    # script: one "<grounded><useful>" pair per attempt
    scripts = {1: "yy", 2: "yn yy", 3: "nn nn yy", 4: "nn yn nn", 5: "yn yn yn", 6: "ey yy"}
    rows = [(i, s, [(1, f"d{i}", "src")], f"extra{i}") for i, s in scripts.items()]
    state = spark.createDataFrame(
        rows, "question_id int, question string, docs array<struct<rank int, text string, source string>>, fallback_text string")

    def generate(docs, attempt):
        pair = F.get(F.split("question", " "), F.lit(attempt - 1))
        return F.concat(F.size(docs).cast("string"), F.lit("#"), pair.substr(1, 1), F.lit("#"), pair.substr(2, 1))

    out = rag.answer_loop(state, _scripted("g"), _scripted("u"), generate=generate)
    got = {r.question_id: (r.attempts, r.outcome, r.trail, int(r.generation[0])) for r in out.collect()}
    assert got == {
        1: (1, "useful", ["useful"], 1),
        2: (2, "useful", ["not useful", "useful"], 2),
        3: (3, "useful", ["not supported", "not supported", "useful"], 1),
        4: (3, "max retries", ["not supported", "not useful", "max retries"], 2),
        5: (3, "max retries", ["not useful", "not useful", "max retries"], 3),
        6: (2, "useful", ["not supported", "useful"], 1),
    }


def test_router(spark):
    q = spark.createDataFrame([(1, "how do agents work"), (2, "who won the cup"), (3, "agents and graphs")], "question_id int, question string")
    got = rag.route(q, I.topic_router(["agents"])).orderBy("question_id").collect()
    assert [r.route for r in got] == ["vectorstore", "websearch", "vectorstore"]
    broken = rag.route(q, lambda c: F.lit("no verdict")).collect()
    assert {r.route for r in broken} == {None}


def test_grading_and_fallback(spark):
    q = spark.createDataFrame([(1, "red apple"), (2, "blue car")], "question_id long, question string")
    corpus = spark.createDataFrame([(1, "red apple pie", "a"), (2, "green tree", "b"), (3, "blue car wheel", "c"), (4, "blue car door", "d")],
                                   "chunk_id long, text string, source string")
    second = spark.createDataFrame([(1, "red apple juice", None), (2, "apple", None), (3, "red", None), (4, "zzz", None)],
                                   "chunk_id long, text string, source string")
    hits = rag.grade(rag.retrieve(q, corpus, 2), I.overlap_scorer(0.5))
    docs = rag.with_fallback(hits, q, second).orderBy("question_id", "rank").collect()
    got = [(r.question_id, r["rank"], r.source) for r in docs]
    assert got[0] == (1, 1, "a") and got[1] == (1, 3, None)  # one irrelevant chunk: the fallback follows
    assert {g[2] for g in got if g[0] == 2} == {"c", "d"}
    assert docs[1].text.count("\n") == 2 and docs[1].text.startswith("red apple juice\n")


def test_corrective_answers_cover_every_routed_question(spark):
    q = spark.createDataFrame([(1, "the apple"), (2, "car facts"), (3, "the nothing")], "question_id long, question string")
    corpus = spark.createDataFrame([(1, "The apple is red. It is round. Yes. More.", "a"), (2, "Trees grow.", "b")], "chunk_id long, text string, source string")
    second = spark.createDataFrame([(1, "Car facts are here.", None)], "chunk_id long, text string, source string")
    out = rag.corrective_answers(q, corpus, second, router=I.topic_router(["the"]), grader=I.overlap_scorer(0.5),
                                 grounded=I.overlap_scorer(0.5), useful=I.overlap_scorer(0.5), k=2)
    got = {r.question_id: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3]
    assert got[1].outcome == "useful" and got[1].generation == "The apple is red. It is round. Yes."
    assert (got[2].route, got[2].outcome) == ("websearch", "useful")


def test_revise_loop_counts(spark):
    # the critic wants every x gone; a revision drops one
    critic = lambda d: F.when(F.contains(d, F.lit("x")), F.lit("drop"))
    reviser = lambda d, f: F.when(F.startswith(f, F.lit("human")), F.concat(F.lit("h"), d)).otherwise(F.regexp_replace(d, "^([^x]*)x", "$1"))
    rows = [(1, "a", None), (2, "xa", None), (3, "xxxxa", None), (4, "a", "human: again"), (5, "xxxxxxxa", "human: shorter"), (6, "x", "approved")]
    df = spark.createDataFrame(rows, "id int, draft string, review string")
    got = {r.id: (r.draft, r.attempts, r.total_revisions, r.satisfied) for r in revise.revise_loop(df, critic, reviser, human="review").collect()}
    assert got == {
        1: ("a", 1, 0, True), 2: ("a", 2, 1, True),
        3: ("xxa", 3, 2, False),                 # three drafts, two revisions
        4: ("ha", 0, 1, True),                   # the reviewer's revision resets the counter
        5: ("hxxa", 3, 6, False),                # 2 revisions, 1 by the reviewer, 3 more
        6: ("", 2, 1, True),
    }


def test_question_without_a_route_is_reported(spark):
    from loomtext.functions import inference as I
    from loomtext.plans import rag

    q = spark.createDataFrame([(1, "the cat sat"), (2, "unknown words")], "question_id long, question string")
    c = spark.createDataFrame([(7, "The cat sat down.", "a")], "chunk_id long, text string, source string")

    def router(question):
        return F.when(question.startswith("the"), '```json\n{"datasource": "vectorstore"}\n```').otherwise('```json\n{"datasource": "nowhere"}\n```')

    out = rag.corrective_answers(q, c, c, router=router, grader=I.overlap_scorer(0.1), grounded=I.overlap_scorer(0.1), useful=I.overlap_scorer(0.1), k=1)
    got = {r.question_id: (r.route, r.outcome, r.attempts, r.generation) for r in out.collect()}
    assert got[2] == (None, "no route", 0, None) and got[1][0] == "vectorstore" and got[1][2] >= 1
