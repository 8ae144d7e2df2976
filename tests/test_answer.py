import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from narrata.functions.prompts import render, without_prompt
from narrata.operators import answer, evaluate
from narrata.params import JobParams
from narrata.plans.answer_batch import answer_batch
from narrata.sources.writers import write_lines

HIT = "question_id int, rank int, chunk_text string, product string, issue string, company string, distance double"


def hits_of(spark, rows):
    return spark.createDataFrame(rows, HIT)


def plain_context(hits, limit):
    """Whole hits while they fit, then at most one cut hit."""
    parts, room = [], limit
    for number, (text, product, issue) in enumerate(hits, 1):
        head = f"[Document {number}]" + (f" Product: {product}" if product else "")
        whole = head + (f", Issue: {issue}" if issue else "") + f"\n{text}\n"
        if len(whole) <= room:
            parts.append(whole)
            room -= len(whole)
            continue
        left = room - len(f"[Document {number}]...\n")
        if left > 100:
            parts.append(f"{head}\n{text[:left]}...\n")
        break
    return "\n".join(parts)


ONE_HIT = st.tuples(
    st.integers(0, 900).map(lambda n: "é" * n), st.sampled_from([None, "", "card"]),
    st.sampled_from([None, "", "fees"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ONE_HIT, min_size=1, max_size=6), min_size=10, max_size=30), st.sampled_from([150, 400, 2000]))
def test_context_equals_the_rules(spark, batches, limit):
    rows = [
        (i, r, text, product, issue, "co", 0.1)
        for i, hits in enumerate(batches) for r, (text, product, issue) in enumerate(hits, 1)
    ]
    got = {r.question_id: r.context for r in answer.pack_context(hits_of(spark, rows), limit).collect()}
    assert got == {i: plain_context(hits, limit) for i, hits in enumerate(batches)}


@pytest.mark.parametrize("left", [99, 100, 101])
def test_cut_needs_more_than_a_hundred(spark, left):
    used = 2000 - left - len("[Document 2]...\n")
    first = "x" * (used - len("[Document 1]\n\n"))
    rows = [(1, 1, first, None, None, None, 0.0), (1, 2, "y" * 500, None, None, None, 0.1)]
    context = answer.pack_context(hits_of(spark, rows)).first().context
    assert ("[Document 2]" in context) == (left > 100)
    if left > 100:
        assert context.endswith("\n" + "y" * left + "...\n")


def test_prompts_do_not_read_placeholders_in_values(spark):
    df = spark.createDataFrame([("use {question} {context}", "why {context}?")], "context string, question string")
    text = answer.prompts(df, "concise").first().prompt
    assert "Context: use {question} {context}\n" in text and "Question: why {context}?\n" in text
    assert "analyst assistant for Acme." in answer.prompts(df, organisation="Acme").first().prompt
    own = answer.prompts(df, "{{q}} {question} {tone}", tone="kindly").first().prompt
    assert own == "{q} why {context}? kindly"
    with pytest.raises(ValueError):
        render("{context} {nowhere}", context=F.col("context"))


def test_answers_and_sources(spark):
    questions = spark.createDataFrame([(1, "a?"), (2, "b?"), (3, "c?")], "question_id int, question string")
    rows = [(q, r, "t" * (198 + r), None if r == 1 else "p", None, None, r / 10) for q in (1, 3) for r in (3, 1, 2, 4)]
    supplied = spark.createDataFrame([(1, " \n said "), (2, "unused")], "question_id int, answer string")
    got = {r.question_id: r for r in answer.assemble_answers(questions, hits_of(spark, rows), supplied).collect()}
    assert got[1].answer == "said"
    assert got[2].answer == answer.NO_HITS_ANSWER and got[2].context == "" and got[2].sources == []
    assert got[3].answer == answer.FAILED_ANSWER
    first, second, third = got[1].sources
    assert (first["rank"], first.product, first.company) == (1, "Unknown", "Unknown")
    assert (second.text, third.text) == ("t" * 200, "t" * 200 + "...")
    bare = answer.assemble_answers(questions, hits_of(spark, rows), return_sources=False)
    assert bare.columns == ["question_id", "question", "answer", "context"]


def test_blank_questions_are_refused(spark):
    for bad in ("  ", "", None):
        df = spark.createDataFrame([(1, bad)], "question_id int, question string")
        with pytest.raises(PySparkException):
            answer.check_questions(df).collect()


def test_relevance_and_markdown(spark):
    rows = [(1, i, "t", "p", "i", "c", d) for i, d in enumerate([None, 0.0, 0.4, 1.7, -0.2], 1)]
    hits = hits_of(spark, rows)
    got = [r[0] for r in hits.orderBy("rank").select(answer.relevance(F.col("distance"))).collect()]
    assert got == [None, 1.0, 0.6, 0.0, 1.0]
    shares = spark.createDataFrame([(x,) for x in (0.0625, 0.12345, 1.0)], "x double")
    texts = [r[0] for r in shares.select(answer.percent_text(F.col("x"))).collect()]
    assert texts == [f"{x:.1%}" for x in (0.0625, 0.12345, 1.0)]
    block = answer.source_markdown(answer.sources(hits, 5)).first().source_markdown
    assert block.startswith(answer.SOURCES_TITLE + "\n#### Source 1\n\n**Product:** p  \n")
    assert block.count("**Relevance:**") == 4 and "**Relevance:** 60.0%  \n" in block
    none = spark.createDataFrame([(1, [])], f"question_id int, sources array<{answer.SOURCE}>")
    assert answer.source_markdown(none).first().source_markdown == answer.NO_SOURCES


def test_strip_prompt(spark):
    rows = [("Q: x\n  yes ", "Q: x"), (" no ", "Q: x"), ("Q: x", "Q: x")]
    df = spark.createDataFrame(rows, "a string, p string")
    assert [r[0] for r in df.select(without_prompt(F.col("a"), F.col("p"))).collect()] == ["yes", " no ", ""]


@pytest.fixture
def results(spark):
    questions = spark.createDataFrame([(1, "a|b?"), (2, "c?")], "question_id int, question string")
    hits = hits_of(spark, [(1, r, "s" * 300, "p", None, None, 0.1) for r in (1, 2, 3, 4)])
    supplied = spark.createDataFrame([(1, "x|" * 200)], "question_id int, answer string")
    expected = spark.createDataFrame([(2, "known")], "question_id int, expected_answer string")
    return evaluate.evaluate(answer.assemble_answers(questions, hits, supplied), expected)


def test_evaluation(results, tmp_path, spark):
    rows = {r.question_id: r for r in results.collect()}
    assert (rows[1].num_sources, len(rows[1].retrieved_sources), len(rows[1].context_used)) == (3, 2, 500)
    assert (rows[2].num_sources, rows[2].expected_answer, rows[2].comments) == (0, "known", "")
    table = {r.question_id: r for r in evaluate.evaluation_table(results).collect()}
    assert table[1]["Generated Answer"] == ("x|" * 150) + "..."
    assert table[1]["Retrieved Sources"] == "\n".join(f"Source {i} (p): {'s' * 100}..." for i in (1, 2))
    assert table[2]["Retrieved Sources"] == ""
    lines = evaluate.report_lines(results)
    path = write_lines(lines, str(tmp_path / "report"), ["part", "question_id", "line_no"])
    report = "\n".join(r.value for r in spark.read.text(path).collect())
    assert "on 2 representative questions." in report
    assert f"| a\\|b? | {'x\\|' * 100}... | **Source 1** (p): {'s' * 80}...<br>" in report
    ordered = [r.line for r in lines.orderBy("part", "question_id", "line_no").collect()]
    assert ordered[0].startswith("# ") and ordered[10].startswith("| a") and ordered[11].startswith("| c?")


def test_answer_batch_from_text(spark):
    from narrata.operators.embed import embed_table, hashing_encoder

    rows = [("1_0", "late fee on my card", "card"), ("2_0", "wire money transfer lost", "money"), ("3_0", "card stolen", "card")]
    stored = spark.createDataFrame(rows, "chunk_id string, chunk_text string, product string").selectExpr(
        "*", "cast(null as string) issue", "'co' company")
    params = JobParams(embedding_dim=64, top_k=2)
    vectors = embed_table(stored, "chunk_text", hashing_encoder(64))
    asked = spark.createDataFrame([(1, "late fee card", None), (2, "late fee card", "money")], "question_id int, question string, want string")
    got = {r.question_id: r for r in answer_batch(vectors, asked, params, question_filter="want").collect()}
    assert [s.text for s in got[1].sources] == ["late fee on my card", "card stolen"]
    assert [s.product for s in got[2].sources] == ["money"]
    assert got[1].prompt.count("late fee on my card") == 1
