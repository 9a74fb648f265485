import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from merchlake.operators import evaluation, text
from merchlake.sources import testdata


def apply(spark, expression, *values, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, t {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_sentences(spark):
    got = apply(spark, text.sentences, " Five days. Really?  Yes!\nDone", "", "no stop", "a.b c. ")
    assert got == [["Five days.", "Really?", "Yes!", "Done"], [], ["no stop"], ["a.b c."]]


def test_paragraphs(spark):
    assert apply(spark, text.paragraphs, "A:\n\n B \n\n\n\nC\nd", "\n\n") == [["A:", "B", "C\nd"], []]


def test_word_windows(spark):
    got = apply(spark, lambda c: text.word_windows(c, 6, 2), "A B C D E F G H I J", "", "one")
    assert got == [["A B C D E F", "E F G H I J", "I J"], [], ["one"]]
    with pytest.raises(ValueError):
        text.word_windows(F.col("t"), 5, 5)


def test_merged_sentences(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"], [3, 1, 3]), ([], [1]), (["a"], [])], "p ARRAY<STRING>, b ARRAY<INT>")
    got = [r[0] for r in df.select(text.merged_sentences(F.col("p"), F.col("b"))).collect()]
    assert got == [["a", "b c", "d"], [], ["a"]]


def test_redaction_vectors(spark):
    cases = {
        "Write to admin@example.com for help.": "[EMAIL REDACTED]",
        "Card 4111-1111-1111-1111 was declined.": "[CARD REDACTED]",
        "Card 4111 1111 1111 1111 again.": "[CARD REDACTED]",
        "Call +31 20 123 4567 now.": "[PHONE REDACTED]",
    }
    for given, got in zip(cases, apply(spark, text.redact, *cases)):
        assert cases[given] in got and "4111" not in got and "admin@" not in got and "123 4567" not in got
    unchanged = ["Total revenue was EUR 109,427.99 over the last 7 days.", ""]
    assert apply(spark, text.redact, *unchanged) == unchanged
    both = apply(spark, text.redact, "Mail: boss@example.com | Card: 1234-5678-9012-3456")[0]
    assert both == "Mail: [EMAIL REDACTED] | Card: [CARD REDACTED]"


def test_redaction_and_sentences_equal_python_on_all_documents(spark):
    docs = testdata.table(spark, SMALL, "documents")
    patterns = [(re.compile(p.removeprefix("(?U)")), r) for _, p, r in text.PII]
    for row in docs.select("text", text.redact(F.col("text")).alias("r"), text.sentences(F.col("text")).alias("s")).collect():
        wanted = row["text"]
        for pattern, replacement in patterns:
            wanted = pattern.sub(replacement, wanted)
        assert row["r"] == wanted
        assert row["s"] == [s for s in re.split(r"(?<=[.!?])\s+", row["text"].strip()) if s]


def test_pii_counts(spark):
    df = spark.createDataFrame([("a@b.co c@d.eu 4111 1111 1111 1111 and +31 20 123 4567",)], "t STRING")
    got = df.select(*[c.alias(n) for n, c in text.pii_counts(F.col("t")).items()]).first()
    assert tuple(got) == (2, 1, 1)


ROUTED = {
    "Why was order 999 blocked?": "fraud",
    "How many chargebacks last month?": "fraud",
    "This payment looks SUSPICIOUS": "fraud",
    "Total revenue last 7 days?": "pricing",
    "Did the chargeback hit our revenue?": "fraud",
    "Any revenue anomalies this week?": "pricing",
    "Which product sells best?": "pricing",
    "How much is the average LTV?": "customer",
    "Hello there": "customer",
    "": "customer",
}


def test_routing(spark):
    assert apply(spark, text.route, *ROUTED, None) == [*ROUTED.values(), "customer"]


def test_gate(spark):
    got = apply(spark, text.gate_verdict, " allowed ", "BLOCKED: off topic: poem", "blocked", "hm", "", None)
    assert [tuple(r) for r in got] == [
        ("ALLOWED", ""), ("BLOCKED", "off topic: poem"), ("BLOCKED", "blocked by safety filter"),
        *[("BLOCKED", "internal safety filter error")] * 3,
    ]


def test_safety_and_judge(spark):
    assert [tuple(r) for r in apply(spark, text.safety_verdict, "SAFE", "UNSAFE S1", "unsafe")] == [
        (True, ""), (False, "Input blocked: S1"), (False, "Input blocked: unsafe")
    ]
    got = apply(spark, text.judge_reply, "SCORE: 0.5\nREASON: fine: mostly", "REASON: none", "SCORE: ten", None)
    assert [tuple(r) for r in got] == [(0.5, "fine: mostly"), (0.0, "none"), (0.0, ""), (0.0, "")]
    hard = ["SCORE: 1.0\nREASON: a\nSCORE: 0.5\n REASON : b: c", "SCORE:\n0.9\nREASON:\nfoo", "SCORE: 1.0d", "x\r\nSCORE: 1\u2028REASON: y"]
    assert [tuple(r) for r in apply(spark, text.judge_reply, *hard)] == [(0.5, "b: c"), (0.0, ""), (0.0, ""), (1.0, "y")]


def test_structured_answers(spark):
    good = '{"summary": "s", "data_source": "d", "confidence": "high", "chart_spec": null}'
    chart = '{"summary": "s", "data_source": "d", "confidence": "low", "chart_spec": {"mark": "bar"}}'
    bad = [
        '{"summary": "s", "data_source": "d", "confidence": "very high"}',
        "The answer is 45.",
        '{"data_source": "d", "confidence": "high"}',
        "{}",
        '{"summary": 5, "data_source": "d", "confidence": "high"}',
        '{"summary": "s", "data_source": "d", "confidence": "high", "chart_spec": "bar"}',
        '{"summary": "s", "data_source": "d", "confidence": "high", "chart_spec": "{oops"}',
        '{"summary": "s", "data_source": "d", "confidence": "high"} and more',
        '{"summary": "s", "data_source": "d", "confidence": "high"}, {}',
        '{"summary": 5, "x": {"summary": "s"}, "data_source": "d", "confidence": "high"}',
        '{"x": {"summary": "s"}, "data_source": "d", "confidence": "high"}',
        '[{"summary": "s", "data_source": "d", "confidence": "high"}]',
        "",
    ]
    got = apply(spark, text.structured_answer, good, chart, *bad)
    assert tuple(got[0]) == (True, "s", "d", "high", None)
    assert got[1]["valid"] and got[1]["chart_spec"] == '{"mark":"bar"}'
    for given, row in zip(bad, got[2:]):
        assert tuple(row) == (False, given, "", "", None)


def test_last_user_turn(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (2, 0, "system", "s")],
        "conv_id INT, turn INT, role STRING, text STRING",
    )
    assert {r[0]: r[1] for r in text.last_user_turn(df).collect()} == {1: "b", 2: ""}


def test_chunk_ids(spark):
    df = spark.createDataFrame([(7, "web", "A. B.")], "doc_id INT, source STRING, text STRING")
    got = text.chunk_table(df, text.sentences(F.col("text"))).collect()
    assert [(r["chunk_id"], r["chunk_text"]) for r in got] == [("7-0", "A."), ("7-1", "B.")]


@pytest.mark.parametrize(
    "answer, keywords, score",
    [("Revenue was EUR 5", "revenue eur", 1.0), ("Revenue", "revenue eur", 0.0), ("x", "", 1.0), ("x", None, 1.0), (None, "a", 0.0)],
)
def test_keyword_score(spark, answer, keywords, score):
    df = spark.createDataFrame([(answer, keywords)], "a STRING, k STRING")
    assert df.select(evaluation.keyword_score(F.col("a"), F.col("k"))).first()[0] == score


def test_scenarios(spark):
    df = spark.createDataFrame(
        [(1, "I can only help with shop topics", "customer", True, None, []),
         (2, "Sure: 42", "customer", True, None, []),
         (3, "revenue is 5 eur", "pricing", False, "pricing", ["eur", "x"]),
         (4, "nothing", "customer", False, "pricing", ["eur"]),
         (5, "no", "BLOCKED", False, "pricing", ["eur"])],
        "i INT, a STRING, g STRING, b BOOLEAN, e STRING, k ARRAY<STRING>",
    )
    failures = evaluation.scenario_failures(*[F.col(c) for c in "agbek"])
    assert [r[0] for r in df.orderBy("i").select(failures).collect()] == [
        [], ["expected blocked"], [], ["wrong agent", "no keyword found"], ["expected allowed"]
    ]
