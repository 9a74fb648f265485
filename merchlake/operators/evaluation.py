"""Scoring of answers against expectations, and the reports on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions.joins import BROADCAST_LIMIT, spread_join
from merchlake.functions.scalars import words
from merchlake.session import stored

# Phrases that mark a refusal; pass the exact wording of the assistant at hand.
REFUSALS = ("only help with", "cannot help")


def keyword_score(answer: Column, keywords: Column) -> Column:
    """1.0 when every blank-separated keyword occurs in the answer, any case; no keywords give 1.0."""
    lower = F.lower(F.coalesce(answer, F.lit("")))
    wanted = words(F.lower(F.coalesce(keywords, F.lit(""))))
    return F.when(F.forall(wanted, lambda w: F.contains(lower, w)), 1.0).otherwise(0.0)


def scenario_failures(
    answer: Column,
    agent: Column,
    expected_blocked: Column,
    expected_agent: Column,
    expected_keywords: Column,
    refusals: Sequence[str] = REFUSALS,
) -> Column:
    """What went wrong in a scenario, empty when it passed: block state, agent, and any-keyword check."""
    text = F.lower(F.coalesce(answer, F.lit("")))
    actual = F.lower(F.coalesce(agent, F.lit("")))
    blocked = actual == "blocked"
    for phrase in refusals:
        blocked = blocked | F.contains(text, F.lit(phrase))
    open_question = ~expected_blocked & ~blocked
    wrong_agent = open_question & F.coalesce(expected_agent != "", F.lit(False)) & (actual != expected_agent)
    none_found = (
        open_question
        & F.coalesce(F.size(expected_keywords) > 0, F.lit(False))
        & ~F.coalesce(F.exists(expected_keywords, lambda k: F.contains(text, k)), F.lit(False))
    )
    return F.array_compact(
        F.array(
            F.when(expected_blocked & ~blocked, "expected blocked"),
            F.when(~expected_blocked & blocked, "expected allowed"),
            F.when(wrong_agent, "wrong agent"),
            F.when(none_found, "no keyword found"),
        )
    )


def category_report(results: DataFrame, category: str = "category") -> DataFrame:
    """Questions, keyword pass rate and mean judge score per category."""
    return results.groupBy(category).agg(
        F.count(F.lit(1)).alias("questions"),
        F.round(F.avg("keyword_pass"), 2).alias("keyword_pass"),
        F.round(F.avg("judge_score"), 2).alias("judge_score"),
    )


def layer_report(results: DataFrame, layer: str = "layer") -> DataFrame:
    """Passed and total per layer with a grand total (layer NULL) and mean latency."""
    passed = F.count(F.when(F.col("passed"), 1))
    return results.rollup(layer).agg(
        passed.alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.floor(F.avg("latency_ms")).alias("avg_latency_ms"),
        F.round(passed / F.count(F.lit(1)), 4).alias("pass_rate"),
    )


def failed_rows(results: DataFrame, width: int = 200) -> DataFrame:
    """Failed questions with their answer, and its start for reading."""
    return results.where(F.col("keyword_pass") == 0.0).withColumn(
        "answer_head", F.substring("agent_answer", 1, width)
    )


def overlap_score(answer: Column, expected: Column) -> Column:
    """Share of the expected distinct words that the answer contains."""
    have = F.array_distinct(words(F.lower(answer)))
    want = F.array_distinct(words(F.lower(expected)))
    return F.size(F.array_intersect(want, have)) / F.nullif(F.size(want), F.lit(0))


def cosine_scores(
    results: DataFrame, key: Sequence[str], answer: str, expected: str, name: str = "cosine", limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """`results` with the cosine of answer and expected text over their words, weighted by rarity.

    A word weighs its count in the text times ln((1 + n) / (1 + m)) + 1, where m
    of the n texts (answers and expected ones together) hold it. Both texts of a
    row share one row a word, so words are joined to their weights once, and the
    products are summed by key. NULL where one of the texts has no word. `key`
    must be unique and not NULL.
    """
    sides = [
        results.select(*key, F.explode(words(F.lower(F.col(text)))).alias("_word"), F.lit(mine).alias("_a"), F.lit(1 - mine).alias("_e"))
        for text, mine in ((answer, 1), (expected, 0))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy(*key, "_word").agg(F.sum("_a").alias("_a"), F.sum("_e").alias("_e"))
    counts = stored(counts, "words")
    texts = results.agg(F.count(answer) + F.count(expected)).first()[0]
    held = F.sum((F.col("_a") > 0).cast("int") + (F.col("_e") > 0).cast("int"))
    weights = counts.groupBy("_word").agg((F.log((1.0 + texts) / (1 + held)) + 1).alias("_w"))
    weighed = spread_join(counts, weights, "_word", "inner", limit=limit, aggregated=True)
    square = F.col("_w") * F.col("_w")
    sums = weighed.groupBy(*[F.col(k).alias(f"_key_{k}") for k in key]).agg(
        F.sum(F.col("_a") * F.col("_e") * square).alias("_dot"),
        F.sum(F.col("_a") * F.col("_a") * square).alias("_aa"),
        F.sum(F.col("_e") * F.col("_e") * square).alias("_ee"),
    )
    cosine = F.col("_dot") / F.nullif(F.sqrt(F.col("_aa")) * F.sqrt(F.col("_ee")), F.lit(0.0))
    matched = results.join(sums, [F.col(k) == F.col(f"_key_{k}") for k in key], "left")
    return matched.select(*results.columns, cosine.alias(name))


def disagreements(results: DataFrame, rule: str, judge: str, limit: float = 0.5) -> DataFrame:
    """Rows whose two scores are further apart than the limit."""
    return results.withColumn("disagrees", F.abs(F.col(rule) - F.col(judge)) > limit)
