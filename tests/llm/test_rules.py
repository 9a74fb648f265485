"""The rule ledger against a plain count, policies and ablations against the texts themselves."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from merchlake.llm import queries, rules

DOCS = "doc_id long, text string, n_words string, failed_bits string, _text string"


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else {w for w, n in counts(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    m = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
    }
    fails = [
        m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"], 100 * m["n_symbols"] > 20 * m["n_words"],
        m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 15 * m["n_words"], 100 * m["n_dup_lines"] > 40 * m["n_lines"],
        100 * m["n_capitals"] > 50 * m["word_chars"], m["n_words"] > 1_000_000,
    ]
    return (*m.values(), sum(1 << i for i, f in enumerate(fails) if f))


def counts(items):
    out = {}
    for x in items:
        out[x] = out.get(x, 0) + 1
    return out


def texts():
    rng = random.Random(2)
    out = [None, "", " \t\n\x0b\x0c\r ", "one", "one two", "a b c", "a a a a", "a b c a b c", "x\n\nx\n x\nx ", "naïve 😀 ÄÖ Ü z",
           "### $$$ a|b <i> 5%", "SHOUT " * 60, "w " * 20_000, "y" * 300_000, "tab\there\rthere\n" * 30]
    for _ in range(150):
        n = rng.choice([2, 5, 40, 200])
        out.append(rng.choice([" ", "\n", "  \n "]).join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(n)))
    for _ in range(20):
        out.append(" ".join(str(rng.randrange(5000)) for _ in range(300)) + " " + rng.choice(["A B C ", "# "]) * rng.randrange(60))
    return out


def test_ledger_equals_plain_count(spark):
    rows = [(i if i % 7 else None, t, "a", "b", "c") for i, t in enumerate(texts())]
    rows += rows[:5]
    got = rules.ledger(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", *rules.MEASURES, "failed_bits"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((k, *measured(t)) for k, t, *_ in rows), key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#", max_size=60), max_size=8))
def test_ledger_of_any_texts(spark, some):
    got = rules.ledger(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == [(i, *measured(t)) for i, t in enumerate(some)]


def test_policies_and_ablations(spark):
    rows = list(enumerate(texts()))
    entries = rules.ledger(spark.createDataFrame(rows, "doc_id long, text string"))
    bits = [measured(t)[-1] for _, t in rows]
    for policy in rules.POLICIES.values():
        hard, soft = policy.mask(policy.hard), policy.mask(policy.soft)

        def keeps(b, without=0, hard=hard, soft=soft, policy=policy):
            return b & hard & ~without == 0 and (b & soft & ~without).bit_count() <= policy.allowed

        judged = {r["doc_id"]: r for r in rules.judged(entries, policy).collect()}
        for (key, _), b in zip(rows, bits, strict=True):
            assert judged[key]["base_failed"] == (b & 3 != 0)
            assert judged[key]["kept"] == (b & 3 == 0 and keeps(b))
            assert judged[key]["policy"] == policy.version
        for row in rules.ablations(entries, policy).collect():
            bit = rules.BITS[row["rule"]]
            scoped = [b & (hard | soft) for b in bits]
            assert row["n_failed"] == sum(b & bit != 0 for b in scoped)
            assert row["n_alone"] == sum(b == bit for b in scoped)
            assert row["n_regained"] == sum(keeps(b, bit) and not keeps(b) for b in scoped)
            assert row["n_kept"] == sum(map(keeps, scoped))
            assert row["with_bits"] == 0 | __import__("functools").reduce(lambda a, b: a | b, [b & ~bit for b in scoped if b & bit], 0)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert rules.judged(rules.ledger(empty)).collect() == []
    assert {tuple(r)[2:] for r in rules.ablations(rules.ledger(empty)).collect()} == {(0, 0, 0, 0, 0)}


def test_query_runs_in_the_jvm(spark):
    plan = queries.QUERIES["op11_rule_ledger"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
