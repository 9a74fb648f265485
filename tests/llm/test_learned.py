"""Toxicity and language: held-out accuracy, folding, forward-backward against brute force, odd rows."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from merchlake.llm import language, queries, toxicity

SMALL = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, score string, lang string, words string"


def odd(spark, rows):
    return spark.createDataFrame([(k, t, None, "s", None) for k, t in rows], ODD)


def test_folding_and_matching():
    machine = toxicity.Model().automaton()
    for text in ["You IDIOT!!", "you 1d1ot", "yоu idiоt", "i​diot", "ｉｄｉｏｔ"]:  # letters of other scripts, hidden and wide ones
        assert toxicity.weigh(machine, text)[1] == 1, text
    for text in ["idiotic", "take out the trash", "a trash can", "", None, "404 55", "!!!"]:
        assert toxicity.weigh(machine, text)[:2] == (0, 0), text
    assert toxicity.weigh(machine, "trash in the trash can")[1] == 1


def test_longer_texts_need_more():
    model = toxicity.Model()
    short, long = (model.score(toxicity.features(3.0, n)) for n in (5, 5000))
    assert short > long


def test_toxicity_held_out(spark):
    result = queries.QUERIES["op4_toxicity"](spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    rows = result.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert result.count() == 1000 and held
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.95
    assert sum(r["predicted"] for r in held if r["toxic"] == 0) <= 2


def test_toxicity_of_odd_rows(spark):
    rows = [(1, "what an idiot"), (1, "what an idiot"), (None, "idiot"), (2, None), (3, ""), (4, "word " * 50_000 + "scum")]
    got = toxicity.score_texts(odd(spark, rows), toxicity.Model()).collect()
    assert len(got) == 6 and sorted(r["matched_words"] for r in got) == [0, 0, 1, 1, 1, 1]
    assert toxicity.score_texts(odd(spark, []), toxicity.Model()).count() == 0
    kept = toxicity.without_toxic(odd(spark, rows), toxicity.Model(factors=(-4.0, 5.0, 1.0)))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, None), (3, "")]
    assert kept.columns == odd(spark, rows).columns


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 0)], "doc_id long, toxic int")
    assert toxicity.fit(odd(spark, [(1, "a"), (2, "b"), (None, "c")]), labels) == toxicity.Model()
    assert toxicity.fit(odd(spark, []), labels.limit(0)) == toxicity.Model()


def test_learns_a_word_beginning(spark):
    docs = [(i, f"plain w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} words" + (f" zork{chr(97 + i % 23)}um" if i % 3 == 0 else "")) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    model = toxicity.fit(odd(spark, docs), labels)
    assert any(term.startswith(" zork") for term in model.lexicon)
    assert model.score(toxicity.features(*toxicity.weigh(model.automaton(), "some zorkxxum here")[::2])) > 0.7


def brute_marginals(e, t, s):
    total = np.zeros(e.shape)
    for path in itertools.product(range(e.shape[1]), repeat=len(e)):
        w = np.exp(s[path[0]] + sum(e[i, p] for i, p in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
        for i, p in enumerate(path):
            total[i, p] += w
    return total / total.sum(1, keepdims=True)


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(4)
    lengths = np.array([1, 2, 5, 7])
    e, t, s = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    want = np.concatenate([brute_marginals(part, t, s) for part in np.split(e, np.cumsum(lengths)[:-1])])
    for block in (1, 2, 3, 64):
        assert np.allclose(language.marginals(e, lengths, t, s, block), want)


def test_pairs_equal_all_paths():
    rng = np.random.default_rng(6)
    e, t, s = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    want = np.zeros((3, 3))
    total = 0.0
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(s[path[0]] + sum(e[i, p] for i, p in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
        total += w
        for a, b in itertools.pairwise(path):
            want[a, b] += w
    lengths = np.array([4])
    got = language._pairs(e, language.marginals(e, lengths, t, s), lengths, t, s, np.arange(3))
    assert np.allclose(got, want / total)


def test_language(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(language.learnable(docs), sample_per_lang=150, epochs=3)
    found = language.classify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(queries.key_crc("doc_id") % 5 == 0).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.98
    words = {r["lang"]: r["text"] for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    mixed = " ".join(words["en"].split()[:60]) + " " + " ".join(words["de"].split()[:60])
    rows = [(1, mixed), (1, mixed), (2, None), (3, ""), (4, "12 !?"), (None, words["fr"]), (5, words["es"] * 20)]
    got = language.classify(odd(spark, rows), model, segments=True).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and [by_id[k]["lang_pred"] for k in (2, 3, 4, None, 5)] == ["und", "und", "und", "fr", "es"]
    spans = by_id[1]["segments"]
    assert spans[0]["lang"] == "en" and spans[-1]["lang"] == "de" and 0.3 < by_id[1]["score"] < 0.75
    assert language.classify(odd(spark, []), model).count() == 0


def test_language_without_teachers(spark):
    model = language.fit(odd(spark, []))
    assert [tuple(r) for r in language.classify(odd(spark, [(1, "word")]), model).collect()] == [(1, "und", 0.0)]
    docs = spark.createDataFrame([(1, "one two", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    only = language.classify(docs, language.fit(docs)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in only} == {1: "en", 2: "und", 3: "und"}
