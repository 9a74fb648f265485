"""The near-copy stage against exact Jaccard components, without a border around the limit."""

import random
from collections import defaultdict

import pytest

from merchlake.llm import simhash

SMALL = "/root/testdata/sf0.01"


def runs(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def exact_stays(docs):
    """Ids of the least document of each component of pairs at 0.8 or more; only pairs that share a run are compared."""
    docs = sorted(docs)
    sets = [runs(t) for _, t in docs]
    holders = defaultdict(set)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in set().union(*(holders[r] for r in s or [None])):
            if not s or len(s & sets[j]) / len(s | sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for r in s or [None]:
            holders[r].add(i)
    return {k for i, (k, _) in enumerate(docs) if find(i) == i}


def pair(rng, name, shared, own):
    """Two texts of one line, with `own` more words each at the end: shared - 4 common runs, `own` of their own."""
    line = [f"{name}w{i}" for i in range(shared)]
    return [" ".join([*line, *(f"{name}{side}{rng.random()}" for _ in range(own))]) for side in "ab"]


def stays(spark, docs):
    return {r["doc_id"] for r in simhash.without_near_copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}


def test_stage_equals_exact_components(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"] for r in simhash.without_near_copies(docs).collect()}
    assert got == exact_stays([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("tree_size", [1024, 4])
def test_pairs_beside_the_limit(spark, monkeypatch, tree_size):
    # 240 common runs; 30 own ones a side give 240 / 300 = 0.8, 31 give 0.795 and 28 give 0.811.
    monkeypatch.setattr(simhash, "TREE_SIZE", tree_size)
    rng = random.Random(5)
    docs = []
    for k in range(60):
        docs += [(len(docs) + i, t) for i, t in enumerate(pair(rng, f"p{k}", 244, (28, 30, 31)[k % 3]))]
    got = stays(spark, docs)
    assert got == exact_stays(docs) and len(got) == 80


def test_large_group_over_several_trees(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE_SIZE", 8)
    monkeypatch.setattr(simhash, "TREE_BYTES", 20_000)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for k in range(150):
        own = list(base)
        for _ in range(rng.choice([0, 2, 5, 9])):
            own[rng.randrange(300)] = f"x{rng.random()}"
        docs.append((k, " ".join(own)))
    assert stays(spark, docs) == exact_stays(docs)


def test_lines_repeated_differently_often(spark):
    # 426 common runs of 430, however often the paragraph comes.
    rng = random.Random(7)
    docs = []
    for k in range(30):
        text, line = ([f"{c}{k}w{rng.randrange(10**9)}" for _ in range(n)] for c, n in (("t", 400), ("l", 30)))
        docs += [(len(docs), " ".join(text + line)), (len(docs) + 1, " ".join(text + line * (10, 20, 40)[k % 3]))]
    assert stays(spark, docs) == exact_stays(docs) == set(range(0, 60, 2))


def test_short_sets_are_not_cut_by_the_radius(spark):
    # Four runs of five: the fingerprints differ in 12 bits on average, in more than 20 for one pair in 200.
    docs = []
    for k in range(2000):
        line = [f"s{k}w{i}" for i in range(9)]
        docs += [(len(docs), " ".join(line)), (len(docs) + 1, " ".join(line[:8]))]
    assert stays(spark, docs) == set(range(0, 4000, 2))


def test_columns_of_any_name_stay_as_they_are(spark):
    text = " ".join(f"w{i}" for i in range(60))
    data = [(1, text, 7, "a", "x"), (2, text, 8, "b", "y"), (3, "else " * 3 + text[:40], None, None, "z")]
    docs = spark.createDataFrame(data, "doc_id long, text string, _row long, node string, `a.b` string")
    out = simhash.without_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == [data[0], data[2]]
