import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from merchlake.operators import retrieval


def vectors(n, dims=8, seed=1):
    return [[float(x) for x in v] for v in np.random.default_rng(seed).normal(size=(n, dims)).round(3)]


def frame(spark, data, key):
    return spark.createDataFrame(list(enumerate(data)), f"{key} BIGINT, vector ARRAY<DOUBLE>")


def brute(corpus, queries, k, min_score=None):
    found = []
    for q, a in enumerate(queries):
        scored = []
        for i, b in enumerate(corpus):
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            if norm:
                score = round(float(np.dot(a, b) / norm), 6)
                if min_score is None or score >= min_score:
                    scored.append((-score, i))
        found += [(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return found


def close(got, wanted):
    got, wanted = sorted(map(tuple, got)), sorted(wanted)
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in wanted]
    assert all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, wanted))


def test_matrix_and_block_routes_equal_brute_force(spark):
    corpus, queries = vectors(120) + [[0.0] * 8], vectors(30, seed=2)
    c, q = frame(spark, corpus, "id").repartition(5), frame(spark, queries, "query_id")
    close(retrieval.nearest(c, q, 4).collect(), brute(corpus, queries, 4))
    close(retrieval.nearest(c, q, 4, query_rows=7, block_rows=25).collect(), brute(corpus, queries, 4))
    close(retrieval.nearest(c, q, 9, min_score=0.4).collect(), brute(corpus, queries, 9, 0.4))


def test_ties_zero_vectors_and_no_queries(spark):
    c = frame(spark, [[1.0, 0.0], [0.0, 0.0], [2.0, 0.0], [0.0, 1.0]], "id")
    q = frame(spark, [[3.0, 0.0], [0.0, 0.0]], "query_id")
    assert rows(retrieval.nearest(c, q, 2)) == [(0, 0, 1.0, 1), (0, 2, 1.0, 2)]
    assert retrieval.nearest(c, q.limit(0), 2).count() == 0


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a ARRAY<FLOAT>, b ARRAY<FLOAT>")
    got = [r[0] for r in df.select(F.round(retrieval.cosine(F.col("a"), F.col("b")), 6)).collect()]
    assert got == [1.0, 0.0, None]


def test_cells_find_most_neighbours(spark):
    corpus, queries = vectors(400), vectors(10, seed=3)
    c, q = frame(spark, corpus, "id"), frame(spark, queries, "query_id")
    centres = retrieval.cell_centres(c, 6)
    placed = retrieval.assign_cells(c, centres).withColumn("cell", F.col("cells")[0])
    exact = retrieval.nearest(c, q, 5)
    everything = retrieval.nearest_in_cells(placed, q, centres, 5, probes=6)
    assert rows(everything) == rows(exact)
    some = retrieval.nearest_in_cells(placed, q, centres, 5, probes=3)
    mean = retrieval.recall(some, exact).agg(F.avg("recall")).first()[0]
    assert 0.6 < mean <= 1.0


def test_contexts(spark):
    hits = spark.createDataFrame(
        [(1, 2, "b.pdf", 7, "second"), (1, 1, "a.pdf", 3, "first")],
        "query_id INT, rank INT, source_file STRING, page INT, chunk_text STRING",
    )
    assert retrieval.context_blocks(hits).first()["context"] == (
        "[Source 1: a.pdf, page 3]\nfirst\n\n[Source 2: b.pdf, page 7]\nsecond"
    )


def test_index_refresh_touches_only_changed_chunks(spark):
    text = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "4")], "chunk_id STRING, chunk_text STRING")
    index = spark.createDataFrame([("a", "1", [1.0]), ("b", "old", [2.0]), ("c", "3", [3.0])], "chunk_id STRING, t STRING, embedding ARRAY<DOUBLE>")
    index = index.select("chunk_id", F.sha2("t", 256).alias("text_hash"), "embedding")
    plan = retrieval.index_changes(index, text)
    assert rows(plan.select("chunk_id", "action")) == [("b", "update"), ("c", "delete"), ("d", "insert")]
    fresh = spark.createDataFrame([("b", [9.0]), ("d", [8.0])], "chunk_id STRING, embedding ARRAY<DOUBLE>")
    after = retrieval.apply_index_changes(index, plan, fresh)
    assert {r["chunk_id"]: r["embedding"] for r in after.collect()} == {"a": [1.0], "b": [9.0], "d": [8.0]}
    assert retrieval.index_changes(after, text).count() == 0


def test_vector_problems(spark):
    chunks = spark.createDataFrame([("a",), ("b",), ("c",)], "chunk_id STRING")
    table = spark.createDataFrame([("a", [0.0, 0.0]), ("b", None), ("x", [1.0])], "chunk_id STRING, embedding ARRAY<DOUBLE>")
    assert tuple(retrieval.vector_problems(chunks, table).first()) == (1, 1, 1, 1, 1, 2)


def test_sweep(spark):
    hits = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.2, 2), (2, 20, 0.5, 1)], "query_id INT, item INT, score DOUBLE, rank INT")
    truth = spark.createDataFrame([(1, 11), (2, 20), (2, 21)], "query_id INT, item INT")
    got = {(r["k"], r["min_score"]): (r["hit_rate"], r["recall"]) for r in
           retrieval.sweep_quality(hits, truth, [1, 2], [0.0, 0.3]).collect()}
    assert got == {(1, 0.0): (0.5, 0.25), (2, 0.0): (1.0, 0.75), (1, 0.3): (0.5, 0.25), (2, 0.3): (0.5, 0.25)}
