"""Exact inner-product search by exhaustive term-at-a-time accumulation.

A vector is a sparse row: component j is a term, its whole-number value the
weight. Candidates are packed into blocks of postings (per term: the rows that
hold it and their weights), queries into blocks of sparse rows. Where a query
block meets a candidate block, the terms are walked one after another and their
weighted postings scattered into a dense array of scores; partition selection
then leaves k candidates per query and block, and the blocks' lists are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm.common import Rows

LARGEST, SMALLEST = 2**63 - 1, -(2**63)
# The sizes bound what one task holds: a score array has QUERY_BLOCK x CANDIDATE_BLOCK numbers.
QUERY_BLOCK, CANDIDATE_BLOCK = 256, 8192

PACKED = "ids binary, pos binary, term binary, weight binary, wide boolean"


def _floors(values: list) -> np.ndarray:
    """floor(256 x) of every component; whole numbers of any size where 64 bits could run over."""
    scaled = np.floor(256.0 * np.asarray(values, dtype=np.float64))
    if len(scaled) <= 2**14 and (len(scaled) == 0 or np.abs(scaled).max() <= 2.0**24):
        return scaled.astype(np.int64)
    exact = [int(s) if math.isfinite(s) else math.floor(x) * 256 for s, x in zip(scaled, values, strict=True)]
    return np.array(exact, dtype=object)


def _packer(block: int):
    """Packs (id, vector) rows of a partition into postings sorted by term."""
    schema = pa.schema(
        [("ids", pa.binary()), ("pos", pa.binary()), ("term", pa.binary()), ("weight", pa.binary()), ("wide", pa.bool_())]
    )

    def pack(ids: list, rows: list[np.ndarray]) -> tuple:
        pos = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        term = np.concatenate([np.arange(len(r), dtype=np.int32) for r in rows]) if rows else np.empty(0, np.int32)
        wide = any(r.dtype == object for r in rows)
        weight = np.concatenate(rows) if rows else np.empty(0, np.int64)
        there = weight != 0
        pos, term, weight = pos[there], term[there], weight[there]
        order = np.argsort(term, kind="stable")
        data = "\n".join(map(str, weight[order])).encode() if wide else weight[order].astype("<i8").tobytes()
        return np.array(ids, dtype="<i8").tobytes(), pos[order].tobytes(), term[order].tobytes(), data, wide

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, ids, rows = Rows(schema), [], []
        for batch in batches:
            for key, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(key)
                rows.append(_floors(values))
                if len(ids) == block:
                    yield from out.add(pack(ids, rows), block * 256)
                    ids, rows = [], []
        if ids:
            yield from out.add(pack(ids, rows), block * 256)
        yield from out.flush()

    return run


def _unpack(ids, pos, term, weight, wide):
    numbers = np.array([int(x) for x in weight.split(b"\n") if x], dtype=object) if wide else np.frombuffer(weight, "<i8")
    return np.frombuffer(ids, "<i8"), np.frombuffer(pos, np.int32), np.frombuffer(term, np.int32), numbers


def _scores(query, candidate, wide: bool) -> np.ndarray:
    """Dense scores (query x candidate), one term after another."""
    q_ids, q_pos, q_term, q_weight = query
    c_ids, c_pos, c_term, c_weight = candidate
    scores = np.zeros((len(q_ids), len(c_ids)), dtype=object if wide else np.int64)
    terms, starts = np.unique(q_term, return_index=True)
    ends = np.append(starts[1:], len(q_term))
    for t, a, b in zip(terms, starts, ends, strict=True):
        lo, hi = np.searchsorted(c_term, [t, t + 1])
        if lo == hi:
            continue
        at, w = c_pos[lo:hi], c_weight[lo:hi]
        whole = len(at) == len(c_ids)
        for p, x in zip(q_pos[a:b], q_weight[a:b], strict=True):
            if whole:  # the postings name every row, in order
                scores[p] += x * w
            else:
                scores[p, at] += x * w
    return scores


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id: partition selection, then a sort of what is left."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.nonzero(scores >= limit)[0]
    else:
        near = np.arange(len(scores))
    order = sorted(near.tolist(), key=lambda i: (-int(scores[i]), int(ids[i])))
    return order[:k]


def _meet(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                query, candidate = _unpack(*row[:5]), _unpack(*row[5:10])
                wide = row[4] or row[9]
                if wide:
                    query, candidate = [(*x[:3], x[3].astype(object)) for x in (query, candidate)]
                scores = _scores(query, candidate, wide)
                for i, q in enumerate(query[0]):
                    other = np.nonzero(candidate[0] != q)[0]
                    ids, mine = candidate[0][other], scores[i][other]
                    for j in _best(ids, mine, k):
                        score = min(max(int(mine[j]), SMALLEST), LARGEST)
                        yield from out.add((int(q), int(ids[j]), score))
        yield from out.flush()

    return run


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """The k best candidates of each query: query_id, rank (from 1), vec_id, score.

    A candidate with the query's own id is left out. Vectors that are NULL or
    hold NULL, NaN or infinite components take no part, nor do NULL ids; vectors
    may differ in length, a missing component counts as 0. Ties go to the smaller
    id; a query with fewer than k candidates gets all of them. Of repeated query
    ids the least vector is asked, repeated candidate ids can each take a rank.
    Scores beyond 64 bits are cut to the nearest 64-bit number after ranking
    inside a block. Empty tables give an empty result.

    A query block is sent to every candidate block, as many bytes as the stated
    query set times (candidates / candidate_block).
    """
    def usable(rows: DataFrame) -> DataFrame:
        kept = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return kept.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite)

    names = ["ids", "pos", "term", "weight", "wide"]
    asked = usable(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    packed = usable(vectors).mapInArrow(_packer(candidate_block), PACKED).withColumn("_block", F.pmod(F.xxhash64("ids"), F.lit(16)))
    query_blocks = (
        asked.mapInArrow(_packer(query_block), PACKED)
        .select(*[F.col(n).alias(f"q_{n}") for n in names])
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))))
    )
    pairs = query_blocks.join(packed, F.col("_part") == F.col("_block")).select(*[f"q_{n}" for n in names], *names)
    spread = pairs.repartition(F.xxhash64("q_ids"), F.xxhash64("ids"))
    hits = spread.mapInArrow(_meet(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
