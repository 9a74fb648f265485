"""Residue arithmetic and hard negatives against plain whole-number products."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from merchlake.llm import negatives

VECTORS = "vec_id long, label int, embedding array<double>, place string, rank string, id string"


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for dims, size in [(1, 3), (64, 150), (64, 2**15 - 1), (300, 500), (700, 2**31), (5, 2**52), (3, 0)]:
        a, c = (rng.integers(-size, size + 1, (n, dims)).astype(float) for n in (7, 11))
        want = [[max(-negatives.LARGEST, min(negatives.LARGEST, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for q in c] for p in a]
        assert negatives.exact_scores(a, c).tolist() == want
    assert negatives.exact_scores(np.ones((1, 3)), np.full((1, 2), 4.0)).tolist() == [[8]]
    assert negatives.exact_scores(np.ones((2, 0)), np.ones((1, 2))).tolist() == [[0], [0]]


def test_sums_of_residues_stay_exact_in_float32():
    for dims in (1, 2, 64, 255, 256, 5000):
        width, primes = negatives.primes_for(dims, 10**12)
        assert len(set(primes)) == len(primes) and math.prod(primes) > 2 * 10**12
        assert all(width * ((p - 1) // 2) ** 2 <= 2**24 for p in primes)


def brute(rows, asks, n_pos, n_neg):
    whole = [
        (i, label, [max(-(2**63), min(2**63, math.floor(256.0 * x))) for x in v], v) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, w, v in whole:
        if asks(i) and (i not in anchors or (v, label) < anchors[i][2:]):
            anchors[i] = (w, label, v, label)
    out = []
    for anchor, (w, label, *_) in anchors.items():
        scored = sorted(
            (-max(-negatives.LARGEST, min(negatives.LARGEST, sum(a * b for a, b in zip(w, x, strict=False)))), i, other)
            for i, other, x, _ in whole if i != anchor
        )
        for p, positive, _ in [s for s in scored if s[2] == label][:n_pos]:
            fit = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(anchor, positive, r, n, -p, -s) for r, (s, n, _) in enumerate(fit[:n_neg], 1)]
    return sorted(out)


def made_rows():
    rng = random.Random(6)
    rows = [(i, rng.choice([0, 0, 1, 2, None]), [rng.choice([0.1, -0.2, 0.5, rng.uniform(-1, 1)]) for _ in range(rng.choice([6, 6, 6, 4]))])
            for i in range(300)]
    rows += [(7, 1, None), (None, 1, [1.0]), (8, 1, [None, 1.0]), (9, 1, [float("nan")]), (10, 0, [float("inf")]), (11, 0, []), (50, 0, []),
             (12, 1, [1e300, -1e300]), (13, 0, [2e4] * 9)]
    rows += rows[40:70] + rows[50:51] * 3 + [(60, 2, [0.5] * 6)]
    return rows


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rows = made_rows()
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], VECTORS)
    for numbers in (2**21, 40):  # the second cuts blocks of a few rows
        monkeypatch.setattr(negatives, "BLOCK_NUMBERS", numbers)
        got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, positives=4, negatives=3)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0, 4, 3)


def test_groups_of_any_number(spark, monkeypatch):
    rows = [r for r in made_rows() if r[2] is not None]
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], VECTORS)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "GROUP_BYTES", 1000)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0, 5, 10)


def test_empty_tables_and_no_anchor(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).collect() == []
    one = spark.createDataFrame([(10, 1, [1.0], "", "", "")], VECTORS)
    assert negatives.hard_negatives(one, F.col("vec_id") % 10 == 0).collect() == []
    assert negatives.hard_negatives(one, F.lit(False)).collect() == []
