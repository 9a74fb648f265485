"""Hard negatives by exact scores from a residue number system.

Components are whole numbers. For each of a few small primes the two matrices
are taken modulo the prime and multiplied in float32, where all sums stay below
2^24 and are hence exact; the Chinese remainder theorem turns the residues of a
score into the score itself. A first pass over all rows finds each anchor's
positives, a second one the rows in the windows that the positives' scores set.

Rows are packed into blocks, blocks into groups of bounded size. A task gets one
group of anchors and one of candidates and multiplies them tile by tile, so a
row crosses the network once for each group of the other side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.session import stored

LARGEST = 2**63 - 1
EXACT = 2**24  # float32 holds all whole numbers up to here
BLOCK, BLOCK_NUMBERS = 1024, 2**21  # rows and components of a block
GROUP_BYTES = 32 * 1024 * 1024  # packed bytes of a group, on either side of a task
TILE = 2**21  # scores held at once

PACKED = "block long, n int, dims int, ids binary, labels binary, parts binary, floors binary, ceilings binary"
PACKED_FIELDS = pa.schema([
    ("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("parts", pa.binary()), ("floors", pa.binary()), ("ceilings", pa.binary()),
])


# ---- residues

def _is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, math.isqrt(n) + 1))


@lru_cache
def primes_for(dims: int, bound: int) -> tuple[int, tuple[int, ...]]:
    """Columns multiplied at a time, and the largest primes whose product exceeds 2 x bound.

    With residues of at most (p - 1) / 2 in size, a sum over so many columns stays within float32's whole numbers.
    """
    width = max(1, min(dims, 256))
    p, found, product = 2 * math.isqrt(EXACT // width) + 1, [], 1
    while product <= 2 * bound:
        if _is_prime(p):
            found.append(p)
            product *= p
        p -= 1
        if p < 3:
            raise ValueError("not enough primes for scores of this size")
    return width, tuple(found)


def residues(parts: np.ndarray, p: int) -> np.ndarray:
    """Whole-number float64 components modulo p, from -(p - 1) / 2 to (p - 1) / 2, in float32."""
    r = np.fmod(parts, p)
    half = (p - 1) // 2
    r[r > half] -= p
    r[r < -half] += p
    return r.astype(np.float32)


def scores_modulo(a: np.ndarray, c: np.ndarray, p: int, width: int) -> np.ndarray:
    """a x c transposed, modulo p, in 0 .. p - 1."""
    out = np.zeros((len(a), len(c)), np.int32)
    for i in range(0, a.shape[1], width):
        out += (a[:, i : i + width] @ c[:, i : i + width].T).astype(np.int32) % np.int32(p)
    return out % np.int32(p)


def reconstruct(remainders: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Signed numbers from their remainders: mixed-radix digits one prime at a time. Beyond 64 bits they are cut."""
    product = math.prod(primes)
    wide = product >= 2**62
    value = remainders[0].astype(object if wide else np.int64)
    radix = primes[0]
    for r, p in zip(remainders[1:], primes[1:], strict=True):
        inverse = pow(radix % p, -1, p)
        digit = (r.astype(np.int64) - (value % p).astype(np.int64)) * inverse % p
        value = value + digit.astype(value.dtype) * radix
        radix *= p
    value = np.where(value > product // 2, value - product, value)
    return np.clip(value, -LARGEST, LARGEST).astype(np.int64) if wide else value


def exact_scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows (float64), as int64, cut at 64 bits."""
    dims = min(a.shape[1], c.shape[1])
    if not dims or not a.size or not c.size:
        return np.zeros((len(a), len(c)), np.int64)
    a, c = a[:, :dims], c[:, :dims]
    bound = dims * int(np.abs(a).max()) * int(np.abs(c).max())
    width, primes = primes_for(dims, 1 << max(1, bound).bit_length())
    return reconstruct([scores_modulo(residues(a, p), residues(c, p), p, width) for p in primes], primes)


# ---- packing

def _pack(rows: list[tuple], block: int) -> tuple:
    ids, labels, vectors, lows, highs = zip(*rows, strict=True)
    dims = max(len(v) for v in vectors)
    parts = np.zeros((len(rows), dims))
    for i, v in enumerate(vectors):
        parts[i, : len(v)] = v
    # Components stay 64-bit numbers: floor(256 x) is cut there.
    with np.errstate(over="ignore"):
        parts = np.clip(np.floor(256.0 * parts), -(2.0**63), 2.0**63)
    small = np.abs(parts).max(initial=0) < 2**15
    held = parts.astype("<i2" if small else "<f8")
    windows = [b"".join(np.array(w, "<i8").tobytes() for w in side) if side[0] is not None else None for side in (lows, highs)]
    return (block, len(rows), dims, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), held.tobytes(), *windows)


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number, rows, dims = TaskContext.get().partitionId(), 0, [], 0

    def flush() -> pa.RecordBatch:
        packed = _pack(rows, (task << 32) + number)
        return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(packed, PACKED_FIELDS, strict=True)], schema=PACKED_FIELDS)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            longest = max(dims, len(row[2]))
            if rows and (len(rows) == BLOCK or longest * (len(rows) + 1) > BLOCK_NUMBERS):
                yield flush()
                number, rows, longest = number + 1, [], len(row[2])
            rows.append(row)
            dims = longest
    if rows:
        yield flush()


class Tile(NamedTuple):
    """Rows of equal length out of some blocks."""

    ids: np.ndarray
    labels: np.ndarray
    parts: np.ndarray
    floors: np.ndarray | None
    ceilings: np.ndarray | None


def tiles(table: pa.Table, rows: int) -> Iterator[Tile]:
    """The rows of packed blocks, so many at a time."""
    by_dims: dict[int, list[dict]] = {}
    for block in table.select(PACKED_FIELDS.names).to_pylist():
        by_dims.setdefault(block["dims"], []).append(block)
    for dims, blocks in sorted(by_dims.items()):

        def numbers(name: str, blocks: list[dict] = blocks) -> np.ndarray:
            return np.concatenate([np.frombuffer(b[name], "<i8").reshape(b["n"], -1) for b in blocks])

        def parts(block: dict, dims: int = dims) -> np.ndarray:
            kind = "<i2" if len(block["parts"]) == 2 * block["n"] * dims else "<f8"
            return np.frombuffer(block["parts"], kind).reshape(block["n"], dims)

        ids, labels = numbers("ids")[:, 0], numbers("labels")[:, 0]
        vectors = np.concatenate([parts(b) for b in blocks])
        windows = [numbers(x) for x in ("floors", "ceilings")] if blocks[0]["floors"] is not None else None
        for i in range(0, len(ids), rows):
            at = slice(i, i + rows)
            yield Tile(ids[at], labels[at], vectors[at].astype(np.float64), *([w[at] for w in windows] if windows else (None, None)))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id: partition selection, then a sort of what is left."""
    if len(scores) > k:
        near = np.nonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])[0]
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


FOUND = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])


def _selector(k: int, same: bool):
    """Per task: the k best same-label rows of each anchor, or the k best other-label rows in each of its windows."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for c in tiles(candidates, 8192):
            for a in tiles(anchors, TILE // 8192):
                for i, row in enumerate(exact_scores(a.parts, c.parts)):
                    at = np.nonzero(((c.labels == a.labels[i]) == same) & (c.ids != a.ids[i]))[0]
                    mine = row[at]
                    ranges = [(None, None)] if same else zip(a.floors[i], a.ceilings[i], strict=True)
                    for place, (low, high) in enumerate(ranges):
                        inside = at if low is None else at[(mine >= low) & (mine <= high)]
                        best = inside[_best(row[inside], c.ids[inside], k)]
                        out[0].append(np.full(len(best), a.ids[i]))
                        out[1].append(np.full(len(best), place, np.int32))
                        out[2].append(c.ids[best])
                        out[3].append(row[best])
        columns = [np.concatenate(x) if x else [] for x in out]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, FOUND, strict=True)], schema=FOUND)

    return run


def _meet(anchors: DataFrame, candidates: DataFrame, across: int, down: int, k: int, same: bool) -> DataFrame:
    """Every group of anchors with every group of candidates; `down` x `across` tasks."""

    def dealt(blocks: DataFrame, own: str, groups: int, other: str, copies: int) -> DataFrame:
        numbered = blocks.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    left = dealt(anchors, "_down", down, "_across", across).groupBy("_down", "_across")
    right = dealt(candidates, "_across", across, "_down", down).groupBy("_down", "_across")
    return left.cogroup(right).applyInArrow(_selector(k, same), "anchor_id long, place int, other_id long, score long")


def _groups(blocks: DataFrame, least: int = 1) -> int:
    size = blocks.agg(F.sum(F.octet_length("parts"))).first()[0] or 0
    return max(least, math.ceil(size / GROUP_BYTES))


def _packed(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_packer, PACKED)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_pct: int = 30,
    high_pct: int = 90,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as floor(256 x) of x as double, cut at 64 bits; a score is
    their inner product, cut at 64 bits as well. An anchor's positives are its
    best other rows of the same label; for each, the best rows of other labels
    with low_pct * positive_score <= 100 * score <= high_pct * positive_score are
    its negatives. Higher scores come first, ties go to the smaller id.

    Rows with a NULL id, label or vector, or with a NULL, NaN or infinite
    component, take no part; vectors may differ in length, a missing component
    counts as 0. Of anchors with a repeated id that with the least (vector, label)
    counts, and no row of its own id is its positive or negative; other repeated
    rows can each take a rank. A negative positive_score leaves an empty window.
    Empty tables give an empty result. Only the named columns are read.
    """
    rows = vectors.select(
        vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("long").alias("label"),
        vectors[vector_col].cast("array<double>").alias("vector"), is_anchor.alias("asks"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    nothing = F.lit(None).cast("array<long>")
    candidates = stored(_packed(rows.select("id", "label", "vector", nothing.alias("lows"), nothing.alias("highs"))))
    anchors = stored(
        rows.where("asks").groupBy("id").agg(F.min(F.struct("vector", "label")).alias("a")).select("id", "a.label", "a.vector")
    )

    asked = _packed(anchors.select("id", "label", "vector", nothing.alias("lows"), nothing.alias("highs")))
    down = _groups(asked)
    across = _groups(candidates, max(1, vectors.sparkSession.sparkContext.defaultParallelism // down))
    order = [F.desc("score"), F.asc("other_id")]
    first = _meet(asked, candidates, across, down, positives, same=True)
    best = Window.partitionBy("anchor_id").orderBy(*order)
    chosen = first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    chosen = stored(chosen.select("anchor_id", (F.col("place") - 1).alias("place"), F.col("other_id").alias("positive_id"),
                                F.col("score").alias("positive_score")))

    # 100 s >= low x p holds for s >= ceil(low x p / 100), 100 s <= high x p for s <= floor(high x p / 100).
    def share(pct: int) -> Column:
        return F.col("positive_score").cast("decimal(38,0)") * F.lit(pct).cast("decimal(9,0)") / F.lit(100)

    limits = chosen.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "place", F.ceil(share(low_pct)).cast("long").alias("low"), F.floor(share(high_pct)).cast("long").alias("high"))
        )).alias("w")
    )
    none = F.struct(F.lit(0).alias("place"), F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    padded = F.slice(F.concat("w", F.array_repeat(none, positives)), 1, positives)  # an empty window where positives are few
    asked = _packed(
        anchors.join(limits.withColumn("w", padded), F.col("id") == F.col("anchor_id")).select(
            "id", "label", "vector", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    )
    second = _meet(asked, candidates, across, down, negatives, same=False)
    best = Window.partitionBy("anchor_id", "place").orderBy(*order)
    ranked = second.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
