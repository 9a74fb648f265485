"""Vector search, index upkeep and answer contexts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.functions.scalars import words

QUERY_ROWS = 1024
BLOCK_ROWS = 20_000
BLOCK_BYTES = 16 * 1024 * 1024
BUCKETS = 16
DIGITS = 6


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays in double precision; NULL when either has no length."""
    dot = F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    return dot / F.nullif(_norm(a) * _norm(b), F.lit(0.0))


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _unit(vectors: Sequence) -> np.ndarray:
    """Rows scaled to length one; rows without length become NaN."""
    matrix = np.asarray([np.asarray(v, dtype=np.float64) for v in vectors])
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(length > 0, matrix / length, np.nan)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, smaller id first on ties, NaN left out."""
    usable = np.flatnonzero(~np.isnan(scores))
    if len(usable) > 4 * k:
        floor = np.partition(scores[usable], len(usable) - k)[len(usable) - k]
        usable = usable[scores[usable] >= floor]
    order = np.lexsort((ids[usable], -scores[usable]))[:k]
    return usable[order]


def _score_block(query_ids, query_units, ids, units, k, min_score) -> pd.DataFrame:
    """The block's k best rows for every query."""
    empty = pd.DataFrame({"query_id": [], "id": [], "score": []}).astype(
        {"query_id": "int64", "id": "int64", "score": "float64"}
    )
    if len(ids) == 0 or len(query_ids) == 0:
        return empty
    scores = np.round(query_units @ units.T, DIGITS)
    if min_score is not None:
        scores[scores < min_score] = np.nan
    parts = []
    for row, query in enumerate(query_ids):
        best = _best(scores[row], ids, k)
        parts.append(pd.DataFrame({"query_id": query, "id": ids[best], "score": scores[row][best]}))
    return pd.concat(parts)


def _packed(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of (id, vector) rows that share a bucket: unit vectors and ids as bytes, at most BLOCK_BYTES of vectors."""

    def block(bucket: int, ids: list, vectors: list) -> pd.DataFrame:
        units = _unit(vectors)
        packed = (bucket, np.array(ids, dtype="int64").tobytes(), units.tobytes(), units.shape[1])
        return pd.DataFrame([packed], columns=["bucket", "ids", "units", "dims"])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_blocks: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for bucket, key, vector in zip(batch["bucket"], batch["id"], batch["vector"]):
                ids, vectors = open_blocks.setdefault(int(bucket), ([], []))
                ids.append(key)
                vectors.append(vector)
                if len(ids) >= block_rows or len(ids) * len(vector) * 8 >= BLOCK_BYTES:
                    yield block(int(bucket), *open_blocks.pop(int(bucket)))
        for bucket, (ids, vectors) in open_blocks.items():
            yield block(bucket, ids, vectors)

    return rows.mapInPandas(pack, "bucket BIGINT, ids BINARY, units BINARY, dims INT")


def _meeting(corpus: DataFrame, queries: DataFrame, k: int, min_score: float | None) -> DataFrame:
    """Every query block meets the corpus blocks of its bucket; each meeting hands on k rows per query, k per query stay."""
    asked = queries.select("bucket", *[F.col(c).alias(f"q_{c}") for c in ("ids", "units", "dims")])
    pairs = asked.join(corpus, "bucket").drop("bucket").repartition(F.xxhash64("q_ids"), F.xxhash64("ids"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                query_units = np.frombuffer(row.q_units).reshape(-1, row.q_dims)
                units = np.frombuffer(row.units).reshape(-1, row.dims)
                yield _score_block(np.frombuffer(row.q_ids, "int64"), query_units, np.frombuffer(row.ids, "int64"), units, k, min_score)

    found = pairs.mapInPandas(meet, "query_id BIGINT, id BIGINT, score DOUBLE")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        .select("query_id", "id", "score", "rank")
    )


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 4,
    min_score: float | None = None,
    query_rows: int = QUERY_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact k nearest corpus rows per query by cosine, at least `min_score`.

    `corpus` is (id BIGINT, vector), `queries` (query_id BIGINT, vector).
    Scores are rounded to six places, ties go to the smaller id, vectors
    without length are never returned.

    Both sides are packed into blocks where they lie; then every query block is
    sent to every corpus block, whatever the number of queries. A block is sent
    as bytes, and each meeting hands on k rows per query.
    """
    packed = _packed(corpus.select(F.col("id").cast("bigint").alias("id"), "vector", F.lit(0).alias("bucket")), block_rows)
    packed = packed.withColumn("bucket", F.pmod(F.xxhash64("ids"), F.lit(BUCKETS)).cast("bigint"))
    asked = _packed(queries.select(F.col("query_id").cast("bigint").alias("id"), "vector", F.lit(0).alias("bucket")), query_rows)
    asked = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(BUCKETS - 1).cast("bigint"))))
    return _meeting(packed, asked, k, min_score)


def cell_centres(corpus: DataFrame, cells: int, seed: int = 42, fraction: float = 1.0, rounds: int = 10) -> list[list[float]]:
    """Centres of `cells` clusters of the unit vectors, learnt distributedly, optionally on a sample."""
    rows = corpus if fraction >= 1.0 else corpus.sample(fraction, seed)
    units = Normalizer(inputCol="_v", outputCol="features").transform(
        rows.select(array_to_vector(F.col("vector").cast("array<double>")).alias("_v"))
    )
    model = KMeans(k=cells, seed=seed, maxIter=rounds).fit(units)
    return [[float(x) for x in c] for c in model.clusterCenters()]


def assign_cells(rows: DataFrame, centres: list[list[float]], probes: int = 1, name: str = "cells") -> DataFrame:
    """Add the numbers of the `probes` closest cells of each row's vector, closest first."""
    matrix = np.array(centres)

    @F.pandas_udf("array<int>")
    def closest(vectors: pd.Series) -> pd.Series:
        units = np.nan_to_num(_unit(vectors))
        distance = (matrix**2).sum(axis=1)[None, :] - 2 * units @ matrix.T
        return pd.Series(list(np.argsort(distance, axis=1, kind="stable")[:, :probes].astype("int32")))

    return rows.withColumn(name, closest("vector"))


def nearest_in_cells(
    indexed: DataFrame, queries: DataFrame, centres: list[list[float]], k: int = 4, probes: int = 2,
    query_rows: int = QUERY_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate k nearest: each query looks only into its `probes` closest cells.

    `indexed` is (id, vector, cell), best stored partitioned by cell so that
    unprobed cells are never read. Scoring inside the cells is exact. Queries and
    rows are packed by cell and meet on the cell number; the blocks of a large
    cell are dealt over all tasks.
    """
    placed = assign_cells(queries.select(F.col("query_id").cast("bigint").alias("id"), "vector"), centres, probes)
    wanted = placed.select("id", "vector", F.explode(F.col("cells").cast("array<bigint>")).alias("bucket"))
    # As many rows as there are cells at most, hence safe to broadcast.
    probed = F.broadcast(wanted.select(F.col("bucket").alias("cell")).distinct())
    rows = indexed.join(probed, "cell", "left_semi").select(
        F.col("id").cast("bigint").alias("id"), "vector", F.col("cell").cast("bigint").alias("bucket")
    )
    return _meeting(_packed(rows, block_rows), _packed(wanted, query_rows), k, None)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found, per query."""
    hits = exact.select("query_id", "id").join(
        approximate.select("query_id", "id", F.lit(1).alias("_hit")), ["query_id", "id"], "left"
    )
    return hits.groupBy("query_id").agg(F.round(F.count("_hit") / F.count(F.lit(1)), 4).alias("recall"))


def context_blocks(hits: DataFrame, source: str = "source_file", page: str = "page", text: str = "chunk_text"):
    """Retrieved chunks of each query (k rows, ranked) as one numbered context text."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", source, page, text)))
    block = lambda c: F.concat(
        F.lit("[Source "), c["rank"].cast("string"), F.lit(": "), c[source].cast("string"), F.lit(", page "),
        c[page].cast("string"), F.lit("]\n"), c[text],
    )
    return hits.groupBy("query_id").agg(F.array_join(F.transform(ordered, block), "\n\n").alias("context"))


def index_changes(index: DataFrame, chunks: DataFrame, key: str = "chunk_id", text: str = "chunk_text") -> DataFrame:
    """What an incremental refresh has to do: chunks to embed (new or changed) and entries to drop.

    `index` carries the hash of the text it was built from.
    """
    fresh = chunks.select(key, F.sha2(text, 256).alias("_new"))
    paired = index.select(key, F.col("text_hash").alias("_old")).join(fresh, key, "full_outer")
    action = (
        F.when(F.col("_new").isNull(), "delete")
        .when(F.col("_old").isNull(), "insert")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return paired.select(key, action.alias("action"), F.col("_new").alias("text_hash")).where("action IS NOT NULL")


def apply_index_changes(index: DataFrame, plan: DataFrame, embedded: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Next index: untouched entries stay, dropped ones go, `embedded` supplies the new vectors."""
    untouched = index.join(plan.select(key), key, "left_anti")
    renewed = plan.where("action <> 'delete'").select(key, "text_hash").join(embedded, key)
    return untouched.unionByName(renewed.select(*index.columns))


def vector_problems(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id", vector: str = "embedding"):
    """Counts of everything wrong with a vector table, in one row."""
    size = F.size(vector)
    norm = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    side = vectors.select(
        key,
        F.col(vector).isNull().alias("_null"),
        F.when(F.col(vector).isNotNull(), size).alias("_dims"),
        F.coalesce(norm == 0, F.lit(False)).alias("_zero"),
        F.lit(1).alias("_v"),
    )
    both = chunks.select(key, F.lit(1).alias("_c")).join(side, key, "full_outer")
    return both.agg(
        F.count(F.when(F.col("_v").isNull(), 1)).alias("chunks_without_vector"),
        F.count(F.when(F.col("_c").isNull(), 1)).alias("vectors_without_chunk"),
        F.count(F.when(F.col("_null"), 1)).alias("null_vectors"),
        F.count(F.when(F.col("_zero"), 1)).alias("zero_vectors"),
        F.min("_dims").alias("min_dims"),
        F.max("_dims").alias("max_dims"),
    )


def word_vectors(rows: DataFrame, text: str, dims: int = 64) -> DataFrame:
    """Add `vector`: hashed word counts scaled to length one, a stand-in where no embedding model is at hand."""
    counted = HashingTF(numFeatures=dims, inputCol="_words", outputCol="_tf").transform(
        rows.withColumn("_words", words(F.lower(text)))
    )
    scaled = Normalizer(inputCol="_tf", outputCol="_unit").transform(counted)
    return scaled.withColumn("vector", vector_to_array("_unit")).drop("_words", "_tf", "_unit")


def sweep_quality(hits: DataFrame, truth: DataFrame, ks: Sequence[int], min_scores: Sequence[float]) -> DataFrame:
    """Hit rate and recall for every (k, minimum score) over hits retrieved once at the largest k.

    `hits` is (query_id, item, score, rank), `truth` distinct (query_id, item).
    The grid is a short literal list; each hit row is repeated once per setting.
    """
    relevant = truth.groupBy("query_id").agg(F.count(F.lit(1)).alias("_relevant"))
    grid = F.array(
        *[F.struct(F.lit(k).alias("k"), F.lit(float(s)).alias("min_score")) for k in ks for s in min_scores]
    )
    marked = hits.join(truth.withColumn("_good", F.lit(1)), ["query_id", "item"], "left")
    per_item = marked.groupBy("query_id", "item", "_good").agg(F.min("rank").alias("rank"), F.max("score").alias("score"))
    settings = per_item.select("*", F.inline(grid)).where(
        (F.col("rank") <= F.col("k")) & (F.col("score") >= F.col("min_score"))
    )
    found = settings.groupBy("query_id", "k", "min_score").agg(F.count("_good").alias("_found"))
    wanted = relevant.select("*", F.inline(grid))
    scored = wanted.join(found, ["query_id", "k", "min_score"], "left").withColumn(
        "_found", F.coalesce("_found", F.lit(0))
    )
    return scored.groupBy("k", "min_score").agg(
        F.count(F.lit(1)).alias("queries"),
        F.round(F.avg(F.when(F.col("_found") > 0, 1.0).otherwise(0.0)), 4).alias("hit_rate"),
        F.round(F.avg(F.col("_found") / F.col("_relevant")), 4).alias("recall"),
    )
