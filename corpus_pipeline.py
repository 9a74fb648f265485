"""From raw documents to token ids: five stages, each of which works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import bpe, decontaminate, simhash, surrogates, toxicity
from merchlake.llm.common import read
from merchlake.llm.queries import surrogate_key, tokenizer_path
from merchlake.session import scratch_path, tune

# No SQL: scores are learned, and near copies, items and tokens have no SQL form. Compared with brute force in the tests.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what scores below 0.7; learned from the labels that op4 may use. NULL and empty texts score as harmless; repeated rows stay."""
    tune(spark)
    model = toxicity.fit(docs, toxicity.trained_part(read(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, model, limit=0.7)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five-word runs, similarity 0.8 or more)."""
    tune(spark)
    return simhash.without_near_copies(docs, words=5, similarity=0.8)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without an item of the benchmark. NULL and empty texts hold none; repeated rows are judged alike."""
    tune(spark)
    return decontaminate.without_items(docs, read(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with surrogates in their texts; n_chars follows the new text and stays NULL where it was."""
    tune(spark)
    changed = surrogates.replace_personal_data(docs, surrogate_key(spark))
    return changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with the digest of the text they decode to. NULL and empty texts have no ids; repeated rows stay."""
    tune(spark)
    encoded = bpe.encode_texts(docs, tokenizer_path())
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_items),
    ("surrogates", replace_personal_data),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written to the shared folder and read again by the next."""
    tune(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
