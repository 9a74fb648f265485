"""One registered query for each operator, over its whole table, and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import bpe, decontaminate, language, licences, negatives, repair, rules, sharding, simhash, sql, surrogates, topk
from merchlake.llm import toxicity, warc
from merchlake.llm.common import key_crc, read
from merchlake.session import scratch_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return build

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def surrogate_key(spark: SparkSession) -> str:
    """The key of the surrogates: a secret of the cluster's settings, with a stand-in for trials."""
    return spark.conf.get("spark.merchlake.surrogate.key", "merchlake")


@query("op1_surrogates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_personal_data(docs, surrogate_key(spark), count_col="n_entities")


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(read(spark, sf_dir, "documents"), words=4, radius=4)


@query("op3_licences", sql.LICENCES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(read(spark, sf_dir, "documents"))
    return found.withColumn("notice_ids", F.array_join("notice_ids", ","))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, toxicity.trained_part(labels))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        (key_crc("doc_id") % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "matched_words",
    )


@query("op5_warc", sql.WARC)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    index = warc.merge_index(warc.read_archives(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "position", "capture")


@query("op6_benchmark_items")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(language.learnable(docs))
    found = language.classify(docs, model)
    return found.select("doc_id", (key_crc("doc_id") % 5 == 0).alias("held_out"), "lang_pred", "score")


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.with_id_digest(bpe.encode_texts(read(spark, sf_dir, "documents"), tokenizer_path()))


@query("op9_top_k", sql.TOP_K)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("op10_byte_shards", sql.SHARDS)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(read(spark, sf_dir, "documents"), shards=24)


@query("op11_rule_ledger", sql.RULE_LEDGER)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(rules.ledger(read(spark, sf_dir, "documents")))


@query("op12_hard_negatives", sql.HARD_NEGATIVES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damaged(read(spark, sf_dir, "conversations")))
