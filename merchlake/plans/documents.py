"""Chunking, redaction, routing, evaluation and retrieval over the document tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from merchlake.functions.joins import checked_broadcast
from merchlake.functions.scalars import money, words
from merchlake.operators import evaluation, retrieval, text
from merchlake.plans.registry import CTES, query, rounded
from merchlake.session import scratch_path
from merchlake.sources import testdata


def _docs(spark, sf):
    return testdata.documents(spark, sf)


# --- chunks -----------------------------------------------------------------

CTES["sentence_lists"] = rf"""
    SELECT doc_id, source, list_filter(string_split(
        regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
        lambda s: s <> '') AS pieces FROM documents"""
CTES["word_lists"] = r"""
    SELECT doc_id, source, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents"""
CTES["window_chunks"] = """
    SELECT doc_id, source, CAST(i AS BIGINT) AS section,
           array_to_string(w[i * 150 + 1 : i * 150 + 200], ' ') AS chunk_text
    FROM (SELECT *, unnest(range(0, CAST(ceil(len(w) / 150.0) AS BIGINT))) AS i FROM word_lists)"""


@query(
    "sentence_chunks",
    """SELECT doc_id || '-' || i AS chunk_id, doc_id, source AS source_file, CAST(i AS BIGINT) AS section,
              pieces[i + 1] AS chunk_text
       FROM (SELECT *, unnest(range(0, len(pieces))) AS i FROM sentence_lists)""",
)
def sentence_chunks(spark, sf):
    return text.chunk_table(_docs(spark, sf), text.sentences(F.col("text")))


@query(
    "paragraph_chunks",
    r"""SELECT doc_id || '-' || i AS chunk_id, doc_id, source AS source_file, CAST(i AS BIGINT) AS section,
               pieces[i + 1] AS chunk_text
        FROM (SELECT *, unnest(range(0, len(pieces))) AS i FROM (
              SELECT doc_id, source, list_filter(list_transform(string_split(text, chr(10)),
                     lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS pieces
              FROM documents))""",
)
def paragraph_chunks(spark, sf):
    return text.chunk_table(_docs(spark, sf), text.paragraphs(F.col("text"), "\n"))


@query(
    "window_chunks",
    """SELECT doc_id || '-' || section AS chunk_id, doc_id, source AS source_file, section, chunk_text
       FROM window_chunks""",
)
def window_chunks(spark, sf):
    return text.chunk_table(_docs(spark, sf), text.word_windows(F.col("text"), 200, 50))


@query(
    "merged_sentence_chunks",
    """SELECT doc_id || '-' || i AS chunk_id, doc_id, source AS source_file, CAST(i AS BIGINT) AS section,
              array_to_string(pieces[i * 5 + 1 : i * 5 + 5], ' ') AS chunk_text
       FROM (SELECT *, unnest(range(0, CAST(ceil(len(pieces) / 5.0) AS BIGINT))) AS i FROM sentence_lists)""",
)
def merged_sentence_chunks(spark, sf):
    """Sentences joined between boundaries; here a boundary stands before every fifth sentence."""
    pieces = text.sentences(F.col("text"))
    every_fifth = text.bind(pieces, lambda p: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(p) / 5).cast("int")), lambda i: i * 5))
    return text.chunk_table(_docs(spark, sf), text.merged_sentences(pieces, every_fifth))


@query(
    "chunk_statistics",
    """SELECT source, count(*) AS chunks, count(DISTINCT doc_id) AS documents,
              CAST(max(length(chunk_text)) AS BIGINT) AS longest FROM window_chunks GROUP BY 1""",
)
def chunk_statistics(spark, sf):
    chunks = text.chunk_table(_docs(spark, sf), text.word_windows(F.col("text"), 200, 50))
    return chunks.groupBy(F.col("source_file").alias("source")).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_distinct("doc_id").alias("documents"),
        F.max(F.length("chunk_text")).alias("longest"),
    )


# --- redaction --------------------------------------------------------------


@query("redacted_documents")
def redacted_documents(spark, sf):
    return _docs(spark, sf).select("doc_id", text.redact(F.col("text")).alias("text"))


@query("pii_counts")
def pii_counts(spark, sf):
    counted = _docs(spark, sf).select("source", *[c.alias(n) for n, c in text.pii_counts(F.col("text")).items()])
    return counted.groupBy("source").agg(*[F.sum(n).alias(n) for n in ("n_email", "n_card", "n_phone")])


# --- routing and replies ----------------------------------------------------

CTES["questions"] = """
    SELECT o_orderkey AS question_id, 'Order ' || o_orderkey || ' ' || CASE o_orderstatus
             WHEN 'F' THEN 'was FLAGGED, why?' WHEN 'O' THEN 'margin and discount?'
             ELSE 'of which segment?' END || CASE WHEN o_orderpriority = '1-URGENT' THEN ' It looks suspicious.'
             WHEN o_orderpriority = '5-LOW' THEN ' Any anomalies?' ELSE '' END AS question FROM orders"""


def _questions(spark, sf):
    status = (
        F.when(F.col("o_orderstatus") == "F", "was FLAGGED, why?")
        .when(F.col("o_orderstatus") == "O", "margin and discount?")
        .otherwise("of which segment?")
    )
    extra = (
        F.when(F.col("o_orderpriority") == "1-URGENT", " It looks suspicious.")
        .when(F.col("o_orderpriority") == "5-LOW", " Any anomalies?")
        .otherwise("")
    )
    return testdata.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("question_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey"), F.lit(" "), status, extra).alias("question"),
    )


_ROUTE_SQL = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(question), '{k}')" for k in keys) + f" THEN '{name}'"
    for name, keys in text.ROUTES
) + f" ELSE '{text.DEFAULT_ROUTE}' END"


@query("routed_questions", f"SELECT question_id, {_ROUTE_SQL} AS agent FROM questions")
def routed_questions(spark, sf):
    return _questions(spark, sf).select("question_id", text.route(F.col("question")).alias("agent"))


@query(
    "routed_conversations",
    f"""SELECT agent, count(*) AS n FROM (
            SELECT {_ROUTE_SQL} AS agent FROM (SELECT text AS question FROM conversations)) GROUP BY 1""",
)
def routed_conversations(spark, sf):
    turns = testdata.table(spark, sf, "conversations").select(text.route(F.col("text")).alias("agent"))
    return turns.groupBy("agent").agg(F.count(F.lit(1)).alias("n"))


@query(
    "last_user_turns",
    """SELECT c.conv_id, COALESCE(max_by(text, turn) FILTER (role = 'user'), '') AS question
       FROM conversations c GROUP BY 1""",
)
def last_user_turns(spark, sf):
    return text.last_user_turn(testdata.table(spark, sf, "conversations"))


# Replies made of the given texts, whole, in well-formed and in broken shapes.
CTES["replies"] = r"""
    SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN '  allowed' WHEN 1 THEN 'Blocked: off topic: ' || text
                                   WHEN 2 THEN 'BLOCKED' ELSE 'Maybe ' || text END AS gate,
           CASE WHEN doc_id % 3 = 0 THEN 'UNSAFE S' || (doc_id % 7) ELSE text END AS label,
           CASE doc_id % 4 WHEN 0 THEN 'SCORE: 0.5' || chr(10) || 'REASON: short: ' || text
                           WHEN 1 THEN text || chr(10) || 'SCORE: high' || chr(10) || ' REASON : ' || lang
                           WHEN 2 THEN 'SCORE: 1.0' || chr(10) || 'REASON: first' || chr(10) || 'SCORE:' || chr(10) || '0.9'
                                       || chr(10) || 'REASON: last: ' || source
                           ELSE 'REASON: one' || chr(10) || 'SCORE: 0.25' || chr(10) || 'REASON:' || chr(10) || text END AS judge,
           CASE doc_id % 8
             WHEN 0 THEN '{"summary":"' || quoted || '","data_source":"none","confidence":"high"}'
             WHEN 1 THEN '{"summary":"x","data_source":"' || source || '","confidence":"low","chart_spec":{"mark":"bar"}}'
             WHEN 2 THEN '{"summary":"' || quoted || '","data_source":"none","confidence":"high"} and more'
             WHEN 3 THEN '{"summary":5,"nested":{"summary":"' || quoted || '"},"data_source":"y","confidence":"low"}'
             WHEN 4 THEN '{"summary":"x","data_source":"y","confidence":"low","chart_spec":"{oops"}'
             WHEN 5 THEN text
             WHEN 6 THEN '{"summary":"x","data_source":"y","confidence":"very high"}'
             ELSE '{"nested":{"summary":"' || quoted || '"},"data_source":"y","confidence":"low"}' END AS answer
    FROM (SELECT *, replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n') AS quoted FROM documents)"""
CTES["judge_lines"] = r"""
    SELECT doc_id, list_filter(regexp_split_to_array(judge, '\n'), lambda l: contains(l, ':')) AS lines FROM replies"""


def _replies(spark, sf):
    def pick(n, values):
        chain = None
        for i, v in enumerate(values[:-1]):
            hit = F.col("doc_id") % n == i
            chain = F.when(hit, v) if chain is None else chain.when(hit, v)
        return chain.otherwise(values[-1])

    def joined(*parts):
        return F.concat(*[F.col(p[1:]) if p.startswith("$") else F.lit(p) for p in parts])

    quoted = F.col("text")
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        quoted = F.replace(quoted, F.lit(plain), F.lit(escaped))
    return _docs(spark, sf).withColumn("quoted", quoted).select(
        "doc_id",
        pick(4, [F.lit("  allowed"), joined("Blocked: off topic: ", "$text"), F.lit("BLOCKED"), joined("Maybe ", "$text")]).alias("gate"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("UNSAFE S"), (F.col("doc_id") % 7).cast("string")))
        .otherwise(F.col("text")).alias("label"),
        pick(4, [
            joined("SCORE: 0.5\nREASON: short: ", "$text"),
            joined("$text", "\nSCORE: high\n REASON : ", "$lang"),
            joined("SCORE: 1.0\nREASON: first\nSCORE:\n0.9\nREASON: last: ", "$source"),
            joined("REASON: one\nSCORE: 0.25\nREASON:\n", "$text"),
        ]).alias("judge"),
        pick(8, [
            joined('{"summary":"', "$quoted", '","data_source":"none","confidence":"high"}'),
            joined('{"summary":"x","data_source":"', "$source", '","confidence":"low","chart_spec":{"mark":"bar"}}'),
            joined('{"summary":"', "$quoted", '","data_source":"none","confidence":"high"} and more'),
            joined('{"summary":5,"nested":{"summary":"', "$quoted", '"},"data_source":"y","confidence":"low"}'),
            F.lit('{"summary":"x","data_source":"y","confidence":"low","chart_spec":"{oops"}'),
            F.col("text"),
            F.lit('{"summary":"x","data_source":"y","confidence":"very high"}'),
            joined('{"nested":{"summary":"', "$quoted", '"},"data_source":"y","confidence":"low"}'),
        ]).alias("answer"),
    )


@query(
    "gate_verdicts",
    r"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'ALLOWED' ELSE 'BLOCKED' END AS verdict,
              CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN regexp_replace(substr(gate, 9), '^\s+|\s+$', '', 'g')
                   WHEN 2 THEN 'blocked by safety filter' ELSE 'internal safety filter error' END AS reason FROM replies""",
)
def gate_verdicts(spark, sf):
    return _replies(spark, sf).select("doc_id", F.inline(F.array(text.gate_verdict(F.col("gate")))))


@query(
    "safety_verdicts",
    r"""SELECT doc_id, NOT contains(upper(label), 'UNSAFE') AS passed,
              CASE WHEN contains(upper(label), 'UNSAFE')
                   THEN 'Input blocked: ' || regexp_replace(replace(label, 'UNSAFE', ''), '^\s+|\s+$', '', 'g') ELSE '' END
              AS reason FROM replies""",
)
def safety_verdicts(spark, sf):
    return _replies(spark, sf).select("doc_id", F.inline(F.array(text.safety_verdict(F.col("label")))))


@query(
    "judge_scores",
    r"""SELECT doc_id,
              COALESCE(TRY_CAST(regexp_replace(regexp_replace(list_last(list_filter(lines,
                  lambda l: trim(split_part(l, ':', 1)) = 'SCORE')), '^[^:]*:', ''), '^\s+|\s+$', '', 'g') AS DOUBLE), 0.0) AS score,
              COALESCE(regexp_replace(regexp_replace(list_last(list_filter(lines,
                  lambda l: trim(split_part(l, ':', 1)) = 'REASON')), '^[^:]*:', ''), '^\s+|\s+$', '', 'g'), '') AS reason
       FROM judge_lines""",
)
def judge_scores(spark, sf):
    return _replies(spark, sf).select("doc_id", F.inline(F.array(text.judge_reply(F.col("judge")))))


@query(
    "structured_answers",
    """SELECT doc_id, valid, CASE WHEN valid THEN json_extract_string(answer, '$.summary') ELSE answer END AS answer,
              CASE WHEN valid THEN json_extract_string(answer, '$.data_source') ELSE '' END AS data_source,
              CASE WHEN valid THEN json_extract_string(answer, '$.confidence') ELSE '' END AS confidence,
              CASE WHEN valid THEN json_extract_string(answer, '$.chart_spec') END AS chart_spec
       FROM (SELECT doc_id, answer, CASE WHEN json_valid(answer) THEN COALESCE(
                 json_type(answer, '$.summary') = 'VARCHAR' AND json_type(answer, '$.data_source') = 'VARCHAR'
                 AND json_extract_string(answer, '$.confidence') IN ('high', 'medium', 'low')
                 AND COALESCE(json_type(answer, '$.chart_spec'), 'NULL') IN ('NULL', 'OBJECT'), FALSE) ELSE FALSE END AS valid
             FROM replies)""",
)
def structured_answers(spark, sf):
    return _replies(spark, sf).select("doc_id", F.inline(F.array(text.structured_answer(F.col("answer")))))


# --- evaluation -------------------------------------------------------------

CTES["answered"] = r"""
    SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer,
           array_to_string(list_filter(regexp_split_to_array(q.text, '\s+'), lambda w: w <> '')[1:2], ' ') AS keywords,
           a.turn % 3 AS kind
    FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant'"""
CTES["keyword_results"] = r"""
    SELECT *, CASE WHEN len(list_filter(list_filter(regexp_split_to_array(lower(keywords), '\s+'), lambda w: w <> ''),
              lambda w: NOT contains(lower(answer), w))) = 0 THEN 1.0 ELSE 0.0 END AS keyword_pass,
           CASE kind WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0.0 END AS judge_score FROM answered"""


def _answered(spark, sf):
    turns = testdata.table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    pairs = asked.join(replied, ["conv_id", "turn"])
    return pairs.select(
        "*",
        F.array_join(F.slice(words(F.col("question")), 1, 2), " ").alias("keywords"),
        ((F.col("turn") + 1) % 3).alias("kind"),
    )


def _scored(spark, sf):
    judge = F.when(F.col("kind") == 0, 1.0).when(F.col("kind") == 1, 0.5).otherwise(0.0)
    return _answered(spark, sf).select(
        "*",
        evaluation.keyword_score(F.col("answer"), F.col("keywords")).alias("keyword_pass"),
        judge.alias("judge_score"),
    )


@query("keyword_scores", "SELECT conv_id, turn, keywords, keyword_pass FROM keyword_results")
def keyword_scores(spark, sf):
    return _scored(spark, sf).select("conv_id", "turn", "keywords", "keyword_pass")


@query(
    "evaluation_by_category",
    """SELECT kind AS category, count(*) AS questions, round(avg(keyword_pass), 2) AS keyword_pass,
              round(avg(judge_score), 2) AS judge_score FROM keyword_results GROUP BY 1""",
)
def evaluation_by_category(spark, sf):
    return evaluation.category_report(_scored(spark, sf).withColumnRenamed("kind", "category"))


@query(
    "failed_answers",
    """SELECT conv_id, turn, answer, substr(answer, 1, 200) AS answer_head FROM keyword_results WHERE keyword_pass = 0""",
)
def failed_answers(spark, sf):
    failed = evaluation.failed_rows(_scored(spark, sf).withColumnRenamed("answer", "agent_answer"))
    return failed.select("conv_id", "turn", F.col("agent_answer").alias("answer"), "answer_head")


_SCENARIO_SQL = """
    SELECT conv_id, turn, kind, answer, kind = 0 AS expected_blocked,
           CASE WHEN kind = 1 THEN 'blocked' WHEN kind = 2 THEN 'pricing' ELSE 'customer' END AS agent,
           string_split(lower(keywords), ' ') AS kws FROM answered"""
CTES["scenarios"] = _SCENARIO_SQL
CTES["scenario_results"] = """
    SELECT *, CASE WHEN kind = 0 THEN 'expected blocked' WHEN kind = 1 THEN 'expected allowed' ELSE
              concat_ws(',', 'wrong agent', CASE WHEN len(list_filter(kws, lambda k: contains(lower(answer), k))) = 0
              THEN 'no keyword found' END) END AS failures FROM scenarios"""


def _scenarios(spark, sf):
    kind = F.col("kind")
    rows = _answered(spark, sf).withColumns(
        {
            "expected_blocked": kind == 0,
            "agent": F.when(kind == 1, "blocked").when(kind == 2, "pricing").otherwise("customer"),
            "latency_ms": F.length("answer"),
            "layer": F.concat(F.lit("layer "), kind.cast("string")),
        }
    )
    failures = evaluation.scenario_failures(
        F.col("answer"), F.col("agent"), F.col("expected_blocked"), F.lit("customer"),
        F.split(F.lower("keywords"), " "),
    )
    return rows.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)


@query("scenario_checks", "SELECT conv_id, turn, failures FROM scenario_results")
def scenario_checks(spark, sf):
    return _scenarios(spark, sf).select("conv_id", "turn", "failures")


@query(
    "scenario_report",
    """SELECT CASE WHEN grouping(kind) = 1 THEN NULL ELSE 'layer ' || kind END AS layer,
              count(CASE WHEN failures = '' THEN 1 END) AS passed, count(*) AS total,
              CAST(floor(avg(length(answer))) AS BIGINT) AS avg_latency_ms,
              round(count(CASE WHEN failures = '' THEN 1 END) / count(*), 4) AS pass_rate
       FROM scenario_results GROUP BY ROLLUP (kind)""",
)
def scenario_report(spark, sf):
    return evaluation.layer_report(_scenarios(spark, sf))


CTES["answer_words"] = r"""
    SELECT conv_id, turn, word, sum(a) AS a, sum(e) AS e FROM (
      SELECT conv_id, turn, unnest(list_filter(regexp_split_to_array(lower(answer), '\s+'), lambda w: w <> '')) AS word, 1 AS a, 0 AS e FROM answered
      UNION ALL
      SELECT conv_id, turn, unnest(list_filter(regexp_split_to_array(lower(question), '\s+'), lambda w: w <> '')), 0, 1 FROM answered)
    GROUP BY ALL"""
CTES["answer_cosines"] = """
    SELECT conv_id, turn, sum(a * e * w * w) / nullif(sqrt(sum(a * a * w * w)) * sqrt(sum(e * e * w * w)), 0) AS cosine
    FROM answer_words JOIN (
      SELECT word, ln((1.0 + (SELECT count(answer) + count(question) FROM answered))
                      / (1 + count(CASE WHEN a > 0 THEN 1 END) + count(CASE WHEN e > 0 THEN 1 END))) + 1 AS w
      FROM answer_words GROUP BY word) USING (word)
    GROUP BY 1, 2"""


@query(
    "score_disagreements",
    rf"""SELECT conv_id, turn, round(overlap, 4) AS overlap, {rounded("cosine", 4)} AS cosine,
               abs(overlap - judge_score) > 0.5 AS disagrees, abs(cosine - judge_score) > 0.5 AS cosine_disagrees
        FROM (SELECT *, len(list_intersect(q, a)) * 1.0 / nullif(len(q), 0) AS overlap FROM (
          SELECT conv_id, turn, judge_score,
                 list_distinct(list_filter(regexp_split_to_array(lower(question), '\s+'), lambda w: w <> '')) AS q,
                 list_distinct(list_filter(regexp_split_to_array(lower(answer), '\s+'), lambda w: w <> '')) AS a
          FROM keyword_results)) LEFT JOIN answer_cosines USING (conv_id, turn)""",
)
def score_disagreements(spark, sf):
    """Two rule lanes against the judge: the share of the question's words, and the cosine of rarity-weighted words."""
    rows = evaluation.cosine_scores(_scored(spark, sf), ["conv_id", "turn"], "answer", "question")
    rows = rows.withColumn("overlap", evaluation.overlap_score(F.col("answer"), F.col("question")))
    judged = evaluation.disagreements(rows, "overlap", "judge_score")
    judged = evaluation.disagreements(judged.withColumnRenamed("disagrees", "_by_overlap"), "cosine", "judge_score")
    return judged.select(
        "conv_id", "turn", F.round("overlap", 4).alias("overlap"), money("cosine", 4).alias("cosine"),
        F.col("_by_overlap").alias("disagrees"), F.col("disagrees").alias("cosine_disagrees"),
    )


# --- retrieval --------------------------------------------------------------

CTES["topics"] = """
    SELECT label AS query_id, list(m ORDER BY pos) AS vector FROM (
        SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM (
            SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY 1, 2) GROUP BY 1"""
CTES["topic_scores"] = """
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id AS id,
           round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 6) AS score, label
    FROM embeddings, topics"""
CTES["topic_hits"] = """
    SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, label
    FROM topic_scores"""


def _corpus(spark, sf):
    return testdata.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


def _topics(spark, sf):
    """One query vector per topic: the mean of the topic's vectors."""
    vectors = _corpus(spark, sf).select("label", array_to_vector(F.col("vector").cast("array<double>")).alias("_v"))
    means = vectors.groupBy("label").agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return means.select(F.col("label").alias("query_id"), vector_to_array("_m").alias("vector"))


@query("topic_nearest", "SELECT query_id, id, score, rank FROM topic_hits WHERE rank <= 5")
def topic_nearest(spark, sf):
    return retrieval.nearest(_corpus(spark, sf), _topics(spark, sf), k=5)


@query("topic_nearest_above_score", "SELECT query_id, id, score, rank FROM topic_hits WHERE rank <= 50 AND score >= 0.3")
def topic_nearest_above_score(spark, sf):
    return retrieval.nearest(_corpus(spark, sf), _topics(spark, sf), k=50, min_score=0.3)


@query(
    "own_topic_similarity",
    """SELECT label, round(avg(score), 5) AS mean_similarity FROM topic_scores WHERE label = query_id GROUP BY 1""",
)
def own_topic_similarity(spark, sf):
    joined = _corpus(spark, sf).join(
        _topics(spark, sf).select("query_id", F.col("vector").alias("centre")),
        F.col("label") == F.col("query_id"),
    )
    score = F.round(retrieval.cosine(F.col("vector"), F.col("centre")), 6)
    return joined.groupBy("label").agg(F.round(F.avg(score), 5).alias("mean_similarity"))


@query("topic_nearest_in_cells")
def topic_nearest_in_cells(spark, sf):
    corpus = _corpus(spark, sf)
    centres = retrieval.cell_centres(corpus, 8)
    index = scratch_path(spark, "cells")
    placed = retrieval.assign_cells(corpus.select("id", "vector"), centres).withColumn("cell", F.col("cells")[0])
    placed.drop("cells").write.partitionBy("cell").parquet(index)
    return retrieval.nearest_in_cells(spark.read.parquet(index), _topics(spark, sf), centres, k=5, probes=3)


@query(
    "retrieval_grid",
    """SELECT k, min_score, count(*) AS queries, round(avg(CASE WHEN found > 0 THEN 1.0 ELSE 0.0 END), 4) AS hit_rate,
              round(avg(found / relevant), 4) AS recall
       FROM (SELECT g.k, g.min_score, t.query_id, t.relevant,
                    count(CASE WHEN h.label = h.query_id THEN 1 END) AS found
             FROM (SELECT CAST(label AS BIGINT) AS query_id, count(*) AS relevant FROM embeddings GROUP BY 1) t
             CROSS JOIN (SELECT CAST(k AS BIGINT) AS k, CAST(m AS DOUBLE) AS min_score
                         FROM (VALUES (1), (5), (20)) a(k), (VALUES (0.0), (0.3)) b(m)) g
             LEFT JOIN topic_hits h ON h.query_id = t.query_id AND h.rank <= g.k AND h.score >= g.min_score
             GROUP BY 1, 2, 3, 4) GROUP BY 1, 2""",
)
def retrieval_grid(spark, sf):
    hits = retrieval.nearest(_corpus(spark, sf), _topics(spark, sf), k=20).withColumnRenamed("id", "item")
    truth = _corpus(spark, sf).select(F.col("label").cast("bigint").alias("query_id"), F.col("id").alias("item"))
    return retrieval.sweep_quality(hits, truth, [1, 5, 20], [0.0, 0.3])


@query("chunking_grid")
def chunking_grid(spark, sf):
    """Recall of passages over chunk sizes and overlaps: hashed word vectors, whole documents.

    A document is relevant to a passage when the two share a sentence.
    """
    docs = _docs(spark, sf)
    passages = testdata.table(spark, sf, "benchmark")
    queries = retrieval.word_vectors(passages, "text").select(F.col("item_id").alias("query_id"), "vector")
    said = passages.select(F.col("item_id").alias("query_id"), F.explode(text.sentences(F.col("text"))).alias("s"))
    seen = docs.select(F.col("doc_id").alias("item"), F.explode(text.sentences(F.col("text"))).alias("s")).distinct()
    truth = seen.join(checked_broadcast(said.distinct()), "s").select("query_id", "item").distinct()
    results = None
    for size, overlap in ((100, 20), (200, 50)):
        chunks = docs.select(
            "doc_id", F.posexplode(text.word_windows(F.col("text"), size, overlap)).alias("pos", "chunk")
        ).select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("id"), "chunk")
        corpus = retrieval.word_vectors(chunks, "chunk").select("id", "vector")
        hits = retrieval.nearest(corpus, queries, k=10).withColumn("item", F.floor(F.col("id") / 1_000_000))
        quality = retrieval.sweep_quality(hits, truth, [1, 10], [0.0, 0.5]).select(
            F.lit(size).alias("size"), F.lit(overlap).alias("overlap"), "*"
        )
        results = quality if results is None else results.unionByName(quality)
    return results


@query(
    "answer_contexts",
    """SELECT query_id, string_agg('[Source ' || rank || ': label-' || label || ', page ' || id || ']' || chr(10)
              || 'vector ' || id, chr(10) || chr(10) ORDER BY rank) AS context
       FROM topic_hits WHERE rank <= 3 GROUP BY 1""",
)
def answer_contexts(spark, sf):
    hits = retrieval.nearest(_corpus(spark, sf), _topics(spark, sf), k=3)
    named = hits.join(_corpus(spark, sf).select("id", "label"), "id").select(
        "query_id",
        "rank",
        F.concat(F.lit("label-"), F.col("label").cast("string")).alias("source_file"),
        F.col("id").alias("page"),
        F.concat(F.lit("vector "), F.col("id").cast("string")).alias("chunk_text"),
    )
    return retrieval.context_blocks(named)


CTES["new_chunks"] = """
    SELECT doc_id || '-' || section AS chunk_id,
           CASE WHEN doc_id % 10 = 0 THEN chunk_text || ' edited' ELSE chunk_text END AS chunk_text
    FROM window_chunks WHERE doc_id % 17 <> 0"""


@query(
    "index_refresh",
    """SELECT COALESCE(o.chunk_id, n.chunk_id) AS chunk_id,
              CASE WHEN n.chunk_id IS NULL THEN 'delete' WHEN o.chunk_id IS NULL THEN 'insert' ELSE 'update' END AS action,
              sha256(n.chunk_text) AS text_hash
       FROM (SELECT doc_id || '-' || section AS chunk_id, chunk_text FROM window_chunks WHERE doc_id % 13 <> 0) o
       FULL JOIN new_chunks n ON o.chunk_id = n.chunk_id
       WHERE o.chunk_text IS DISTINCT FROM n.chunk_text""",
)
def index_refresh(spark, sf):
    """An older index lacking some documents against newer chunks with edits and removals."""
    chunks = text.chunk_table(_docs(spark, sf), text.word_windows(F.col("text"), 200, 50))
    old = chunks.where(F.col("doc_id") % 13 != 0).select("chunk_id", F.sha2("chunk_text", 256).alias("text_hash"))
    edited = F.when(F.col("doc_id") % 10 == 0, F.concat("chunk_text", F.lit(" edited"))).otherwise(F.col("chunk_text"))
    new = chunks.where(F.col("doc_id") % 17 != 0).select("chunk_id", edited.alias("chunk_text"))
    return retrieval.index_changes(old, new)


@query(
    "vector_table_problems",
    """SELECT count(CASE WHEN v.vec_id IS NULL THEN 1 END) AS chunks_without_vector,
              count(CASE WHEN d.doc_id IS NULL THEN 1 END) AS vectors_without_chunk, 0 AS null_vectors,
              0 AS zero_vectors, min(len(embedding)) AS min_dims, max(len(embedding)) AS max_dims
       FROM documents d FULL JOIN embeddings v ON d.doc_id = v.vec_id""",
)
def vector_table_problems(spark, sf):
    chunks = _docs(spark, sf).select(F.col("doc_id").alias("chunk_id"))
    vectors = testdata.table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    return retrieval.vector_problems(chunks, vectors)


@query(
    "vector_table_problems_with_faults",
    """SELECT count(CASE WHEN v.vec_id IS NULL THEN 1 END) AS chunks_without_vector,
              count(CASE WHEN d.doc_id IS NULL THEN 1 END) AS vectors_without_chunk,
              count(CASE WHEN v.vec_id % 9 = 4 THEN 1 END) AS null_vectors,
              count(CASE WHEN v.vec_id % 11 = 5 AND v.vec_id % 9 <> 4 THEN 1 END) AS zero_vectors,
              min(CASE WHEN v.vec_id % 9 <> 4 THEN CASE WHEN v.vec_id % 11 = 5 THEN 3 ELSE len(embedding) END END) AS min_dims,
              max(CASE WHEN v.vec_id % 9 <> 4 THEN CASE WHEN v.vec_id % 11 = 5 THEN 3 ELSE len(embedding) END END) AS max_dims
       FROM documents d FULL JOIN embeddings v ON d.doc_id = v.vec_id""",
)
def vector_table_problems_with_faults(spark, sf):
    """Some vectors taken away, some replaced by three zeros."""
    chunks = _docs(spark, sf).select(F.col("doc_id").alias("chunk_id"))
    zeros = F.array(*[F.lit(0.0).cast("float")] * 3)
    faulty = F.when(F.col("vec_id") % 9 == 4, F.lit(None)).when(F.col("vec_id") % 11 == 5, zeros).otherwise(F.col("embedding"))
    vectors = testdata.table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), faulty.alias("embedding"))
    return retrieval.vector_problems(chunks, vectors)
