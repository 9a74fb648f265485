"""Document chunking, redaction, routing and parsing of model replies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions.scalars import blank_trim, words

# Personal-data patterns and their replacements, applied in this
# order. (?U) makes digits, blanks and word borders Unicode-aware.
PII = [
    ("email", r"(?U)\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b", "[EMAIL REDACTED]"),
    ("card", r"(?U)\b\d{4}[\s\-]?\d{4}[\s\-]?\d{4}[\s\-]?\d{4}\b", "[CARD REDACTED]"),
    ("phone", r"(?U)\b\+?[\d\s\-().]{10,15}\b", "[PHONE REDACTED]"),
]

# Routing words, first matching rule wins.
ROUTES = [
    ("fraud", ["fraud", "blocked", "chargeback", "suspicious", "decline", "flagged", "anomaly"]),
    ("pricing", ["price", "margin", "revenue", "pricing", "profit", "discount", "product", "billing"]),
    ("customer", ["customer", "profile", "lifetime", "ltv", "churn", "loyalty", "segment", "retention"]),
]
DEFAULT_ROUTE = "customer"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sentences(text: Column) -> Column:
    """Pieces ending in . ! or ? followed by white space."""
    return F.filter(F.split(blank_trim(text), r"(?U)(?<=[.!?])\s+"), lambda s: s != "")


def paragraphs(text: Column, separator: str = "\n\n") -> Column:
    """Trimmed non-empty pieces between separators (taken literally)."""
    literal = "\\Q" + separator + "\\E"
    return F.filter(F.transform(F.split(text, literal), blank_trim), lambda p: p != "")


def word_windows(text: Column, size: int = 200, overlap: int = 50) -> Column:
    """Windows of `size` words, each starting size − overlap words after the one before; the last may be short."""
    step = size - overlap
    if size < 1 or overlap < 0 or step < 1:
        raise ValueError("overlap must be smaller than size")

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w), F.lit(step))
        windows = F.transform(starts, lambda s: F.array_join(F.slice(w, s, F.lit(size)), " "))
        return F.when(F.size(w) > 0, windows).otherwise(F.array().cast("array<string>"))

    return bind(words(text), cut)


def merged_sentences(pieces: Column, boundaries: Column) -> Column:
    """Join sentences between given (0-based) boundary positions into chunks."""

    def merge(p: Column) -> Column:
        cuts = F.array_sort(
            F.array_distinct(
                F.concat(
                    F.array(F.lit(0)), F.filter(boundaries, lambda b: (b > 0) & (b < F.size(p))), F.array(F.size(p))
                )
            )
        )
        return bind(
            cuts,
            lambda c: F.transform(
                F.slice(c, 1, F.size(c) - 1),
                lambda start, i: F.array_join(F.slice(p, start + 1, F.element_at(c, i + 2) - start), " "),
            ),
        )

    return bind(pieces, merge)


def chunk_table(docs: DataFrame, pieces: Column, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per chunk with a stable id (document and position)."""
    return docs.select(
        F.col(doc_id), F.col(source).alias("source_file"), F.posexplode(pieces).alias("section", "chunk_text")
    ).select(
        F.concat_ws("-", F.col(doc_id).cast("string"), F.col("section").cast("string")).alias("chunk_id"),
        doc_id,
        "source_file",
        "section",
        "chunk_text",
    )


def redact(text: Column) -> Column:
    for _, pattern, replacement in PII:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def pii_counts(text: Column) -> dict[str, Column]:
    """Finds per type, each counted on the text its predecessors have been taken out of."""
    counts = {}
    for name, pattern, replacement in PII:
        counts[f"n_{name}"] = F.regexp_count(text, F.lit(pattern))
        text = F.regexp_replace(text, pattern, replacement)
    return counts


def route(question: Column, rules: Sequence[tuple[str, Sequence[str]]] = ROUTES, default: str = DEFAULT_ROUTE):
    """Name of the first rule one of whose words occurs anywhere in the question, any case."""
    lower = F.lower(F.coalesce(question, F.lit("")))
    verdict = None
    for name, keys in rules:
        hit = F.lit(False)
        for key in keys:
            hit = hit | F.contains(lower, F.lit(key))
        verdict = F.when(hit, name) if verdict is None else verdict.when(hit, name)
    return F.lit(default) if verdict is None else verdict.otherwise(default)


def gate_verdict(reply: Column) -> Column:
    """ALLOWED or BLOCKED with a reason; anything else counts as blocked."""
    text = blank_trim(F.coalesce(reply, F.lit("")))
    allowed = F.startswith(F.upper(text), F.lit("ALLOWED"))
    blocked = F.startswith(F.upper(text), F.lit("BLOCKED"))
    given = blank_trim(F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1))
    reason = (
        F.when(allowed, "")
        .when(blocked & F.contains(text, F.lit(":")), given)
        .when(blocked, "blocked by safety filter")
        .otherwise("internal safety filter error")
    )
    return F.struct(F.when(allowed, "ALLOWED").otherwise("BLOCKED").alias("verdict"), reason.alias("reason"))


def safety_verdict(label: Column) -> Column:
    """Whether a safety label lets the input pass; an unsafe one names its category."""
    unsafe = F.coalesce(F.contains(F.upper(label), F.lit("UNSAFE")), F.lit(False))
    category = blank_trim(F.replace(label, F.lit("UNSAFE"), F.lit("")))
    return F.struct(
        (~unsafe).alias("passed"),
        F.when(unsafe, F.concat(F.lit("Input blocked: "), category)).otherwise("").alias("reason"),
    )


# Where a text breaks into lines.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def judge_reply(reply: Column) -> Column:
    """SCORE and REASON lines of a judge's reply, the last of each; no or unreadable score gives 0."""
    lines = F.filter(F.split(blank_trim(F.coalesce(reply, F.lit(""))), LINE_BREAK), lambda x: F.contains(x, F.lit(":")))

    def last(key: str) -> Column:
        named = F.filter(lines, lambda x: blank_trim(F.substring_index(x, ":", 1)) == key)
        return bind(F.get(F.reverse(named), F.lit(0)), lambda x: blank_trim(F.substr(x, F.instr(x, ":") + 1)))

    def check(score: Column) -> Column:
        return F.coalesce(F.when(score.rlike(NUMBER), score.try_cast("double")), F.lit(0.0))

    return F.struct(bind(last("SCORE"), check).alias("score"), F.coalesce(last("REASON"), F.lit("")).alias("reason"))


def structured_answer(raw: Column) -> Column:
    """Validate a JSON answer: summary, data_source and a known confidence level are required.

    The whole text must be one JSON object; the three fields must be texts and
    chart_spec absent, null or an object. An invalid answer keeps its raw text as
    the answer.
    """
    # One more element behind the text: anything but a single value in front of it shows.
    single = F.json_array_length(F.concat(F.lit("["), raw, F.lit(",0]"))) == 2

    def check(p: Column) -> Column:
        def kind(name: str) -> Column:
            return F.schema_of_variant(F.try_variant_get(p, f"$.{name}", "variant"))

        def value(name: str) -> Column:
            return F.try_variant_get(p, f"$.{name}", "string")

        valid = (
            single
            & (kind("summary") == "STRING")
            & (kind("data_source") == "STRING")
            & (kind("confidence") == "STRING")
            & value("confidence").isin("high", "medium", "low")
            & (F.coalesce(kind("chart_spec"), F.lit("VOID")).rlike("^(VOID$|OBJECT<)"))
        )
        valid = F.coalesce(valid, F.lit(False))
        return F.struct(
            valid.alias("valid"),
            F.when(valid, value("summary")).otherwise(raw).alias("answer"),
            F.when(valid, value("data_source")).otherwise("").alias("data_source"),
            F.when(valid, value("confidence")).otherwise("").alias("confidence"),
            F.when(valid, value("chart_spec")).alias("chart_spec"),
        )

    return bind(F.try_parse_json(raw), check)


def last_user_turn(turns: DataFrame) -> DataFrame:
    """The newest user text of each conversation, empty where there is none."""
    spoken = F.when(F.col("role") == "user", F.col("turn"))
    picked = F.max_by(F.when(F.col("role") == "user", F.col("text")), spoken)
    return turns.groupBy("conv_id").agg(F.coalesce(picked, F.lit("")).alias("question"))
