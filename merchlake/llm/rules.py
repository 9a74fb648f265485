"""Quality rules kept in a bitmask ledger.

Every rule is evaluated once per text; the ledger stores what was measured and
one failure bit a rule. Policies are versions of a decision over these bits, so
a changed policy, or the question what a rule alone costs, needs the ledger
only and never the texts. All of it is built-in expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import text_of

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS, CAPITALS = "#*$%&|<>", "A-Z"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]

# Name and failure of each rule, as SQL over the measures; the place in the list is the bit. New rules go to the end.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "100 * n_symbols > 20 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("capitals", "100 * n_capitals > 50 * word_chars"),
    ("many_words", "n_words > 1000000"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A version of the decision: no `hard` rule may fail, of the `soft` ones at most `allowed`."""

    version: str
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0

    def mask(self, names: tuple[str, ...]) -> int:
        return reduce(lambda a, n: a | BITS[n], names, 0)

    def keeps(self, bits: Column, without: int = 0) -> Column:
        """The verdict on failure bits, as if the rules in `without` were not there."""
        hard, soft = self.mask(self.hard) & ~without, self.mask(self.soft) & ~without
        return (bits.bitwiseAND(F.lit(hard)) == 0) & (F.bit_count(bits.bitwiseAND(F.lit(soft))) <= self.allowed)


POLICIES = {
    p.version: p
    for p in (
        Policy("base", ("few_words", "repeated_words")),
        Policy("2", ("few_words", "repeated_words", "many_symbols", "word_length", "repeated_lines", "capitals", "many_words")),
        Policy("2-lenient", ("few_words", "repeated_words"),
               ("many_symbols", "word_length", "repeated_lines", "capitals", "many_words"), 1),
    )
}
CURRENT = POLICIES["2"]


def _bound(value: Column, use) -> Column:
    """use(value), with `value` computed once however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the list, its first place included.

    Windows are sorted with their places, so equal ones are neighbours; the
    covered words follow from the gaps between the places. n log n in the words.
    """

    def windows(w: Column) -> Column:
        def at(i: Column) -> Column:
            text = F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return F.struct(text.alias("t"), i.alias("i"))

        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), at)

    def twice(s: Column) -> Column:
        return F.filter(s, lambda x, j: (F.get(s, j + 1)["t"] == x["t"]) | ((j > 0) & (F.get(s, j - 1)["t"] == x["t"])))

    places = F.sort_array(F.transform(_bound(F.sort_array(windows(words)), twice), lambda x: x["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        places,
        start,
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(words) >= 3, covered).otherwise(F.lit(0).cast("long"))


def _taken(text: Column, characters: str) -> Column:
    """How many characters of the text match the character class."""
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the measures, failed_bits (long, one bit a rule).

    Whole texts are measured; a NULL text counts as empty (all measures 0, which
    fails `few_words`). Repeated rows and NULL ids are kept, an empty table gives
    an empty result. Only the two named columns are read, so others may have any
    name. No shuffle.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("_text"))
    text, words = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def repeated(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))

    def measured(w: Column) -> Column:
        chars = F.length(F.array_join(w, "")).cast("long")
        return F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("again"), chars.alias("chars"))

    found = rows.select(
        "doc_id",
        _bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), measured).alias("_words"),
        _bound(lines, repeated).alias("_lines"),
        _taken(text, SYMBOLS).alias("n_symbols"),
        _taken(text, CAPITALS).alias("n_capitals"),
    )
    measures = found.select(
        "doc_id", words["n"].alias("n_words"), words["chars"].alias("word_chars"), "n_symbols", F.col("_lines")["again"].alias("n_dup_lines"),
        words["again"].alias("n_repeat_words"), F.col("_lines")["n"].alias("n_lines"), "n_capitals",
    )
    bits = [F.when(F.expr(failure), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, failure) in enumerate(RULES)]
    return measures.withColumn("failed_bits", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def judged(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with base_failed, kept (false where the base failed) and the policy's version."""
    bits = F.col("failed_bits")
    base = bits.bitwiseAND(F.lit(BASE)) != 0
    return entries.withColumns(
        {"base_failed": base, "kept": ~base & policy.keeps(bits), "policy": F.lit(policy.version)}
    )


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """What each rule of a policy costs: one row a rule, in the order of the bits.

    n_failed rows fail the rule, n_alone of them fail no other rule of the
    policy, n_regained would be kept without the rule, n_kept are kept with all;
    with_bits is the union of what else fails where the rule fails. The ledger is
    first reduced to one row per bit pattern (2 to the number of rules at most).
    An empty ledger gives zeros.
    """
    scope = policy.mask(policy.hard) | policy.mask(policy.soft)
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(scope)).alias("_bits")).agg(F.count(F.lit(1)).alias("_n"))
    bits, n = F.col("_bits"), F.col("_n")

    def of(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")

    sums = []
    for name in [r for r, _ in RULES if BITS[r] & scope]:
        bit = BITS[name]
        fails = bits.bitwiseAND(F.lit(bit)) != 0
        sums.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(policy.version).alias("policy"),
                of(fails).alias("n_failed"),
                of(bits == bit).alias("n_alone"),
                of(policy.keeps(bits, without=bit) & ~policy.keeps(bits)).alias("n_regained"),
                of(policy.keeps(bits)).alias("n_kept"),
                F.coalesce(F.bit_or(F.when(fails, bits.bitwiseAND(F.lit(~bit)))), F.lit(0)).cast("long").alias("with_bits"),
            )
        )
    return patterns.agg(F.array(*sums).alias("_rows")).select(F.inline("_rows"))
