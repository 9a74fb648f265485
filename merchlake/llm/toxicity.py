"""Toxicity from a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts to
Latin, digits and signs that stand for letters inside a word to these letters,
everything else to one blank. Lexicon entries are words or word beginnings; one
automaton finds all of them in one pass. Exception phrases cancel what they
cover. The sum of the weights, and that sum over the length of the text, give
the score.

Weights and the two factors of the score are learned from labelled texts: an
entry is a word or word beginning that stands in toxic texts so much more often
than in others that chance is ruled out (log-likelihood ratio).
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Rows, key_crc, kept, rows_of

# Look-alike letters (Cyrillic, Greek, full width) and the Latin letter each stands for.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ӏ": "l", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "​": "", "‌": "", "‍": "", "­": "", "﻿": "",
}
FOLD = {ord(k): v for k, v in LOOKALIKES.items()} | {0xFF41 + i: chr(97 + i) for i in range(26)}
# Digits and signs written for letters.
STANDINS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_STANDIN = re.compile(r"(?<![^\W\d_])[013457@$](?=[^\W\d_])|(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])")
_RUN = re.compile(r"(?:[^\W\d_]|[013457@$!])*(?:[^\W\d_]|[013457@$])")
_OTHER = re.compile(r"[\W_]+")

# Insults that count even where no label speaks of them, and phrases in which they are harmless.
SEED_TERMS = ["idiot", "moron", "imbecile", "stupid", "worthless", "pathetic", "disgusting", "scum", "scumbag", "loser", "trash",
              "dumbass", "asshole", "bastard", "retard", "vermin"]
EXCEPTIONS = ["trash can", "trash cans", "trash bin", "trash bag", "take out the trash", "taking out the trash", "pond scum",
              "soap scum", "winner or loser", "winners and losers", "worthless check", "stupid question", "idiot proof",
              "retard the", "vermin control"]
SEED_WEIGHT = 3.0

BEGINNINGS = (4, 5, 6, 7, 8)


def _as_letters(run: re.Match) -> str:
    """Stand-ins become letters in a run that has two letters and at least as many letters as stand-ins."""
    text = run.group()
    letters = sum(c not in STANDINS for c in text)
    return "".join(STANDINS.get(c, c) for c in text) if letters >= max(2, len(text) - letters) else text


def fold(text: str) -> str:
    """The folded text, words parted by one blank, with a blank at either end."""
    low = text.lower().translate(FOLD)
    if _STANDIN.search(low):
        low = _RUN.sub(_as_letters, low)
    return f" {_OTHER.sub(' ', low).strip()} "


def terms_of(folded: str) -> set[str]:
    """Every word (blank on both sides) and word beginning (blank in front) of a folded text."""
    terms: set[str] = set()
    for word in set(folded.split()):
        if len(word) > 40 or word.isdigit():
            continue
        terms.add(f" {word} ")
        terms.update(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)
    return terms


# The matcher of the model used last in this process.
_MACHINES: dict[bytes, ahocorasick.Automaton] = {}


@dataclass
class Model:
    """Entries with weights, and the factors of (1, log of the weight sum, log of the weight per 1,000 words)."""

    lexicon: dict[str, float] = field(default_factory=lambda: {f" {w} ": SEED_WEIGHT for w in SEED_TERMS})
    factors: tuple[float, float, float] = (-4.0, 2.0, 1.0)
    exceptions: tuple[str, ...] = tuple(EXCEPTIONS)

    def automaton(self) -> ahocorasick.Automaton:
        """The matcher; a worker process builds it once for all its tasks with the same entries."""
        key = hashlib.sha256(repr((sorted(self.lexicon.items()), self.exceptions)).encode()).digest()
        if key not in _MACHINES:
            _MACHINES.clear()
            _MACHINES[key] = self._built()
        return _MACHINES[key]

    def _built(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for term, weight in self.lexicon.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        machine.make_automaton()
        return machine

    def score(self, features: np.ndarray) -> float:
        z = float(np.dot(features, self.factors))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def weigh(machine: ahocorasick.Automaton, text: str | None) -> tuple[float, int, int]:
    """Weight of a text, matched words, words. Of entries that begin at one place the heaviest counts."""
    folded = fold(text or "")
    found: dict[int, float] = {}
    covered: list[tuple[int, int]] = []
    for end, (length, weight) in machine.iter(folded):
        start = end - length + 1
        if weight is None:
            covered.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    if covered:
        found = {at: w for at, w in found.items() if not any(a <= at < b for a, b in covered)}
    return sum(found.values()), len(found), folded.count(" ") - 1


def features(weight: float, words: int) -> np.ndarray:
    return np.array([1.0, math.log1p(weight), math.log1p(1000.0 * weight / (words + 50.0))])


def _near_copy_key(folded: str) -> int:
    """The least checksum of all five-word runs: equal for copies, and mostly equal for near copies."""
    words = folded.split()
    return min(zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4)))


# Terms counted in a task before their counts are handed on and added up by Spark; bounds memory only.
HELD_TERMS = 100_000


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many toxic and other texts each term stands."""
    schema = pa.schema([("term", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])
    out = Rows(schema)
    counts: dict[str, int] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        while counts:
            term, n = counts.popitem()
            yield from out.add((term, n >> 32, n & 0xFFFFFFFF), 120)

    for batch in batches:
        for folded, toxic in rows_of(batch):
            one = 1 << 32 if toxic else 1  # both counts in one number
            for term in terms_of(folded):
                counts[term] = counts.get(term, 0) + one
                if len(counts) >= HELD_TERMS:
                    yield from emit()
    yield from emit()
    yield from out.flush()


def _ratio(n_pos: int, n_neg: int) -> Column:
    """Log-likelihood ratio of a term's counts (columns pos, neg) against equal rates in both classes."""
    rate = (F.col("pos") + F.col("neg")) / F.lit(float(n_pos + n_neg))
    parts = []
    for seen, n in ((F.col("pos"), float(n_pos)), (F.col("neg"), float(n_neg))):
        for k, p in ((seen, rate), (n - seen, 1 - rate)):
            parts.append(F.when(k > 0, 2 * k * F.log(k / n / p)).otherwise(0.0))
    return parts[0] + parts[1] + parts[2] + parts[3]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_per_class: int = 6000,
    least_ratio: float = 30.0,
    max_entries: int = 20_000,
) -> Model:
    """Learn lexicon weights and score factors from labelled texts.

    At most `sample_per_class` labelled ids of each class are used, those with
    the least hash; near copies among them count once. An id with several labels
    counts as toxic if one of them says so; NULL ids, labels and texts are left
    out. `max_entries` bounds the model, the entries with the highest ratio stay.
    Without labelled texts of both classes the model is the built-in one.
    """
    marked = (
        labels.where(labels[id_col].isNotNull() & labels[label_col].isNotNull())
        .groupBy(labels[id_col].alias("_id"))
        .agg(F.max((labels[label_col] > 0).cast("int")).alias("_toxic"))
    )
    totals = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    picks = [
        marked.where(F.col("_toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(sample_per_class) for c in (0, 1)
    ]
    # At most 2 x sample_per_class pairs of numbers, hence safe to broadcast.
    chosen = F.broadcast(picks[0].unionByName(picks[1]))
    texts = docs.select(docs[id_col].alias("_doc"), docs[text_col].alias("_text")).where(F.col("_text").isNotNull())

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(pa.schema([("folded", pa.string()), ("toxic", pa.int32()), ("near", pa.int64())]))
        for batch in batches:
            for text, toxic in rows_of(batch):
                f = fold(text)
                yield from out.add((f, toxic, _near_copy_key(f)), len(f) + 64)
        yield from out.flush()

    sample = texts.join(chosen, F.col("_doc") == F.col("_id")).select("_text", "_toxic")
    sample = sample.mapInArrow(folded, "folded string, toxic int, near long")
    sample = kept(sample.groupBy("near", "toxic").agg(F.min("folded").alias("folded")).select("folded", "toxic"))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model()

    counted = (
        sample.mapInArrow(_count_terms, "term string, pos long, neg long")
        .groupBy("term")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        # Fewer cannot reach the ratio; far more toxic than other texts must hold the term.
        .where((F.col("pos") >= 5) & (F.col("pos") * n[0] > 4 * F.col("neg") * n[1]))
        .withColumn("ratio", F.round(_ratio(n[1], n[0]), 9))
        .where(F.col("ratio") >= least_ratio)
        .orderBy(F.desc("ratio"), F.desc(F.length("term")), F.desc("term"))
        .limit(max_entries)
        .collect()
    )
    scored = []
    for term, pos, neg, ratio in counted:
        weight = math.log((pos + 0.5) / (n[1] + 1)) - math.log((neg + 0.5) / (n[0] + 1))
        scored.append((ratio, len(term), term, weight, pos))
    lexicon = {f" {w} ": SEED_WEIGHT for w in SEED_TERMS}
    lexicon |= _without_repetition(sorted(scored, reverse=True))
    model = Model(lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, out = model.automaton(), Rows(pa.schema([("weight", pa.float64()), ("words", pa.int64()), ("toxic", pa.int32())]))
        for batch in batches:
            for text, toxic in rows_of(batch):
                weight, _, words = weigh(machine, text)
                yield from out.add((weight, words, toxic))
        yield from out.flush()

    rows = sample.mapInArrow(measured, "weight double, words long, toxic int").orderBy("weight", "words", "toxic").collect()
    x = np.array([features(r["weight"], r["words"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    share = np.array([totals[0] / n[0], totals[1] / n[1]])[y.astype(int)]
    model.factors = tuple(_logistic(x, y, share / share.mean()))
    return model


def _without_repetition(scored: list[tuple[float, int, str, float, int]]) -> dict[str, float]:
    """Entries from the best down, without those that say the same as one taken before.

    A beginning of an entry is only added if it stands in a fifth more toxic
    texts, a continuation only if it weighs more.
    """
    taken: dict[str, float] = {}
    continued: dict[str, int] = {}  # beginning -> most toxic texts of an entry that continues it
    for _, _, term, weight, pos in scored:
        stem = term.strip()
        beginnings = [f" {stem[:k]}" for k in range(min(BEGINNINGS), len(stem) + (term[-1] == " "))]
        if any(weight <= taken.get(b, -math.inf) + 0.1 for b in beginnings) or pos <= 1.2 * continued.get(term, 0):
            continue
        taken[term] = weight
        for b in beginnings:
            continued[b] = max(continued.get(b, 0), pos)
    return taken


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Weighted logistic regression by Newton steps; neither length feature may count against toxicity."""
    active = list(range(x.shape[1]))
    while True:
        b, z = np.zeros(len(active)), x[:, active]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            grad = z.T @ (share * (p - y)) + ridge * b
            hess = (z * (share * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(active))
            step = np.linalg.solve(hess, grad)
            b -= np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        wrong = [a for a, v in zip(active, b, strict=True) if a > 0 and v < 0]
        if not wrong:
            out = [0.0] * x.shape[1]
            for a, v in zip(active, b, strict=True):
                out[a] = round(float(v), 9)
            return out
        active = [a for a in active if a not in wrong]


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), weight, matched_words, words.

    A NULL or empty text has weight 0. Texts are matched whole. Repeated rows and
    NULL ids are kept, an empty table gives an empty result. Only the text is
    read for the score; other columns, whatever their names, are not.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("weight", pa.float64()),
                        ("matched_words", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, out = model.automaton(), Rows(schema)
        for batch in batches:
            for key, text in rows_of(batch):
                weight, matched, words = weigh(machine, text)
                yield from out.add((key, model.score(features(weight, words)), weight, matched, words))
        yield from out.flush()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, weight double, matched_words long, words long")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is below `limit`, with all their columns; rows of NULL or empty texts are judged alike."""

    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = model.automaton()
        for texts in parts:
            weights = (weigh(machine, t) for t in texts)
            yield pd.Series([model.score(features(w, n)) for w, _, n in weights], dtype=float)

    score = F.pandas_udf(scores, "double")

    return docs.where(score(docs[text_col]) < limit)


def trained_part(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Label rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return labels.where(key_crc(id_col) % 3 != 1)
