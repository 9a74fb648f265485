"""Language of every word and of whole texts from a linear-chain conditional random field.

A word's features are the runs of 2 to 4 letters of the word between boundary
marks (those with a mark are its affixes) and its entry in a learned lexicon.
Each feature has a weight per language, neighbouring words are tied by learned
transition weights, and forward-backward gives every word its probability of
each language. A text's share of a language is the mean over its words.

Long texts are cut into blocks. The product of a block's transition matrices
carries the state from block to block, hence the result is that of one pass
over the whole text while all blocks are worked on side by side.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Rows, key_crc, rows_of

SLOTS = 1 << 16
GRAMS = (2, 3, 4)
BLOCK = 64
BATCH_WORDS = 200_000
REMEMBERED = 150_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def gram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word position, slot) of every letter run of the words."""
    text = "".join(f"^{w}$" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    where, slots = [], []
    for n in GRAMS:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = owner[:count] == owner[n - 1 :]
        where.append(owner[:count][inside])
        slots.append((h[inside] >> np.uint64(20)).astype(np.int64) & (SLOTS - 1))
    return np.concatenate(where), np.concatenate(slots)


@dataclass
class Model:
    """Languages, weights (slot x language, then lexicon language x language), transitions and start weights."""

    langs: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)

    def emissions(self, words: list[str]) -> np.ndarray:
        where, slots = gram_slots(words)
        out = np.empty((len(words), len(self.langs)))
        for lang in range(len(self.langs)):
            out[:, lang] = np.bincount(where, weights=self.weights[slots, lang], minlength=len(words))
        if self.lexicon:
            entry = np.array([self.lexicon.get(w, -1) for w in words])
            known = entry >= 0
            out[known] += self.weights[SLOTS + entry[known]]
        return out


class Emissions:
    """Emission weights of words, remembered within a task."""

    def __init__(self, model: Model):
        self.model = model
        self.index: dict[str, int] = {}
        self.table = np.empty((0, len(model.langs)))

    def of(self, words: list[str]) -> np.ndarray:
        fresh = [w for w in set(words) if w not in self.index]
        if len(self.index) + len(fresh) > REMEMBERED and self.index:
            self.index, self.table, fresh = {}, self.table[:0], list(set(words))
        if fresh:
            start = len(self.index)
            self.index.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            self.table = np.concatenate((self.table, self.model.emissions(fresh)))
        return self.table[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]


def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Probability of each language for each word of several texts laid end to end (all lengths positive)."""
    size = emissions.shape[1]
    step = np.exp(transitions - transitions.max())
    # The first word of a text: whatever the row, the start weights.
    first = np.tile(np.exp(start - start.max()), (size, 1))
    blocks_of = -(-lengths // block)
    first_block = np.concatenate(([0], np.cumsum(blocks_of)[:-1]))
    total = int(blocks_of.sum())
    offset = np.arange(len(emissions)) - np.repeat(np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    home = np.repeat(first_block, lengths) + offset // block
    place = offset % block
    held = np.zeros((total, block), bool)
    held[home, place] = True
    local = np.ones((total, block, size))
    local[home, place] = np.exp(emissions - emissions.max(1, keepdims=True))
    opens = np.zeros(total, bool)
    opens[first_block] = True
    entry = np.where(opens[:, None, None], first, step)  # matrix in front of a block's first word

    product = np.tile(np.eye(size), (total, 1, 1))
    for t in range(block):
        on = held[:, t]
        if not on.any():
            break
        grown = (product[on] @ (entry[on] if t == 0 else step)) * local[on, t][:, None, :]
        product[on] = grown / grown.max((1, 2), keepdims=True)

    # From block to block of each text: the state in front of each block, and what follows behind it.
    before = np.zeros((total, size))
    before[first_block, 0] = 1.0
    behind = np.ones((total, size))
    most = int(blocks_of.max()) if total else 0
    for k in range(1, most):
        at = first_block[blocks_of > k] + k
        state = (before[at - 1][:, None, :] @ product[at - 1])[:, 0]
        before[at] = state / state.sum(1, keepdims=True)
    for k in range(most - 2, -1, -1):
        at = first_block[blocks_of > k + 1] + k
        state = (product[at + 1] @ behind[at + 1][:, :, None])[:, :, 0]
        behind[at] = state / state.max(1, keepdims=True)

    forward = np.zeros((total, block, size))
    state = before
    for t in range(block):
        on = held[:, t]
        if not on.any():
            break
        moved = (state[:, None, :] @ entry)[:, 0] if t == 0 else state @ step
        moved = moved * local[:, t]
        moved /= moved.sum(1, keepdims=True)
        forward[:, t] = moved
        state = np.where(on[:, None], moved, state)
    out = np.zeros((total, block, size))
    state = behind
    for t in range(block - 1, -1, -1):
        on = held[:, t]
        if not on.any():
            continue
        out[:, t] = forward[:, t] * state
        moved = (local[:, t] * state) @ step.T if t else state
        moved = moved / moved.max(1, keepdims=True)
        state = np.where(on[:, None], moved, state)
    found = out[home, place]
    return found / found.sum(1, keepdims=True)


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return docs.where(key_crc(id_col) % 5 != 0)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_lang: int = 1000,
    window: int = 120,
    epochs: int = 6,
    seed: int = 17,
) -> Model:
    """Fit the field to a bounded sample: about `sample_per_lang` texts of each language, `window` words of each.

    The texts are those with the least hash of id and text, the words those behind a place
    that the hash gives. Training sequences are put together from pieces of
    several texts, in part of different languages, so that the transition weights
    see changes of language. Rows with NULL text or language, or without a
    letter, teach nothing; without any such row the model knows no language.
    """
    rows = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("_hash"), docs[text_col].alias("_text"), docs[lang_col].alias("_lang"))
    rows = rows.where(F.col("_text").isNotNull() & F.col("_lang").isNotNull())
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((SLOTS, 0)), np.zeros((0, 0)), np.zeros(0))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample_per_lang / counts[k])))])
    chosen = rows.where(F.pmod("_hash", F.lit(1_000_000)) < F.lit(1e6) * F.element_at(share, F.col("_lang")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(pa.schema([("hash", pa.int64()), ("words", pa.string()), ("lang", pa.string())]))
        for batch in batches:
            for key, text, lang in rows_of(batch):
                words = words_of(text)
                if words:
                    at = (key >> 20) % max(1, len(words) - window + 1)
                    yield from out.add((key, " ".join(words[at : at + window]), lang), 1000)
        yield from out.flush()

    sample = chosen.mapInArrow(cut, "hash long, words string, lang string").distinct().orderBy("hash", "words", "lang").collect()
    texts = [(r["words"].split(" "), langs.index(r["lang"])) for r in sample]
    return _train(langs, texts, epochs, seed)


def _train(langs: list[str], texts: list[tuple[list[str], int]], epochs: int, seed: int) -> Model:
    size, rng = len(langs), np.random.default_rng(seed)
    seen: dict[str, Counter] = defaultdict(Counter)
    for words, lang in texts:
        for w in words:
            seen[w][lang] += 1
    lexicon = {w: c.most_common(1)[0][0] for w, c in seen.items() if c.total() >= 3 and c.most_common(1)[0][1] >= 0.8 * c.total()}
    weights = np.zeros((SLOTS + size, size))
    model = Model(langs, weights, np.zeros((size, size)), np.zeros(size), lexicon)
    if not texts:
        return model
    squares = np.full(weights.shape, 1e-2)
    moves, move_squares = model.transitions, np.full((size, size), 1e-2)
    length, rate = 48, 0.3
    for _ in range(epochs):
        pieces = []
        for i in rng.permutation(len(texts)):
            words, lang = texts[i]
            at = 0
            while at < len(words):
                step = int(rng.integers(4, length + 1))
                pieces.append((words[at : at + step], lang))
                at += step
        order = rng.permutation(len(pieces))
        stream_words = [w for i in order for w in pieces[i][0]]
        stream_langs = np.array([pieces[i][1] for i in order for _ in pieces[i][0]])
        per_batch = 64 * length
        for at in range(0, len(stream_words), per_batch):
            words, truth = stream_words[at : at + per_batch], stream_langs[at : at + per_batch]
            where, slots = gram_slots(words)
            entry = np.array([lexicon.get(w, -1) for w in words])
            known = np.nonzero(entry >= 0)[0]
            where, slots = np.concatenate((where, known)), np.concatenate((slots, SLOTS + entry[known]))
            scores = np.stack([np.bincount(where, weights=weights[slots, k], minlength=len(words)) for k in range(size)], 1)
            lengths = np.array([min(length, len(words) - k) for k in range(0, len(words), length)])
            prob = marginals(scores, lengths, moves, model.start)
            error = prob.copy()
            error[np.arange(len(words)), truth] -= 1.0
            used, back = np.unique(slots, return_inverse=True)
            gradient = np.stack([np.bincount(back, weights=error[where, k], minlength=len(used)) for k in range(size)], 1)
            squares[used] += gradient**2
            weights[used] -= rate * gradient / np.sqrt(squares[used])
            # Expected less observed moves; the expected ones from the marginals of neighbours under the field.
            inner = np.nonzero(np.arange(1, len(words)) % length)[0]
            joint = _pairs(scores, prob, lengths, moves, model.start, inner)
            np.subtract.at(joint, (truth[inner], truth[inner + 1]), 1.0)
            move_squares += joint**2
            moves -= rate * joint / np.sqrt(move_squares)
    model.weights = weights.astype(np.float32)
    return model


def _pairs(scores, prob, lengths, transitions, start, inner) -> np.ndarray:
    """Expected number of moves between languages: P(a, b) is the forward state of the left word, the move and the rest."""
    size = scores.shape[1]
    step = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(1, keepdims=True))
    forward = np.zeros_like(scores)
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    state = np.exp(start - start.max()) * local[begins]
    state /= state.sum(1, keepdims=True)
    forward[begins] = state
    for t in range(1, int(lengths.max())):
        at = begins[lengths > t] + t
        state = (forward[at - 1] @ step) * local[at]
        forward[at] = state / state.sum(1, keepdims=True)
    # prob = forward * backward, up to a factor per word.
    backward = prob / np.maximum(forward, 1e-300)
    joint = forward[inner][:, :, None] * step[None] * (local * backward)[inner + 1][:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return joint.sum(0).reshape(size, size)


def _runs(text: str, picks: np.ndarray, langs: list[str]) -> list[dict]:
    """Stretches of words of one language, as character positions in the lower-case text."""
    out: list[dict] = []
    for match, pick in zip(_WORD.finditer(text.lower()), picks, strict=True):
        if out and out[-1]["lang"] == langs[pick]:
            out[-1]["stop"] = match.end()
        else:
            out.append({"lang": langs[pick], "start": match.start(), "stop": match.end()})
    return out


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", segments: bool = False) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score and, if asked for, segments.

    lang_pred is the language with the highest mean probability over the words of
    the whole text, score that mean; ties go to the first by name. A text that is
    NULL or has no letter gets `und` with score 0, and so does every text if the
    model knows no language. segments are stretches of words with the same most
    probable language (positions in the lower-case text). Repeated rows and NULL
    ids are kept. Only the text is read, other columns, whatever their names, are
    not.
    """
    fields = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
    kind = "doc_id long, lang_pred string, score double"
    if segments:
        fields.append(("segments", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))))
        kind += ", segments array<struct<lang: string, start: int, stop: int>>"
    schema = pa.schema(fields)
    # Bounded: (SLOTS + languages) x languages numbers and the lexicon of the training sample.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(known: Emissions, part: list[tuple]) -> Iterator[tuple]:
        own = known.model
        lengths = np.array([len(words) for _, _, words in part if words], dtype=np.int64)
        prob = np.empty((0, len(own.langs)))
        if len(lengths) and own.langs:
            table = known.of([w for _, _, words in part for w in words])
            prob = marginals(table, lengths, own.transitions, own.start)
            means = np.add.reduceat(prob, np.concatenate(([0], np.cumsum(lengths)[:-1]))) / lengths[:, None]
        at = row = 0
        for key, text, words in part:
            if not words or not own.langs:
                yield (key, UNKNOWN, 0.0, []) if segments else (key, UNKNOWN, 0.0)
                continue
            best = int(means[row].argmax())
            found = (key, own.langs[best], min(1.0, float(means[row][best])))
            if segments:
                found += (_runs(text, prob[at : at + len(words)].argmax(1), own.langs),)
            yield found
            at, row = at + len(words), row + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, known, part, held = Rows(schema), Emissions(shared.value), [], 0
        for batch in batches:
            for key, text in rows_of(batch):
                words = words_of(text)
                part.append((key, text if segments else None, words))
                held += len(words)
                if held >= BATCH_WORDS or len(part) >= 5000:
                    for row in judge(known, part):
                        yield from out.add(row)
                    part, held = [], 0
        for row in judge(known, part):
            yield from out.add(row)
        yield from out.flush()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, kind)
