"""Benchmark items inside training texts: BM25 with block-max WAND, then word-run overlap.

Every text is cut into overlapping passages, so long that any item lies in one
of them as a whole. Each passage is a query against an inverted index of the
items; postings are kept in blocks with the highest score inside. WAND skips
items that cannot reach the threshold by the terms' highest scores, and blocks
that cannot by the blocks' ones. What comes back is all items above the
threshold. Question and answer of such an item are then looked for in the
passage as runs of words.

Scores are relative: the BM25 score of an item against a passage, over that of
the item against itself, so 1 means that the passage holds all its words.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Rows, rows_of

K1, B = 1.2, 0.75
POSTING_BLOCK = 4
SLACK = 1e-9
# Passages times blocks looked at together.
CELLS = 1 << 21
RUN = 5
# Items go into one index up to this many; more take several passes over the texts, so an index stays small.
ITEMS_PER_INDEX = 20_000
SHORTEST_PASSAGE = 64
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer of an item given as one text: the last sentence or line is the answer."""
    ends = [m.end() for m in re.finditer(r"[.!?](?=\s)|\n", text.strip())]
    cut = ends[-1] if ends else len(text.strip())
    return text.strip()[:cut], text.strip()[cut:]


def runs(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of RUN words; fewer words are one run."""
    if not words:
        return set()
    return {tuple(words[i : i + RUN]) for i in range(max(1, len(words) - RUN + 1))}


class Index:
    """Inverted index of items of similar length, with term-wide and block-wide highest scores."""

    def __init__(self, items: list[tuple[int, str, str]], idf: dict[str, float], mean_length: float, passage: int, known: dict[str, int]):
        self.passage, self.stride = passage, passage // 2
        self.keys = [key for key, _, _ in items]
        questions = [words_of(q) for _, q, _ in items]
        answers = [words_of(a) for _, _, a in items]
        self.question_runs = [runs(q) for q in questions]
        self.answer_runs = [runs(a) for a in answers]
        self.terms: dict[str, int] = {}
        self.known = known
        postings: list[list[tuple[int, float]]] = []
        for number, words in enumerate(q + a for q, a in zip(questions, answers, strict=True)):
            counts = Counter(words)
            norm = K1 * (1 - B + B * len(words) / mean_length)
            scores = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in counts.items()}
            own = sum(scores.values())
            for w, score in scores.items():
                if w not in self.terms:
                    self.terms[w] = len(postings)
                    postings.append([])
                postings[self.terms[w]].append((number, score / own))
        # From the numbers of all words of all indexes to the terms of this one (-1: none), the last for other words.
        self.own = np.full(len(known) + 1, -1, np.int64)
        for word, term in self.terms.items():
            self.own[known[word]] = term
        self.docs = [[d for d, _ in p] for p in postings]
        self.scores = [[s for _, s in p] for p in postings]
        self.highest = np.array([max(s) for s in self.scores])
        self.blocks = -(-len(items) // POSTING_BLOCK)
        # Highest score of every term in every block of items that holds it, term by term.
        highest_in: list[dict[int, float]] = [{} for _ in postings]
        for term, entries in enumerate(postings):
            for item, score in entries:
                block = item // POSTING_BLOCK
                highest_in[term][block] = max(score, highest_in[term].get(block, 0.0))
        self.first = np.concatenate(([0], np.cumsum([len(h) for h in highest_in]))).astype(np.int64)
        self.block = np.array([b for h in highest_in for b in h], np.int64)
        self.block_highest = np.array([s for h in highest_in for s in h.values()])

    def bounds(self, group: np.ndarray, terms: np.ndarray, groups: int) -> np.ndarray:
        """(group x block): what the items of a block can score at most over the terms of a group."""
        width = self.first[terms + 1] - self.first[terms]
        at = np.repeat(self.first[terms] - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
        cell = np.repeat(group, width) * self.blocks + self.block[at]
        return np.bincount(cell, weights=self.block_highest[at], minlength=groups * self.blocks).reshape(groups, self.blocks)

    def above(self, terms: list[int], threshold: float, bounds: np.ndarray) -> list[tuple[int, float]]:
        """(item, score) of all items whose score over the distinct `terms` reaches the threshold.

        `bounds` has the highest possible score of each block of items.
        """
        found = []
        limit = threshold - SLACK
        live = np.nonzero(bounds >= limit)[0].tolist()
        if not live:
            return found
        lists = [[-1, t, 0] for t in terms]  # current item, term, position in the postings
        following = live[0] * POSTING_BLOCK
        while True:
            moved = []
            for item, t, at in lists:
                if item < following:
                    at = bisect_left(self.docs[t], following, at)
                    if at == len(self.docs[t]):
                        continue
                    item = self.docs[t][at]
                moved.append([item, t, at])
            lists = moved
            lists.sort()
            bound, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(lists):
                bound += self.highest[t]
                if bound >= limit:
                    pivot = i
                    break
            if pivot < 0:
                return found
            target = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == target:
                pivot += 1
            block = target // POSTING_BLOCK
            if bounds[block] >= limit:
                score = sum(self.scores[t][at] for item, t, at in lists[: pivot + 1] if item == target)
                # Lists before the pivot may lag behind: they are brought to the target and count as well.
                for item, t, at in lists[: pivot + 1]:
                    if item < target:
                        at = bisect_left(self.docs[t], target, at)
                        if at < len(self.docs[t]) and self.docs[t][at] == target:
                            score += self.scores[t][at]
                if score >= limit:
                    found.append((target, score))
                following = target + 1
            else:
                # No item of this block can reach the threshold: on to the next block in which one can.
                after = bisect_left(live, block)
                if after == len(live):
                    return found
                following = live[after] * POSTING_BLOCK

    def hits(self, words: list[str], numbers: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(item, first word, score, question overlap, answer overlap) for each passage and item above the threshold."""
        size, ids = len(self.terms), self.own[numbers]
        place = np.nonzero(ids >= 0)[0]
        if not len(place):
            return
        passages = max(1, -(-(len(words) - self.stride) // self.stride))
        # A word lies in the passage that begins with its half and in the one before; the last passage takes the rest.
        half = place // self.stride
        pairs = np.concatenate([np.minimum(half, passages - 1) * size + ids[place],
                                np.clip(half - 1, 0, passages - 1) * size + ids[place]])
        passage, terms = np.divmod(np.unique(pairs), size)
        cuts = np.searchsorted(passage, np.arange(passages + 1))
        step = max(1, CELLS // self.blocks)
        for start in range(0, passages, step):
            stop = min(passages, start + step)
            part = slice(cuts[start], cuts[stop])
            bounds = self.bounds(passage[part] - start, terms[part], stop - start)
            for k in np.nonzero((bounds >= threshold - SLACK).any(1))[0] + start:
                begin = int(k) * self.stride
                end = len(words) if k == passages - 1 else min(begin + self.passage, len(words))
                passage_runs = None
                own = terms[cuts[k] : cuts[k + 1]].tolist()
                for item, score in self.above(own, threshold, bounds[k - start]):
                    passage_runs = passage_runs or _all_runs(words[begin:end])
                    overlaps = [
                        sum(r in passage_runs for r in wanted) / len(wanted) if wanted else 1.0
                        for wanted in (self.question_runs[item], self.answer_runs[item])
                    ]
                    yield item, begin, score, *overlaps


def _all_runs(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of every length up to RUN, as short answers are one run."""
    return {tuple(words[i : i + n]) for n in range(1, RUN + 1) for i in range(len(words) - n + 1)}


def build_indexes(items: DataFrame, id_col: str, question_col: str | None, answer_col: str | None, text_col: str) -> list[Index]:
    """Indexes of all items, by length class. Items without words, and NULL ids, are left out."""
    if question_col:
        cols = [F.col(id_col), F.col(question_col), F.col(answer_col) if answer_col else F.lit(None).cast("string")]
        rows = [(k, q or "", a or "") for k, q, a in items.select(*cols).where(F.col(id_col).isNotNull()).toLocalIterator()]
    else:
        texts = items.select(id_col, text_col).where(F.col(id_col).isNotNull()).toLocalIterator()
        rows = [(k, *parts_of(t or "")) for k, t in texts]
    rows = sorted({r for r in rows if words_of(r[1]) or words_of(r[2])})
    lengths = {r: len(words_of(r[1])) + len(words_of(r[2])) for r in rows}
    frequency: Counter = Counter()
    for r in rows:
        frequency.update(set(words_of(r[1]) + words_of(r[2])))
    idf = {w: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w, n in frequency.items()}
    mean = sum(lengths.values()) / max(1, len(rows))
    known = {w: i for i, w in enumerate(sorted(frequency))}
    classes: dict[int, list] = {}
    for r in rows:
        # Passages are twice as long as the longest item of a class and start every half passage.
        passage = SHORTEST_PASSAGE
        while passage < 2 * lengths[r]:
            passage *= 2
        classes.setdefault(passage, []).append(r)
    return [
        Index(members[i : i + ITEMS_PER_INDEX], idf, mean, passage, known)
        for passage, members in sorted(classes.items())
        for i in range(0, len(members), ITEMS_PER_INDEX)
    ]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.5,
    overlap: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    question_col: str | None = None,
    answer_col: str | None = None,
) -> DataFrame:
    """One row per row of `docs` and item found in it: doc_id, item_id, score, question_overlap, answer_overlap, first_word.

    An item is found if some passage scores `threshold` or more and holds a share
    of `overlap` or more of the question's and of the answer's runs of five words
    (fewer words: the whole of them). Of several passages the one with the
    highest score is reported, then the first. Items given as one text are parted
    before their last sentence; an empty part counts as held. `items` is the
    reference set to be protected: it is read to the driver and indexed there, in
    indexes of at most ITEMS_PER_INDEX items, each of which takes one look at the
    passages. NULL or empty texts hold nothing; items without a word, and NULL
    item ids, are not looked for; repeated items count once. Repeated rows and
    NULL doc ids are kept. Empty tables give an empty result. Texts are read
    whole; other columns, whatever their names, are not read.
    """
    indexes = build_indexes(items, item_col, question_col, answer_col, item_text_col)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("first_word", pa.int64())])
    kind = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"
    shared = docs.sparkSession.sparkContext.broadcast(indexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for key, text in rows_of(batch):
                words = words_of(text)
                for row in _best(words, shared.value, threshold, overlap):
                    yield from out.add((key, *row))
        yield from out.flush()

    return rows.mapInArrow(run, kind)


def _best(words: list[str], indexes: list[Index], threshold: float, overlap: float) -> list[tuple]:
    best: dict[int, tuple] = {}
    if not words or not indexes:
        return []
    known = indexes[0].known
    numbers = np.fromiter(map(known.get, words, repeat(len(known))), np.int64, len(words))
    for index in indexes:
        for item, begin, score, question, answer in index.hits(words, numbers, threshold):
            if question >= overlap and answer >= overlap:
                key = index.keys[item]
                if key not in best or (-score, begin) < (-best[key][1], best[key][4]):
                    best[key] = (key, score, question, answer, begin)
    return [best[k] for k in sorted(best)]


def without_items(
    docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.8, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns; see find_items."""
    indexes = build_indexes(items, item_col, None, None, item_text_col)
    shared = docs.sparkSession.sparkContext.broadcast(indexes)

    @F.pandas_udf("boolean")
    def clean(texts):
        return texts.map(lambda t: not _best(words_of(t), shared.value, threshold, overlap)).astype(bool)

    return docs.where(clean(docs[text_col]))
