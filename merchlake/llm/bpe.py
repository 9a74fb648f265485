"""Byte-pair encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side in no vocabulary token can
never end up in one token, so a word may be cut between them for certain. The
fragments are merged independently of each other and their ids put one behind
the other. Fragments are short and recur, so a task remembers them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Rows, rows_of

WORD_END = "</w>"
# How many fragments and words a task remembers before it starts anew.
REMEMBERED = 150_000
NO_MERGE = 1 << 60
# Symbols of a fragment from which on pairs are kept in a heap.
LONG = 48

# Fixed value: the vocabulary's own split of normalised text.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Outside these blocks the Unicode tables of `regex` and of the tokenizer differ; such texts are split by the latter.
SETTLED = regex.compile(
    r"[\u0000-ԯḀ-῿ - ₠-₿℀-⯿　-ヿ一-龥가-힣"
    r"！-～\U0001f300-\U0001f64f]*"
)
# The same split for texts up to the Latin extensions, written out as ranges: these run twice as fast.
LATIN = re.compile(r"[\u0000-\u024f]*")
_LETTERS, _NUMBERS, _BLANKS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next character from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class Encoder:
    """The vocabulary of one tokenizer file, its certain cuts, and what has been encoded so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.split_rare = library.pre_tokenizer.pre_tokenize_str
        self.ids: dict[str, int] = parts["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in parts["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.specials = added
        longest_first = sorted(added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.tokens = {i: t for t, i in [*self.ids.items(), *added.items()]}
        self.adjacent = {pair for token in self.ids for pair in self._neighbours(token)}
        self.symbols = byte_symbols()
        self.fragments: dict[tuple, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def symbols_of(mapped: str) -> list[str]:
        """Single symbols; the last one carries the word end."""
        return [*mapped[:-1], mapped[-1] + WORD_END]

    @classmethod
    def _neighbours(cls, token: str) -> Iterator[tuple[str, str]]:
        ends = token.endswith(WORD_END) and len(token) > len(WORD_END)
        chars = cls.symbols_of(token.removesuffix(WORD_END)) if ends else list(token)
        return zip(chars, chars[1:], strict=False)

    def cut(self, symbols: list[str]) -> Iterator[tuple[str, ...]]:
        """Fragments between the certain boundaries."""
        start = 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in self.adjacent:
                yield tuple(symbols[start:i])
                start = i
        yield tuple(symbols[start:])

    def merge(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """Merge the lowest-ranked pair, leftmost first, until none is left. Every symbol has an id, so nothing is lost."""
        if len(fragment) > LONG:
            return self._merge_long(fragment)
        parts, rank = list(fragment), self.ranks.get
        ranked = [rank(pair, NO_MERGE) for pair in zip(parts, parts[1:], strict=False)]
        while ranked and (best := min(ranked)) < NO_MERGE:
            i = ranked.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranked[i]
            if i > 0:
                ranked[i - 1] = rank((parts[i - 1], parts[i]), NO_MERGE)
            if i < len(ranked):
                ranked[i] = rank((parts[i], parts[i + 1]), NO_MERGE)
        return tuple(map(self.ids.__getitem__, parts))

    def _merge_long(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """`merge` with a heap of pairs over linked parts: n log n, for words of any length."""
        parts, n, rank = list(fragment), len(fragment), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # A pair whose parts have changed since is no longer there.
            if parts[i] is None or j == n or rank((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (new, h))
        return tuple(self.ids[p] for p in parts if p is not None)

    def word(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            mapped = word.encode("utf-8").decode("latin-1").translate(self.symbols)
            out: list[int] = []
            for fragment in self.cut(self.symbols_of(mapped)):
                ids = self.fragments.get(fragment)
                if ids is None:
                    if len(self.fragments) >= REMEMBERED:
                        self.fragments.clear()
                    ids = self.merge(fragment)
                    if len(fragment) <= 32:
                        self.fragments[fragment] = ids
                out.extend(ids)
            found = tuple(out)
            if len(word) <= 64:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[word] = found
        return found

    def split(self, text: str) -> list[str]:
        """The words of a text after normalisation."""
        # The capital sigma is lowered by its neighbours here, but on its own by the tokenizer.
        if not SETTLED.fullmatch(text) or "\u03a3" in text:
            normal = self.normalize(text)
            return [normal[a:b] for _, (a, b) in self.split_rare(normal)]
        normal = unicodedata.normalize("NFC", text).lower()
        return (LATIN_WORDS if LATIN.fullmatch(normal) else WORDS).findall(normal)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.specials:
                ids.append(self.specials[part])
            elif part:
                for word in self.split(part):
                    ids.extend(self.words.get(word) or self.word(word))
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array of int), decoded (text made from the ids).

    `path` names a tokenizer file of byte-level BPE with word ends that every
    executor can read. Strings of its special tokens inside a text become those
    tokens. A NULL or empty text gives no ids and an empty decoded text; texts
    are encoded whole, whatever their length. Repeated rows and NULL ids are
    kept. Other input columns, whatever their names, are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = encoder(path), Rows(schema)
        for batch in batches:
            for key, text in rows_of(batch):
                ids = own.encode(text or "")
                # A list holds 8 bytes and more for each id until the batch is made.
                yield from out.add((key, np.array(ids, dtype=np.int32), own.decode(ids)), 4 * len(ids) + 2 * len(text or "") + 64)
        yield from out.flush()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def with_id_digest(encoded: DataFrame) -> DataFrame:
    """n_tokens, and the SHA-256 of the ids as little-endian unsigned 32-bit numbers and of the decoded text."""

    @F.pandas_udf("string")
    def digest(ids):
        return ids.map(lambda x: hashlib.sha256(np.asarray(x, dtype="<u4").tobytes()).hexdigest())

    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
