"""Operators with one right answer: byte-pair encoding, top-k, shards, licences, archives."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlake.llm import bpe, licences, queries, sharding, topk, warc

TOKENIZER = queries.tokenizer_path()
DOCS = "doc_id long, text string, size string, shard string, _text string"
HARD = [
    (1, "Hello's WORLD 12,5 <|endoftext|> naïve ﬁ Σίσυφος ΟΔΟΣ", None, "a", "b"),
    (1, "Hello's WORLD 12,5 <|endoftext|> naïve ﬁ Σίσυφος ΟΔΟΣ", None, "a", "b"),
    (2, None, "x", None, None),
    (None, "", "x", None, None),
    (None, "ééé 𝔘𝔫𝔦 \U000e0001 日本語 한국어 Ᲊ", "x", None, None),
    (3, "aß" * 30_000 + " end", "x", None, None),
    (4, " \t\r\n  ", None, None, None),
]


def frame(spark, rows=HARD, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- byte-pair encoding

def test_encoding_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    got = bpe.encode_texts(frame(spark), TOKENIZER)
    want = []
    for key, text, *_ in HARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted_rows(got) == sorted(want, key=repr)
    digest = {r["doc_id"]: r for r in bpe.with_id_digest(got).collect()}
    ids = library.encode(HARD[0][1], add_special_tokens=False).ids
    assert digest[1]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert digest[1]["n_tokens"] == len(ids)
    assert digest[2]["n_tokens"] == 0 and digest[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()


def test_encoding_of_random_texts():
    from tokenizers import Tokenizer

    library, own, rng = Tokenizer.from_file(TOKENIZER), bpe.Encoder(TOKENIZER), random.Random(5)
    for _ in range(3000):
        top = rng.choice([0x7F, 0x250, 0x3000, 0x110000])
        text = "".join(chr(c) for c in (rng.randrange(top) for _ in range(rng.randrange(25))) if not 0xD800 <= c < 0xE000)
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_long_words_equal_the_library_in_bounded_time():
    from tokenizers import Tokenizer

    library, own, rng = Tokenizer.from_file(TOKENIZER), bpe.Encoder(TOKENIZER), random.Random(6)
    words = ["a" * 300_000, "ab" * 2000, "the" * 3000, "".join(rng.choice("aeinrst") for _ in range(50_000))]
    words += ["".join(rng.choice("abcdehilnorstu") for _ in range(rng.randrange(40, 200))) for _ in range(300)]
    start = time.process_time()
    found = [own.encode(w) for w in words]
    assert time.process_time() - start < 30
    for word, ids in zip(words, found, strict=True):
        assert ids == library.encode(word, add_special_tokens=False).ids, word[:50]


def test_cuts_never_part_a_token():
    own = bpe.Encoder(TOKENIZER)
    for token in list(own.ids)[:5000]:
        chars = own.symbols_of(token.removesuffix(bpe.WORD_END)) if token.endswith(bpe.WORD_END) and token != bpe.WORD_END else list(token)
        assert len(list(own.cut(chars))) == 1


# ---- exact search

VECTORS = "vec_id long, embedding array<double>, score string, rank string"


def brute_top(vectors, queries, k):
    whole = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in vectors
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if i in queries and (i not in asked or v < asked[i]):
            asked[i] = v
    out = []
    for q, v in asked.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 6) / 7]) for i in range(60)]  # many ties
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (62, [float("nan")] * 6), (63, [float("inf")] * 6),
             (64, []), (65, [0.5]), (None, [1.0] * 6), (7, rows[7][1]), (66, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "s", "r") for r in rows], VECTORS).repartition(3)
    got = topk.exact_top_k(df, df.where(F.col("vec_id") % 7 == 0), 5, query_block=4, candidate_block=9)
    assert sorted(sorted_rows(got)) == brute_top(rows, {i for i in range(0, 70, 7)}, 5)


def test_top_k_of_few_and_of_very_large_numbers(spark):
    rows = [(0, [1e6, -1e6]), (1, [2e6, 1.0]), (2, [-1e6, 3.0])]
    df = spark.createDataFrame([(*r, None, None) for r in rows], VECTORS)
    assert sorted(sorted_rows(topk.exact_top_k(df, df.where("vec_id = 0"), 5))) == brute_top(rows, {0}, 5)
    huge = spark.createDataFrame([(0, [1e300], None, None), (1, [1e300], None, None)], VECTORS)
    assert topk.exact_top_k(huge, huge.where("vec_id = 0"), 5).first()["score"] == topk.LARGEST
    assert topk.exact_top_k(df.limit(0), df.limit(0), 5).count() == 0
    assert topk.exact_top_k(df.where("vec_id = 1"), df.where("vec_id = 1"), 5).count() == 0


# ---- shards

def brute_shards(rows, shards):
    sized = sorted(((k is not None, k or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t, *_ in rows))
    total, before, out, slots = sum(r[2] for r in sized), 0, [], {}
    for there, k, size, crc in sized:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((k if there else None, size, crc, "bytes", shard, slots[shard], None))
        before += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_equal_brute_force(spark, shards):
    rows = HARD + [(i % 50, "x" * (i * 37 % 400), None, None, None) for i in range(300)]
    assert sorted_rows(sharding.byte_shards(frame(spark, rows).repartition(5), shards)) == brute_shards(rows, shards)


def test_shards_of_nothing(spark):
    assert sharding.byte_shards(frame(spark, []), 24).count() == 0
    with pytest.raises(ValueError):
        sharding.byte_shards(frame(spark), 0)


def test_shards_are_near_equal(spark):
    rows = [(i, "y" * (i % 97), None, None, None) for i in range(2000)]
    sums = sharding.byte_shards(frame(spark, rows), 24).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sums) == 24 and max(r["s"] for r in sums) - min(r["s"] for r in sums) <= 2 * (96 + 8)


# ---- licences

def test_licences(spark):
    mit = next(t for i, t in licences.KNOWN if i == "MIT" and t.startswith("MIT License"))
    british = mit.replace("MIT License", "Copyright (c) 2020 A\nMIT LICENCE").replace("sublicense", "sub" + "licence").replace(",", " ;")
    rows = [
        (1, mit, "a", "b", "c"),
        (2, british, None, None, None),
        (3, "Prose.\n  released UNDER the mit licence!\nReleased under the MIT License.\nAll rights reserved", None, None, None),
        (3, "Prose.\n  released UNDER the mit licence!\nReleased under the MIT License.\nAll rights reserved", None, None, None),
        (None, "Released under the MIT License and more", None, None, None),
        (4, None, None, None, None),
        (5, "", None, None, None),
        (6, mit + "\nexcept on Sundays", None, None, None),
    ]
    got = sorted_rows(licences.scan_licences(frame(spark, rows)))
    two = (3, None, ["LicenseRef-all-rights-reserved", "MIT"], 3)
    # A line of the long text is a notice of its own only if it is known as such.
    want = [(1, "MIT", [], 0), (2, "MIT", [], 0), two, two, (None, None, [], 0), (4, None, [], 0), (5, None, [], 0), (6, None, [], 0)]
    assert got == sorted(want, key=repr)
    assert licences.scan_licences(frame(spark, [])).count() == 0
    own = spark.createDataFrame([("Own", "Organised favours; optimised programme!"), ("Never", None)], "licence_id string, text string")
    some = frame(spark, [(1, "organized FAVORS\toptimized program", None, None, None), (2, "organized", None, None, None)])
    assert sorted_rows(licences.scan_licences(some, own)) == [(1, "Own", ["Own"], 1), (2, None, [], 0)]


# ---- archives

PAGES = "page_id long, url string, html string, offset string, file string"
LONG = "<p>é</p>" * 40


def test_archives(spark, tmp_path):
    rows = [
        (5, "http://b.example.org/x", LONG, None, None),
        (3, "http://b.example.org/x", LONG, None, None),
        (3, "http://b.example.org/x", LONG, None, None),
        (9, "https://www.a.example.org:8080/Q?b#c", "short", None, None),
        (8, "https://a.example.org/q", "short", None, None),
        (7, None, None, None, None),
        (6, "http://evil/\r\nWARC/1.1\r\n", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + LONG, None, None),
        (None, "http://b.example.org/x", LONG, None, None),
    ]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), path)
    captures = warc.read_archives(spark, path)
    index = warc.merge_index(captures).orderBy("position").collect()
    assert [r["position"] for r in index] == list(range(len(rows)))
    keys = [(r["urlkey"], r["captured_at"]) for r in index]
    assert keys == sorted(keys)
    digest = hashlib.sha256(LONG.encode()).hexdigest()
    got = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in index if r["payload_digest"] == digest)
    n = len(LONG.encode())
    assert got == [(-1, "revisit", 3, n, digest), (3, "response", None, n, digest), (3, "response", None, n, digest), (5, "revisit", 3, n, digest)]
    others = {r["page_id"]: r for r in index if r["payload_digest"] != digest}
    assert {k: r["record_type"] for k, r in others.items()} == {6: "response", 7: "response", 8: "response", 9: "response"}
    assert others[7]["payload_bytes"] == 0 and others[7]["url"] is None
    assert others[6]["payload_bytes"] == len(rows[6][2].encode())
    assert others[9]["urlkey"] == "org,example,a)/q?b"
    assert [r["capture"] for r in index if r["urlkey"] == "org,example,b)/x"] == [1, 2, 3, 4]


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.merge_index(warc.read_archives(spark, path)).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 5, 8, 13])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(12))) for _ in range(k)]
    merged = list(warc.LoserTree([iter([(x,) for x in run]) for run in runs], key=lambda r: r))
    assert [m[0] for m in merged] == sorted(x for run in runs for x in run)
