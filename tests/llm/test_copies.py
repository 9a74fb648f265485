"""SimHash groups, benchmark items, surrogates and the pipeline, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from merchlake.llm import decontaminate, graph, simhash, surrogates, toxicity

SMALL = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, node string, _row string, print string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "n", None, "p") for k, t in rows], DOCS)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def brute_print(text, k=4):
    w = words(text)
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def copies(seed=3):
    rng = random.Random(seed)
    rows = []
    for f in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 20, 200, 400]))]
        for _ in range(rng.choice([1, 3, 8])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(9)}"
            rows.append((len(rows) + 10, " ".join(own)))
    return [*rows, (1, None), (2, ""), (3, " \t\n"), (4, "ÀB ab"), (5, "Àb AB"), (11, rows[1][1]), (11, rows[1][1]), (None, rows[0][1])]


def test_groups_equal_brute_force(spark):
    rows = copies()
    prints = [brute_print(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = union(len(rows), near)
    least = defaultdict(list)
    for (k, _), r in zip(rows, root, strict=True):
        if k is not None:
            least[r].append(k)
    want = [(k, f"{p:016x}", min(least[r])) for (k, _), p, r in zip(rows, prints, root, strict=True)]
    got = [tuple(r) for r in simhash.near_copies(frame(spark, rows).repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_copies(frame(spark, [])).count() == 0


def test_large_shards_are_cut_into_trees(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE_SIZE", 8)
    rng = random.Random(1)
    base = rng.getrandbits(64)
    values = {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 9]))) for _ in range(120)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    got = {r["node"]: r["root"] for r in simhash.fingerprint_groups(spark.createDataFrame([(v,) for v in values], "print long")).collect()}
    near = [(i, j) for i in range(len(values)) for j in range(i) if ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 4]
    root = union(len(values), near)
    linked = {i for pair in near for i in pair}
    assert got == {values[i]: values[root[i]] for i in linked}


@pytest.mark.parametrize("radius", [0, 2, 5, 64])
def test_tree_finds_all(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = np.concatenate((base, base ^ np.uint64(5), base[:7]))
    q, n = simhash.BKTree(prints).within(prints, radius)
    want = {(i, j) for i in range(len(prints)) for j in range(len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= radius}
    assert set(zip(q.tolist(), n.tolist(), strict=True)) == want and len(q) == len(want)
    assert len(simhash.BKTree(prints[:0]).within(prints, 3)[0]) == 0


def test_masks_leave_no_gap():
    rng = random.Random(2)
    found = [m & (2**64 - 1) for m in simhash.masks(4, 2)]
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(flips & m == 0 for m in found)


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(7, 7), (200, 200)]
    root = union(300, edges)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root[x] for e in edges if e[0] != e[1] for x in e}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def runs(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_stays(docs):
    """docs: [(id, text)] with unique ids; ids that stay, and ids about which similarities around 0.8 leave room."""
    docs = sorted(docs)
    sets = [runs(t) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for r in s or [None]:
            holders[r].append(i)
    near, border = [], set()
    for i, s in enumerate(sets):
        shared = Counter(j for r in s or [None] for j in holders[r] if j < i)
        for j, n in shared.items():
            similar = n / len(s | sets[j]) if s else 1.0
            if similar >= 0.8:
                near.append((i, j))
            if 0.68 <= similar < 0.9:
                border |= {docs[i][0], docs[j][0]}
    root = union(len(docs), near)
    return {docs[i][0] for i in range(len(docs)) if root[i] == i}, border


def test_stage_drops_copies(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, border = brute_stays([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"] for r in simhash.without_near_copies(docs).collect()}
    assert (got ^ want) <= border and len(got ^ want) <= 4


def test_stage_on_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text), (5, text), (3, text + " more"), (None, text), (None, None), (8, ""), (9, "alone here"), (9, "other words"), (None, "nobody")]
    got = simhash.without_near_copies(frame(spark, rows).repartition(3))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(3, text + " more"), (8, ""), (9, "alone here"), (9, "other words"), (None, "nobody")], key=repr)
    assert got.columns == frame(spark, rows).columns
    assert simhash.without_near_copies(frame(spark, [])).count() == 0


# ---- benchmark items

def index_of(items):
    counts = Counter(w for _, q, _ in items for w in set(decontaminate.words_of(q)))
    idf = {w: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for w, n in counts.items()}
    return decontaminate.Index(items, idf, 8.0, 64, {w: i for i, w in enumerate(counts)})


def test_wand_equals_exhaustive_scores():
    rng = random.Random(3)
    for _ in range(150):
        vocabulary = [f"w{i}" for i in range(rng.choice([8, 30, 80]))]
        index = index_of([(i, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 20))), "") for i in range(rng.choice([1, 5, 40]))])
        terms = sorted({index.terms[w] for w in rng.choices(vocabulary, k=15) if w in index.terms})
        if not terms:
            continue
        threshold = rng.choice([0.1, 0.3, 0.5, 0.8])
        scores = Counter()
        for t in terms:
            for item, score in zip(index.docs[t], index.scores[t], strict=True):
                scores[item] += score
        bounds = index.bounds(np.zeros(len(terms), int), np.array(terms), 1)[0]
        got = sorted((i, round(s, 9)) for i, s in index.above(terms, threshold, bounds))
        assert got == sorted((i, round(s, 9)) for i, s in scores.items() if s >= threshold - 1e-9)


def brute_items(docs, items):
    """Items of which 0.8 of the runs of both parts occur anywhere in the text."""
    found = set()
    for key, text in docs:
        held = decontaminate._all_runs(decontaminate.words_of(text))
        for item, whole in items:
            parts = [decontaminate.runs(decontaminate.words_of(p)) for p in decontaminate.parts_of(whole)]
            if any(parts) and all(not p or sum(r in held for r in p) >= 0.8 * len(p) for p in parts):
                found.add((key, item))
    return found


def test_items_found(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(docs, items).collect()}
    assert got == brute_items([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()]) != set()
    clean = {r["doc_id"] for r in decontaminate.without_items(docs, items).collect()}
    assert clean == {r["doc_id"] for r in docs.select("doc_id").collect()} - {d for d, _ in got}


def test_items_in_odd_rows(spark):
    question = " ".join(f"q{i}" for i in range(70)) + ". Answer is blue."
    items = spark.createDataFrame([(1, question), (1, question), (2, None), (3, "..."), (None, "lost item of five words")], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(10_000))
    rows = [(1, question), (1, question), (None, filler + " " + question.upper() + " " + filler), (2, None), (3, ""),
            (4, question.split(".")[0]), (5, "Answer is blue."), (6, "lost item of five words")]
    got = decontaminate.find_items(frame(spark, rows), items).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == [(1, 1), (1, 1), (None, 1)]
    assert decontaminate.find_items(frame(spark, []), items).count() == 0
    assert decontaminate.find_items(frame(spark, rows), items.limit(0)).count() == 0
    assert decontaminate.without_items(frame(spark, rows), items.limit(0)).count() == len(rows)
    parts = spark.createDataFrame([(1, "who is it that came here", "the fox")], "item_id long, q string, a string")
    two = frame(spark, [(1, "Who is it that came here? The fox!"), (2, "who is it that came here? the dog")])
    named = decontaminate.find_items(two, parts, question_col="q", answer_col="a").collect()
    assert [(r["doc_id"], r["item_id"]) for r in named] == [(1, 1)]


# ---- surrogates

PEOPLE = [
    (1, "Mail Foo.Bar@mail7.Example.com or foo.bar@mail7.example.com, +1 (017) 555-7713 and +10175557713."),
    (1, "Mail Foo.Bar@mail7.Example.com or foo.bar@mail7.example.com, +1 (017) 555-7713 and +10175557713."),
    (2, "Mrs. Maria Keller met Mr. KELLER and Mr. Jon Keller at 10.2.3.4; г-жа Анна Петрова."),
    (3, "card 4111 1111 1111 1111 or 4111111111111111, ssn 123-45-6789, DE89 3704 0044 0532 0130 00"),
    (4, None), (5, ""), (None, 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" 999.1.1.1'), (6, "no entity 12 here"),
]


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10


def test_surrogates(spark):
    df = frame(spark, PEOPLE)
    out = surrogates.replace_personal_data(df, "key", count_col="n")
    assert out.columns == [*df.columns, "n"] and out.count() == len(PEOPLE)
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert (by_id[4]["text"], by_id[5]["text"], by_id[6]["text"]) == (None, "", "no entity 12 here")
    first = re.fullmatch(r"Mail (\S+) or (\S+), \+1 \((\d{3})\) (\d{3})-(\d{4}) and \+(\d{11})\.", by_id[1]["text"])
    assert first[1] == first[2] and re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\d\.example", first[1])
    assert "1" + first[3] + first[4] + first[5] == first[6] != "10175557713"
    names = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) and Mr\. (\w+) (\w+) at ([\d.]+); г-жа ([А-я]+) ([А-я]+)\.", by_id[2]["text"])
    assert names[2].upper() == names[3] and names[2] == names[5] != "Keller"
    assert names[1] in surrogates.FIRST[("latin", "f")] and names[4] in surrogates.FIRST[("latin", "m")]
    assert names[7] in surrogates.FIRST[("cyrillic", "f")] and names[6] != "10.2.3.4"
    numbers = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) or (\d{16}), ssn (\d{3}-\d\d-\d{4}), (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d)", by_id[3]["text"])
    assert numbers[1].replace(" ", "") == numbers[2] and luhn(numbers[2]) == 0
    assert re.fullmatch(r'token = "[0-9a-f]{40}" 999\.1\.1\.1', by_id[None]["text"])
    again = {r["doc_id"]: r["text"] for r in surrogates.replace_personal_data(df.repartition(5), "key").collect()}
    assert again == {k: r["text"] for k, r in by_id.items()}
    other = {r["doc_id"]: r["text"] for r in surrogates.replace_personal_data(df, "other").collect()}
    assert other[1] != again[1]
    assert surrogates.replace_personal_data(frame(spark, []), "key").count() == 0
    with pytest.raises(ValueError):
        surrogates.replace_personal_data(df, "")


def test_surrogates_stay_distinct(spark):
    # More surnames than the list has, and short numbers that would meet often.
    values = [("last_latin", f"name{i}") for i in range(300)] + [("ssn", f"{i:03d}") for i in range(400)]
    given = surrogates.assign(spark.createDataFrame(values, "kind string, value string"), "key").collect()
    assert len(given) == len(values) and len({(r["kind"], r["surrogate"]) for r in given}) == len(values)
    assert not {(r["kind"], r["surrogate"]) for r in given} & set(values)


# ---- pipeline

def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit(docs, toxicity.trained_part(labels))
    machine = model.automaton()
    left = {}
    for k, t in texts.items():
        weight, _, n = toxicity.weigh(machine, t)
        if model.score(toxicity.features(weight, n)) < 0.7:
            left[k] = t
    stays, border = brute_stays(list(left.items()))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {k for k, _ in brute_items([(k, left[k]) for k in stays | border if k in left], items)}
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert (rows.keys() ^ (stays - leaks)) <= border and rows
    from tokenizers import Tokenizer

    from merchlake.llm.queries import tokenizer_path

    library = Tokenizer.from_file(tokenizer_path())
    for k, r in rows.items():
        if not re.search(r"[0-9@]", texts[k]):  # no entity, hence the text is unchanged
            assert r["ids"] == library.encode(texts[k], add_special_tokens=False).ids


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", None)], docs.schema)
    both = docs.unionByName(extra).unionByName(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, both, "/root/testdata/sf0.001").columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "surrogates", "bpe"]
