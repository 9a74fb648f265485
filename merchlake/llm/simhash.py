"""Near copies by SimHash fingerprints, found with BK-trees.

A BK-tree holds fingerprints; every child hangs on its parent by an edge that
carries their Hamming distance, a whole number. A search for all fingerprints
within a radius follows only edges whose distance lies within the radius around
the distance of the query to the parent.

The fingerprints are dealt into shards such that whatever belongs together
meets in one shard at least. Each shard is a tree; a shard beyond TREE_SIZE is
cut into several trees, and each of them is sent to all parts of the shard. A
task links what it finds to one representative, so that no group is written out
as pairs; the links become components in a separate step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Rows, kept, rows_of
from merchlake.llm.graph import components

BITS = 64
TREE_SIZE = 1024
# Bytes of shingle sets that a tree holds at most (a longer set has a tree to itself, or nearly so).
TREE_BYTES = 8 * 1024 * 1024
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

# Sketch of a shingle set: least values under SKETCH different orders, and how many of them make a shard key.
SKETCH, BANDS, BAND_ROWS = 128, 10, 2
# How far the share of equal places may lie below the similarity for a pair to be compared.
LOOSE = 0.2
_rng = np.random.default_rng(20240229)
_ORDERS = _rng.integers(0, 2**63, size=SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of `words` words, repeats included; empty if the text has no word."""
    tokens = _WORD.findall((text or "").encode("utf-8").lower())
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    runs = zip(starts, ends[words - 1 :], strict=False)
    return np.fromiter((digest(joined[a : b - 1], 42) for a, b in runs), np.uint64, len(tokens) - words + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes; no hashes give 0."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[at : at + 8192], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The least value of the set under each order (all ones for an empty set)."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[at : at + 2048, None] * _ORDERS[None, :]).min(0), out=least)
    return least


class BKTree:
    """A BK-tree over an array of fingerprints, its edges sorted by parent and distance.

    The first fingerprint of a set is its root; the others are grouped by their
    distance to it, and each group is a tree of its own below that edge.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        parents, distances, children = [], [], []
        open_sets = [np.arange(len(prints))] if len(prints) else []
        while open_sets:
            members = open_sets.pop()
            root, rest = members[0], members[1:]
            if not len(rest):
                continue
            far = np.bitwise_count(prints[rest] ^ prints[root])
            order = np.argsort(far, kind="stable")
            rest, far = rest[order], far[order]
            cuts = np.nonzero(np.diff(far))[0] + 1
            for group in np.split(np.arange(len(rest)), cuts):
                parents.append(root)
                distances.append(far[group[0]])
                children.append(rest[group[0]])
                open_sets.append(rest[group])
        parent = np.array(parents, np.int64)
        order = np.lexsort((np.array(distances, np.int64), parent))
        self.distance = np.array(distances, np.int64)[order]
        self.child = np.array(children, np.int64)[order]
        self.first = np.searchsorted(parent[order], np.arange(len(prints) + 1))
        # Parent and distance in one number: the edges of a parent within the radius are one slice.
        self.key = parent[order] * (BITS + 1) + self.distance

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, tree position) of all pairs within the radius, walked level by level for all queries."""
        found_q, found_n = [], []
        q = np.arange(len(queries))
        n = np.zeros(len(queries), np.int64)
        if not len(self.prints):
            q = q[:0]
        while len(q):
            far = np.bitwise_count(queries[q] ^ self.prints[n]).astype(np.int64)
            hit = far <= radius
            found_q.append(q[hit])
            found_n.append(n[hit])
            base = n * (BITS + 1)
            lo = np.searchsorted(self.key, base + np.maximum(far - radius, 0))
            hi = np.searchsorted(self.key, base + np.minimum(far + radius, BITS), side="right")
            width = hi - lo
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
            q, n = np.repeat(q, width), self.child[at]
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_n)


def _joined_labels(size: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Least position in the same component, for positions linked by (u, v)."""
    label = np.arange(size) if label is None else label
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        label = label[label]
        if (label == before).all():
            differs = label[u] != label[v]
            if not differs.any():
                break
            u, v = u[differs], v[differs]
    return label


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets, of which one at least is not empty."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def _checked_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray, sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Labels joined by the pairs (u, v) whose sets are that similar; pairs that are joined already are not compared."""
    while len(u):
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
        near = np.array([_jaccard(sets[a], sets[b]) >= similarity for a, b in zip(u[:256], v[:256], strict=True)], bool)
        label = _joined_labels(len(label), u[:256][near], v[:256][near], label)
        u, v = u[256:], v[256:]
    return label


def _search(radius: int, agreement: float | None, similarity: float | None = None):
    """Searches one part of a shard in one tree of it and links what is near: (u, v) pairs of node ids.

    With `similarity`, members bring their shingle sets, and what the sketches let pass is compared by these.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def table(members: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, list[np.ndarray]]:
        nodes, prints = (members.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        order = np.argsort(nodes, kind="stable")
        marks, sets = None, []
        if agreement is not None:
            marks = np.frombuffer(b"".join(members.field(2).to_pylist()), np.uint8).reshape(-1, SKETCH)[order]
        if similarity is not None:
            packed = members.field(3)
            sets = [np.frombuffer(packed[int(i)].as_buffer(), "<u8") for i in order]
        return nodes[order], prints[order].view(np.uint64), marks, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                tree_part, query_part = (batch.column(k)[i].values for k in (0, 1))
                t_nodes, t_prints, t_marks, t_sets = own = table(tree_part)
                q_nodes, q_prints, q_marks, q_sets = own if query_part is None else table(query_part)
                nodes = np.concatenate((t_nodes, q_nodes))
                shift = 0 if query_part is None else len(t_nodes)
                tree, label = BKTree(t_prints), np.arange(len(nodes))
                for at in range(0, len(q_nodes), 256):
                    q, n = tree.within(q_prints[at : at + 256], radius)
                    q = q + at
                    other = q_nodes[q] != t_nodes[n]
                    q, n = q[other], n[other]
                    if agreement is not None and len(q):
                        share = np.concatenate([
                            (q_marks[q[k : k + 16384]] == t_marks[n[k : k + 16384]]).mean(1)
                            for k in range(0, len(q), 16384)
                        ])
                        near = share >= agreement
                        if similarity is not None:
                            # Every pair of a tree is met in both directions; the likeliest are compared first.
                            near &= (q < n) | (query_part is not None)
                            order = np.argsort(-share[near], kind="stable")
                            u, v = (q[near] + shift)[order], n[near][order]
                            label = _checked_labels(label, u, v, t_sets + q_sets if shift else t_sets, similarity)
                            continue
                        q, n = q[near], n[near]
                    label = _joined_labels(len(nodes), q + shift, n, label)
                for k in np.nonzero(label != np.arange(len(nodes)))[0]:
                    yield from out.add((int(nodes[k]), int(nodes[label[k]])), 16)
        yield from out.flush()

    return run


def _links(
    members: DataFrame, keys: list[str], payload: list[str], radius: int, agreement: float | None, similarity: float | None = None
) -> DataFrame:
    """Links (u, v) between nodes that are near and share a shard (`keys`).

    payload starts with node and print; the sketch and, if there is a
    `similarity`, the shingle set follow.
    """
    held = F.lit(0) if similarity is None else F.sum(F.length(payload[3]))
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), held.alias("_bytes")).where("_n > 1")
    sizes = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], "_n", "_bytes")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    trees = F.ceil(F.greatest(F.col("_n") / TREE_SIZE, F.col("_bytes") / TREE_BYTES))
    dealt = members.join(sizes, same).withColumn("_trees", trees)
    part = F.pmod(F.xxhash64(F.col(payload[0]), F.lit(1)), F.col("_trees")).alias("_part")
    kind = f"array<{members.select(F.struct(*payload).alias('x')).schema['x'].dataType.simpleString()}>"
    parts = kept(
        dealt.groupBy(*keys, "_trees", part).agg(F.collect_list(F.struct(*payload)).alias("members"))
    )
    alone = parts.where("_trees = 1").select("members", F.lit(None).cast(kind).alias("queries"))
    cut = parts.where("_trees > 1")
    inner = cut.select("members", F.lit(None).cast(kind).alias("queries"))
    # Each tree of a large shard is sent to the shard's other parts, every two parts once.
    others = cut.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("_other"), F.col("members").alias("queries"))
    outer = cut.join(others, [*same, F.col("_part") < F.col("_other")]).select("members", "queries")
    spread = inner.unionByName(outer)
    spread = spread.repartition(F.xxhash64("members"), F.xxhash64("queries"))
    run = _search(radius, agreement, similarity)
    return alone.mapInArrow(run, "u long, v long").unionByName(spread.mapInArrow(run, "u long, v long")).distinct()


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, print (the 64 bits as a long)."""
    schema = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for key, text in rows_of(batch):
                bits = fingerprint(shingle_hashes(text, words))
                yield from out.add((key, bits - (1 << 64) if bits >> 63 else bits), 16)
        yield from out.flush()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, print long")


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def masks(radius: int, agree: int) -> list[int]:
    """Bit masks of every choice of `agree` among radius + agree blocks of bits.

    Two fingerprints that differ in at most `radius` bits differ in at most as
    many blocks, so at least `agree` blocks are equal, whichever these are.
    """
    blocks = radius + agree
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) for c in combinations(single, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def fingerprint_groups(prints: DataFrame, radius: int = 4, agree: int = 2) -> DataFrame:
    """(node, root) of all fingerprints of `prints` (column print) that are linked to another one.

    Two fingerprints are linked if they differ in at most `radius` bits. No link
    is lost. A fingerprint meets others that agree with it in `agree` blocks of
    bits; a higher value makes smaller shards and more copies of a fingerprint
    (4 bits: 15 copies for 2, 35 for 3).
    """
    distinct = prints.select("print").distinct()
    choices = [F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(F.lit(m)).alias("value"))
               for i, m in enumerate(masks(radius, agree))]
    members = distinct.select("print", F.explode(F.array(*choices)).alias("s")).select(
        F.col("print").alias("node"), "print", "s.choice", "s.value"
    )
    return components(_links(members, ["choice", "value"], ["node", "print"], radius, None))


def near_copies(
    docs: DataFrame, words: int = 4, radius: int = 4, agree: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the least doc_id that can be reached over links of at most
    `radius` differing bits, the row's own included. Texts without words (NULL,
    empty, blanks) have fingerprint 0 and are linked like any other. Repeated
    rows are kept, each in the same component; NULL ids are kept and never
    become a component id unless the component has no other. An empty table
    gives an empty result. Texts are read whole; other columns are not read.
    """
    prints = kept(fingerprints(docs, words, id_col, text_col))
    groups = fingerprint_groups(prints, radius, agree)
    least = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    rooted = least.join(groups, F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    rooted = kept(rooted)
    names = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component_id"))
    named = rooted.join(names, F.col("root") == F.col("_root")).select(F.col("print").alias("_print"), "component_id")
    return prints.join(named, F.col("print") == F.col("_print")).select(
        "doc_id", as_hex(F.col("print")).alias("fingerprint"), "component_id"
    )


def _described(words: int):
    """Per text: its node (hash of its set of runs), the set's fingerprint, sketch and shard keys."""
    schema = pa.schema([("row", pa.int64()), ("node", pa.int64()), ("print", pa.int64()), ("marks", pa.binary()), ("keys", pa.list_(pa.int64()))])
    mix = np.uint64(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for row, text in rows_of(batch):
                # A set, as the similarity is one of sets: how often a run is repeated must not move a bit.
                hashes = np.unique(shingle_hashes(text, words))
                node = xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), 7)
                least = sketch(hashes)
                marks = ((least * mix) >> np.uint64(56)).astype(np.uint8).tobytes()
                bands = least[: BANDS * BAND_ROWS].astype("<u8").reshape(BANDS, BAND_ROWS)
                keys = np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], np.uint64).view(np.int64)
                both = np.array([node, fingerprint(hashes)], np.uint64).view(np.int64)
                yield from out.add((row, int(both[0]), int(both[1]), marks, keys), 512)
        yield from out.flush()

    return run


def _shingle_sets(words: int):
    """The sorted set of a text's shingle hashes, eight bytes each, beside the node of its words."""
    schema = pa.schema([("node", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for node, text in rows_of(batch):
                grams = np.unique(shingle_hashes(text, words)).astype("<u8").tobytes()
                yield from out.add((node, grams), len(grams) + 16)
        yield from out.flush()

    return run


def without_near_copies(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 28, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` without near copies: of each group the row with the least id stays, with all its columns.

    Two texts are near if their sets of `words`-word runs have a Jaccard
    similarity of `similarity` or more, groups are connected components. Every
    link is such a pair, compared exactly. Which pairs are compared is settled
    first: the shards are made of least-value keys, which texts so similar share
    with a probability of 0.99996 (at 0.8); a shard's trees are searched with a
    radius that wide (the fingerprints of two sets at 0.8 differ in 9.7 bits on
    average and in more than 28 with a probability of 10^-8; sets of 4 and 5 runs
    in 12 bits, 10^-6), and sketches
    have to agree in all but LOOSE of the places that `similarity` stands for
    (0.6 of 128 for 0.8; missed by 8 in 10^8 at 0.8). The components of that are
    searched again, now with the shingle sets. Texts without words are copies of
    each other; NULL ids come last in a group; of rows equal in all columns one
    stays. Columns are carried under names of our own, so theirs may be any.
    """
    names = docs.columns
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])
    values = [F.col(c).cast("binary") if t == "string" else F.col(c).cast("string") for c, t in docs.dtypes]
    tagged = docs.withColumn("_row", F.xxhash64(*[x for v in values for x in (v.isNull(), v)]))
    described = kept(tagged.select("_row", text_col).mapInArrow(
        _described(words), "row long, node long, print long, marks binary, keys array<long>"))
    texts = described.groupBy("node").agg(
        F.first("print").alias("print"), F.first("marks").alias("marks"), F.first("keys").alias("keys"), F.min("row").alias("owner"))
    members = texts.select("node", "print", "marks", F.posexplode("keys").alias("band", "value"))
    loose = components(_links(members, ["band", "value"], ["node", "print", "marks"], radius, similarity - LOOSE))
    # Only texts that may have a partner are read again, each once for all rows with these words.
    wanted = kept(texts.join(loose.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node")).select(
        "node", "root", "print", "marks", "owner"))
    again = tagged.select("_row", F.col(text_col).alias("_text")).join(wanted.select("node", "owner"), F.col("_row") == F.col("owner"))
    sets = again.select("node", "_text").mapInArrow(_shingle_sets(words), "node long, grams binary")
    sets = sets.groupBy(F.col("node").alias("_node")).agg(F.first("grams").alias("grams"))
    compared = kept(wanted.join(sets, F.col("node") == F.col("_node")).select("node", "root", "print", "marks", "grams"))
    groups = components(_links(compared, ["root"], ["node", "print", "marks", "grams"], radius, similarity - LOOSE, similarity))
    rows = tagged.select(F.col("_row"), F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id")).alias("order"))
    placed = described.select("row", "node").distinct().join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    placed = placed.select("row", F.coalesce("root", "node").alias("root"))
    least = (
        rows.join(placed, F.col("_row") == F.col("row"))
        .groupBy("root")
        .agg(F.min_by("row", F.struct("order.none", "order.id", "row")).alias("_keep"))
    )
    stays = least.select("_keep").distinct()
    return tagged.join(stays, F.col("_row") == F.col("_keep"), "left_semi").dropDuplicates(["_row"]).drop("_row").toDF(*names)
