"""Repair of conversation structure by iterative-deepening A*.

A conversation should be nothing, or an optional system turn and then pairs of
user and assistant turns. The search walks the rows in order and edits them
(Delete, Insert, Keep, Rerole, tried in this order of their initials), depth
first under a cost bound that rises until a path is accepted. A table of failed
states keeps for each (row, state) what its rest is known to cost at least, which
serves as the heuristic of later visits and bounds.

A row's identity is its digest; equal rows are counted, not repeated. The rows
of a conversation are cut into chunks of at most a few hundred by turn (and,
where many rows share a turn, by role and digest). A chunk is searched from each
state to each state; the results of chunks are joined by groups in a tree, and the
choice comes back down. So a conversation may span many tasks; only its digest and
its edits, one value each by nature, are made in one task, row after row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from merchlake.functions.ordering import row_numbers
from merchlake.llm.common import Rows, rows_of
from merchlake.session import stored

BLANK = r"[\x20\x09-\x0D]"
SEEN = r"[^\x20\x09-\x0D]"
CHUNK_TURNS, CHUNK_ROWS, FAN = 64, 256, 64
GONE = ("blank", "duplicate")
LEGAL = ("su", "ua", "au")
NEWLINE = "\n"
RESULT = [
    *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    T.StructField("audit", T.StringType()),
    T.StructField("repaired_sha256", T.StringType()),
]

# Costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# States: nothing yet, after system, after user, after assistant. What may follow by initial, and the role that Rerole and Insert give.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
GIVEN = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
ACCEPTING = (START, ASSISTANT)
FAR = 1 << 60


@dataclass
class Search:
    """Searches over a list of units (initial, fault, rows); fault is "blank", "duplicate", "truncated" or "".

    Only blank or duplicate units stand for more than one row: all these have to go, and no insert between them
    can be part of an answer, as behind them it comes later in the order of the initials. `least` is the cost of
    the units from a place on that no edit avoids.
    """

    units: list[tuple[str, str, int]]
    least: list[int] = field(init=False)

    def __post_init__(self):
        self.least = [0] * (len(self.units) + 1)
        for i in range(len(self.units) - 1, -1, -1):
            _, fault, rows = self.units[i]
            self.least[i] = self.least[i + 1] + (DELETE * rows if fault in GONE else TRUNCATED if fault else 0)

    def edits(self, i: int, state: int, ended: bool) -> list[tuple[str, int, int, int]]:
        """(initials, cost, next unit, next state) in the order of the initials; `ended` allows inserts behind the last unit."""
        if i == len(self.units):
            return [("I", INSERT, i, GIVEN[state])] if ended else []
        initial, fault, rows = self.units[i]
        out = [("D" * rows, DELETE * rows, i + 1, state), ("I", INSERT, i, GIVEN[state])]
        if fault not in GONE:
            more = TRUNCATED if fault else 0
            if initial in FOLLOWS[state]:
                out.append(("K", more, i + 1, FOLLOWS[state][initial]))
            out.append(("R", REROLE + more, i + 1, GIVEN[state]))
        return out

    def best(self, start: int, goals: tuple[int, ...], ended: bool, failed: dict[tuple[int, int], int]) -> tuple[int, str]:
        """Cost and initials of the cheapest path from `start` to a goal, which has to exist; ties to the ASCII-least.

        `failed` may be shared by searches for the same goals.
        """
        end = len(self.units)

        def rest(i: int, state: int) -> int:
            known = self.least[i] if i < end or state in goals else INSERT if ended else FAR
            return max(known, failed.get((i, state), 0))

        if end == 0 and start in goals:
            return 0, ""
        bound = rest(0, start)
        while True:
            # Frames: unit, state, cost so far, edits still to try, least cost seen beyond the bound.
            stack, path = [[0, start, 0, iter(self.edits(0, start, ended)), FAR]], []
            while stack:
                frame = stack[-1]
                i, state, cost, todo, _ = frame
                step = next(todo, None)
                if step is None:
                    # Every way on costs more than the bound: what the rest is now known to cost.
                    stack.pop()
                    failed[i, state] = max(failed.get((i, state), 0), frame[4] - cost)
                    if stack:
                        path.pop()
                        stack[-1][4] = min(stack[-1][4], frame[4])
                    else:
                        bound = frame[4]
                    continue
                initials, price, j, following = step
                whole = cost + price + rest(j, following)
                if whole > bound:
                    frame[4] = min(frame[4], whole)
                    continue
                path.append(initials)
                if j == end and following in goals:
                    return cost + price, "".join(path)
                stack.append([j, following, cost + price, iter(self.edits(j, following, ended)), FAR])

    def across(self) -> tuple[list[int | None], list[str | None]]:
        """Costs and initials from each state to each state (place 4 x start + end) with no insert behind the last unit.

        All these paths end with an edit of the last unit, so none is the beginning of another, and the order of
        joined paths is that of their first parts that differ.
        """
        costs, paths = [None] * 16, [None] * 16
        has_system = any(initial == "s" and fault not in GONE for initial, fault, _ in self.units)
        for goal in range(4):
            failed: dict[tuple[int, int], int] = {}
            for start in range(4):
                if goal == START and start != START or goal == SYSTEM and (start > SYSTEM or start == START and not has_system):
                    continue
                costs[4 * start + goal], paths[4 * start + goal] = self.best(start, (goal,), False, failed)
        return costs, paths


def ending(state: int) -> str:
    """Inserts behind the last row that lead to an accepting state."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


# ---- what is known of a chunk, and of chunks in a row

def _illegal(before: str, after: str) -> int:
    return before + after not in LEGAL


def _ranks(keys: list) -> list[int | None]:
    """Order of the four paths from each state."""
    out: list[int | None] = [None] * 16
    for start in range(4):
        there = [at for at in range(4 * start, 4 * start + 4) if keys[at] is not None]
        for rank, at in enumerate(sorted(there, key=lambda at: keys[at])):
            out[at] = rank
    return out


def units_of(cells: list[dict]) -> list[tuple[str, str, int]]:
    """Cells (role, kind, n) as units: kind is blank, duplicate, or the fault of the first of n equal rows."""
    out = []
    for cell in cells:
        initial, kind, n = cell["role"][:1], cell["kind"], cell["n"]
        if kind in GONE:
            out.append((initial, kind, n))
        else:
            out.append((initial, kind, 1))
            if n > 1:
                out.append((initial, "duplicate", n - 1))
    return out


def summary(cells: list[dict], units: list[tuple[str, str, int]]) -> dict:
    """Counts of a chunk, with what is needed at its borders."""
    turns = sorted({c["turn"] for c in cells if c["turn"] is not None})
    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    illegal, before = 0, None
    for initial, fault, n in units:
        counts[fault] += n
        illegal += (n - 1) * _illegal(initial, initial) + (before is not None and _illegal(before, initial))
        before = initial
    return {
        "turns": [turns[0], turns[-1], len(turns)] if turns else None, "initials": [units[0][0], units[-1][0]],
        "illegal": illegal, **{k: v for k, v in counts.items() if k},
    }


def joined(a: dict, b: dict) -> dict:
    """The summary of two neighbouring parts of a conversation, with costs and ranks from state to state.

    Of the ways over different middle states the cheapest counts, then the ASCII-least; different middle states
    mean different first paths, so the first part's rank decides.
    """
    turns = a["turns"] or b["turns"]
    if a["turns"] and b["turns"]:
        turns = [a["turns"][0], b["turns"][1], a["turns"][2] + b["turns"][2] - (a["turns"][1] == b["turns"][0])]
    out = {"turns": turns, "initials": [a["initials"][0], b["initials"][1]],
           "illegal": a["illegal"] + b["illegal"] + _illegal(a["initials"][1], b["initials"][0])}
    out |= {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated")}
    costs, keys = [None] * 16, [None] * 16
    for at in range(16):
        via = middle(a, b, at // 4, at % 4)
        if via is not None:
            first, second = 4 * (at // 4) + via, 4 * via + at % 4
            costs[at] = a["costs"][first] + b["costs"][second]
            keys[at] = (a["ranks"][first], b["ranks"][second])
    return out | {"costs": costs, "ranks": _ranks(keys)}


def middle(a: dict, b: dict, start: int, end: int) -> int | None:
    """The state between two parts on the best way from `start` to `end`."""
    ways = [
        (a["costs"][4 * start + m] + b["costs"][4 * m + end], a["ranks"][4 * start + m], m)
        for m in range(4)
        if a["costs"][4 * start + m] is not None and b["costs"][4 * m + end] is not None
    ]
    return min(ways)[2] if ways else None


def last_state(whole: dict) -> int:
    """The state behind the last row on the best way from the start to an accepting state."""
    ways = [(whole["costs"][e] + INSERT * len(ending(e)), whole["ranks"][e], e) for e in range(4) if whole["costs"][e] is not None]
    return min(ways)[2]


def choices(parts: list[dict], start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of every part on the best way from `start` to `end`."""
    sums = list(accumulate(parts, joined))
    out = []
    for i in range(len(parts) - 1, 0, -1):
        via = middle(sums[i - 1], parts[i], start, end)
        out.append((via, end))
        end = via
    return [(start, end), *reversed(out)]


# ---- tables

def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: every row with the damage that its ids choose; dropped rows have 0 copies.

    By crc32 of "conversation:turn" (NULL as one space) modulo 20: 0 drops the row, 1 empties the text, 2 takes
    the signs `.!?` out, 3 doubles the row, 4 makes it the user's. Other rows stay as they are.
    """
    def shown(c: str) -> Column:
        return F.coalesce(rows[c].cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col)).cast("binary")) % 20
    text = shown(text_col)
    return rows.select(
        rows[conv_col].alias("conv_id"),
        rows[turn_col].alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(shown(role_col)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def _beside(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    return left.join(other, _same(left, other, keys), how).drop(*[f"_{k}" for k in keys])


def _mapped(df: DataFrame, run, fields: list[tuple[str, str]]) -> DataFrame:
    """mapInArrow of `run`(row) -> rows, each a tuple of the named fields."""
    ddl = T.StructType([T.StructField(n, df.schema[n].dataType if t == "=" else T.DataType.fromDDL(t)) for n, t in fields])
    schema = to_arrow_schema(ddl)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for part in parts:
            names = part.schema.names
            for row in rows_of(part):
                for made in run(dict(zip(names, row, strict=True))):
                    yield from out.add(made, 512)
        yield from out.flush()

    return df.mapInArrow(batches, ddl)


def chunks_of(rows: DataFrame) -> DataFrame:
    """conv_id, block, sub (turn, role, part), cells: the rows of a conversation in pieces of bounded size, in order.

    A block holds 64 turns; where it has more than CHUNK_ROWS different rows, they are parted by turn, role and the
    beginning of the digest. A cell stands for the n equal rows of a turn.
    """
    cells = (
        rows.where("copies > 0")
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.sum("copies").alias("n"), F.max(~F.col("text").rlike(SEEN)).alias("blank"),
             F.max(~F.col("text").rlike(rf"[.!?]{BLANK}*\z")).alias("cut"))
        .withColumn("block", F.floor(F.col("turn") / CHUNK_TURNS))
    )
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    again = cells.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("c"))
    cells = _beside(cells, again.where("c > 1").drop("c"), ["conv_id", "role", "digest"])
    crowded = cells.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("crowd")).where(F.col("crowd") > CHUNK_ROWS)
    cells = _beside(cells, crowded, ["conv_id", "block"])
    part = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.ceil(F.col("crowd") / (CHUNK_ROWS // 2))
    kind = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(turn), "duplicate")
        .when(F.col("cut"), "truncated").otherwise("")
    )
    split = F.col("crowd").isNotNull()
    return cells.groupBy(
        "conv_id", "block",
        F.when(split, F.col("turn")).alias("sub_turn"),
        F.when(split, F.col("role")).alias("sub_role"),
        F.when(split, F.shiftright(part, 32)).alias("sub_part"),
    ).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "n", kind.alias("kind")))).alias("cells"))


CHUNK_ORDER = ["block", "sub_turn", "sub_role", "sub_part"]


def _search(row: dict) -> Iterator[tuple]:
    cells = row["cells"]
    units = units_of(cells)
    known, search = summary(cells, units), Search(units)
    if row["n_chunks"] is None:  # the only chunk of its conversation
        known["cost"], path = search.best(START, ACCEPTING, True, {})
        paths = [path]
    else:
        known["costs"], paths = search.across()
        known["ranks"] = _ranks(paths)
    head = cells[0]
    yield (row["conv_id"], *[row[c] for c in CHUNK_ORDER], head["turn"], head["role"], head["digest"], json.dumps(known), paths)


def _join_group(row: dict) -> Iterator[tuple]:
    parts = [json.loads(p["known"]) for p in row["parts"]]
    yield row["conv_id"], row["parent"], json.dumps(reduce(joined, parts))


def _choose_group(row: dict) -> Iterator[tuple]:
    parts = [json.loads(p["known"]) for p in row["parts"]]
    for part, (start, end) in zip(row["parts"], choices(parts, row["start"], row["end"]), strict=True):
        yield row["conv_id"], part["no"], start, end


def _choose_top(row: dict) -> Iterator[tuple]:
    known = json.loads(row["known"])
    end = last_state(known)
    known["cost"] = known["costs"][end] + INSERT * len(ending(end))
    yield row["conv_id"], row["no"], START, end, json.dumps(known)


def _long_conversations(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths and facts of the conversations of several chunks, joined and chosen in a tree of groups of FAN."""
    numbered = row_numbers(leaves, ["conv_id"], CHUNK_ORDER, name="no", total="n_chunks")
    level = numbered.select("conv_id", F.col("no").cast("long").alias("no"), "known")
    groups = []
    while (level.agg(F.max("no")).first()[0] or 1) > 1:
        grouped = stored(
            level.groupBy("conv_id", (F.floor((F.col("no") - 1) / FAN) + 1).cast("long").alias("parent"))
            .agg(F.sort_array(F.collect_list(F.struct("no", "known"))).alias("parts"))
        )
        groups.append(grouped)
        level = stored(_mapped(grouped, _join_group, [("conv_id", "="), ("no", "long"), ("known", "string")]))
    tops = stored(_mapped(level, _choose_top, [("conv_id", "="), ("no", "long"), ("start", "int"), ("end", "int"), ("known", "string")]))
    chosen = tops.drop("known")
    for grouped in reversed(groups):
        above = chosen.withColumnRenamed("no", "parent")
        chosen = _mapped(_beside(grouped, above, ["conv_id", "parent"], "inner"), _choose_group,
                         [("conv_id", "="), ("no", "long"), ("start", "int"), ("end", "int")])
    path = F.get("paths", F.col("start") * 4 + F.col("end"))
    tail = F.when(F.col("no") == F.col("n_chunks"), F.element_at(F.array(*[F.lit(ending(s)) for s in range(4)]), F.col("end") + 1))
    found = _beside(numbered.withColumn("no", F.col("no").cast("long")), chosen, ["conv_id", "no"], "inner")
    paths = found.select("conv_id", "turn", "role", "digest", F.concat(path, F.coalesce(tail, F.lit(""))).alias("path"))
    return paths, tops.select("conv_id", "known")


class Repaired:
    """Goes through the rows of a conversation in order and hashes what the edits make of them."""

    def __init__(self):
        self.digest, self.pieces, self.state, self.empty, self.known = hashlib.sha256(), [], START, True, None
        self.piece, self.at = "", 0

    def path(self, initials: str) -> None:
        self.inserts()
        self.pieces.append(initials)
        self.piece, self.at = initials, 0

    def add(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else NEWLINE}{role}:{text}".encode())
        self.empty = False

    def inserts(self) -> None:
        while self.at < len(self.piece) and self.piece[self.at] == "I":
            self.state = GIVEN[self.state]
            self.add(ROLE_OF[self.state], "")
            self.at += 1

    def rows(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserts()
            edit = self.piece[self.at]
            self.at += 1
            if edit == "K":
                self.state = FOLLOWS[self.state][role[:1]]
                self.add(role, text)
            elif edit == "R":
                self.state = GIVEN[self.state]
                self.add(ROLE_OF[self.state], text)

    def result(self) -> tuple:
        self.inserts()
        known = json.loads(self.known) if self.known else {}
        first, last, different = known.get("turns") or (0, -1, 0)
        counts = [known.get(k, 0) for k in ("blank", "duplicate", "truncated", "illegal", "cost")]
        return (last - first + 1 - different, *counts, "".join(self.pieces), self.digest.hexdigest())


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` has conv_id, turn, role, text and copies (how often the row stands there, 0 for a row that is gone but whose
    conversation counts). Rows are taken by turn, NULL first; rows of one turn by role and digest of the text. NULL
    roles and texts count as one space, NULL conv_ids form one conversation. A row's first fault counts: blank,
    duplicate (role and text seen earlier), truncated. audit holds the initials of the cheapest edits, ties to the
    ASCII-least; repaired_sha256 is of the repaired `role:text` lines. A conversation without rows has zeros, an empty
    audit and the hash of the empty text; an empty table gives an empty result. Columns beyond those named are not read.

    Texts cross the network once, to be hashed in order; SHA-256 and the audit of one conversation are made by one task,
    which holds its audit but only one row at a time.
    """
    base = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.col("copies").cast("long").alias("copies"),
    ).withColumn("digest", F.substring(F.sha2("text", 256), 1, 32))
    chunks = stored(chunks_of(base))
    several = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_chunks")).where("n_chunks > 1")
    keys = [("conv_id", "="), *[(c, "=") for c in CHUNK_ORDER], ("turn", "long"), ("role", "string"), ("digest", "string")]
    leaves = stored(_mapped(_beside(chunks, several, ["conv_id"]), _search,
                          [*keys, ("known", "string"), ("paths", "array<string>")]))
    alone = leaves.where(F.size("paths") == 1)
    paths = alone.select("conv_id", "turn", "role", "digest", F.get("paths", F.lit(0)).alias("path"), "known")
    long_paths, long_known = _long_conversations(leaves.where(F.size("paths") > 1))
    events = (
        base.select("conv_id", F.lit(2).alias("kind"), "turn", "role", "digest", F.when(F.col("copies") > 0, F.col("text")).alias("text"), "copies")
        .unionByName(paths.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(long_paths.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(long_known.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    )
    ordered = events.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "kind")
    ddl = T.StructType([T.StructField("conv_id", base.schema["conv_id"].dataType), *RESULT])
    schema = to_arrow_schema(ddl)

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, current = Rows(schema), None, None
        for part in parts:
            for conv, kind, _, role, _, text, copies, path, known in rows_of(part):
                if current is None or conv != key:
                    if current is not None:
                        yield from out.add((key, *current.result()), 256)
                    key, current = conv, Repaired()
                current.known = known or current.known
                if kind == 1:
                    current.path(path)
                elif kind == 2 and copies:
                    current.rows(role, text, copies)
        if current is not None:
            yield from out.add((key, *current.result()), 256)
        yield from out.flush()

    return ordered.select("conv_id", "kind", "turn", "role", "digest", "text", "copies", "path", "known").mapInArrow(hashed, ddl)
