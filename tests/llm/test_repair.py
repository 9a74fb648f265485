"""Repair of conversations: the search against all paths, the tables against one walk over each conversation."""

import hashlib
import itertools
import random
import re
import zlib


from merchlake.llm import queries, repair

ROWS = "conv_id long, turn long, role string, text string, path string, known string"


def cheapest(units, starts, finals, ended):
    """(cost, initials) of the best path by relaxing (cost, path) values until nothing changes."""
    n = len(units)
    best = {(0, s): (0, "") for s in starts}
    while True:
        changed = False
        for (i, state), (cost, path) in list(best.items()):
            ways = []
            if i < n:
                initial, fault = units[i]
                ways.append((i + 1, state, 3, "D"))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    ways += [(i + 1, repair.FOLLOWS[state][initial], more, "K")] if initial in repair.FOLLOWS[state] else []
                    ways.append((i + 1, repair.GIVEN[state], 2 + more, "R"))
            if i < n or ended:
                ways.append((i, repair.GIVEN[state], 2, "I"))
            for j, following, price, letter in ways:
                new = (cost + price, path + letter)
                if new < best.get((j, following), (10**9, "")):
                    best[j, following], changed = new, True
        if not changed:
            return min((best[n, s] for s in finals if (n, s) in best), default=None)


def random_units(rng, n):
    return [(rng.choice("suaaux"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(n)]


def test_search_equals_all_paths():
    rng = random.Random(3)
    for _ in range(1500):
        units = random_units(rng, rng.randrange(9))
        search = repair.Search([(a, f, 1) for a, f in units])
        assert search.best(repair.START, repair.ACCEPTING, True, {}) == cheapest(units, [0], repair.ACCEPTING, True), units


def test_search_from_state_to_state_and_joined_parts():
    rng = random.Random(4)
    for _ in range(300):
        units = random_units(rng, rng.randrange(2, 12))
        cuts = sorted(rng.sample(range(1, len(units)), min(len(units) - 1, 3)))
        pieces = [units[a:b] for a, b in zip([0, *cuts], [*cuts, len(units)], strict=True)]
        parts, all_paths = [], []
        for piece in pieces:
            costs, paths = repair.Search([(a, f, 1) for a, f in piece]).across()
            for s, e in itertools.product(range(4), range(4)):
                want = cheapest(piece, [s], [e], False)
                assert (costs[4 * s + e], paths[4 * s + e]) == (want or (None, None))
            empty = {"turns": None, "initials": ["u", "u"], "illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0}
            parts.append(empty | {"costs": costs, "ranks": repair._ranks(paths)})
            all_paths.append(paths)
        whole = parts[0]
        for part in parts[1:]:
            whole = repair.joined(whole, part)
        end = repair.last_state(whole)
        chosen = repair.choices(parts, repair.START, end)
        path = "".join(p[4 * s + e] for p, (s, e) in zip(all_paths, chosen, strict=True)) + repair.ending(end)
        assert (whole["costs"][end] + 2 * len(repair.ending(end)), path) == cheapest(units, [0], repair.ACCEPTING, True)


def test_long_runs_are_searched_in_bounded_time():
    assert repair.Search([("u", "", 1)] * 64).best(0, repair.ACCEPTING, True, {})[0] == 64
    assert repair.Search([("u", "duplicate", 10**6)]).best(0, repair.ACCEPTING, True, {}) == (3 * 10**6, "D" * 10**6)
    costs, _ = repair.Search([("x", "truncated", 1)] * 64).across()
    assert costs[0] == 64 * 3


def brute(rows):
    """Each conversation in one walk: rows are (conv_id, turn, role, text) before damage."""
    conversations = {}
    for conv, turn, role, text in rows:
        have = conversations.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        row = (turn, "user" if fault == 4 else role, text)
        have += {0: [], 3: [row, row]}.get(fault, [row])
    out = []
    for conv, have in conversations.items():
        have.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, units = set(), []
        for _, role, text in have:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            units.append((role[:1], fault))
        cost, path = cheapest(units, [0], repair.ACCEPTING, True)
        lines, state, i = [], 0, 0
        for letter in path:
            if letter == "D":
                i += 1
                continue
            state = repair.FOLLOWS[state][units[i][0]] if letter == "K" else repair.GIVEN[state]
            role = have[i][1] if letter == "K" else {2: "user", 3: "assistant"}[state]
            lines.append(f"{role}:{'' if letter == 'I' else have[i][2]}")
            i += letter != "I"
        turns = {t for t, _, _ in have if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(units))
        counts = [sum(f == k for _, f in units) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, path, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def made_rows():
    rng = random.Random(8)
    texts = ["Hello.", "Hello", " \t\n", "", None, "Why?", "So! ", "naïve 😀.", "a.b\x0b", "x" * 5000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts)))
    rows += [(1000, t, rng.choice(roles), f"{t % 97} {rng.choice(texts)}") for t in range(700)]  # several chunks
    rows += [(1001, None, rng.choice(roles), f"{t} {rng.choice(texts)}") for t in range(900)]  # one crowded turn
    rows += [(1002, 5, "user", "again.")] * 300
    return [(*r, "p", "k") for r in rows] + rows_again(rows)


def rows_again(rows):
    return [(*r, None, None) for r in rows[:40]]


def test_tables_equal_one_walk(spark, monkeypatch):
    monkeypatch.setattr(repair, "FAN", 3)
    rows = made_rows()
    frame = spark.createDataFrame(rows, ROWS)
    got = repair.repair_conversations(repair.damaged(frame))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute([r[:4] for r in rows])


def test_empty_table_and_conversation_without_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    assert repair.repair_conversations(repair.damaged(empty)).collect() == []
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 1, "user", "Hi.", None, None)], ROWS)
    got = [tuple(r) for r in repair.repair_conversations(repair.damaged(frame)).collect()]
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op13_conversation_repair"](spark, folder)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
