"""Conversation repair against an exhaustive search and a full interval parser."""

from __future__ import annotations

import hashlib
import heapq
import random

import pytest

from fieldpanel.llm import conversation_repair as cr
from fieldpanel.llm import turn_grammar as grammar
from fieldpanel.llm.query_repair import damaged, of_all

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, pos int, fault string"
SPACE = " \t\n\v\f\r"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)


def fault(role, text, seen):
    inside = text.strip(SPACE)
    if not inside:
        return "b"
    if (role, text) in seen:
        return "d"
    return "t" if inside[-1] not in ".!?" else "-"


def cheapest(codes):
    """(cost, audit) by best-first search over (row, position), insertions anywhere."""
    moves = {(p, i): q for p, i, q in grammar.MOVES}
    heap, done = [(0, "", 0, grammar.START)], set()
    while heap:
        cost, audit, row, at = heapq.heappop(heap)
        if row == len(codes) and at in grammar.ACCEPTED:
            return cost, audit
        if (row, at) in done:
            continue
        done.add((row, at))
        for role in "ua":
            if (at, role) in moves:
                heapq.heappush(heap, (cost + 3, audit + "I", row, moves[at, role]))
        if row == len(codes):
            continue
        initial, wrong = codes[row]
        heapq.heappush(heap, (cost + 4, audit + "D", row + 1, at))
        if wrong in "bd":
            continue
        more = 3 if wrong == "t" else 0
        if (at, initial) in moves:
            heapq.heappush(heap, (cost + more, audit + "K", row + 1, moves[at, initial]))
        for role in "ua":
            if (at, role) in moves:
                heapq.heappush(heap, (cost + more + 3, audit + "R", row + 1, moves[at, role]))


def intervals(codes):
    """The same by all intervals and all splits."""
    n = len(codes)
    cell = {(i, i + 1): grammar.row_cell(*codes[i]) for i in range(n)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            options = [grammar.combine(cell[i, k], cell[k, i + size]) for k in range(i + 1, i + size)]
            best = options[0]
            for other in options[1:]:
                best = tuple(map(grammar._least, best, other))
            assert all(o == best for o in options)  # every split gives the same cell
            cell[i, i + size] = best
    return grammar.answer(cell[0, n] if n else grammar.EMPTY)


def brute(rows):
    found = []
    for conv in {r[0] for r in rows}:
        mine = sorted(
            (t is not None, t or 0, " " if r is None else r,
             hashlib.sha256((" " if x is None else x).encode()).hexdigest(),
             " " if x is None else x)
            for c, t, r, x in rows if c == conv
        )
        seen, codes = set(), []
        for _, _, role, _, text in mine:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes.append((initial, fault(role, text, seen)))
            seen.add((role, text))
        cost, audit = cheapest(codes)
        out, last, at = [], "", 0
        for edit in audit:
            role, text = (mine[at][2], mine[at][4]) if edit != "I" else ("", "")
            at += edit != "I"
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            out.append(f"{role}:{text}")
        turns = [t for known, t, *_ in mine if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        wrong = [f for _, f in codes]
        pairs = [a + b for (a, _), (b, _) in zip(codes, codes[1:])]
        found.append((
            conv, gaps, *(wrong.count(f) for f in "bdt"),
            sum(p not in grammar.LEGAL for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Fine.", "No end", "", " \n", "Really?", "Yes! ", "Some more", "Ok.\t", None, "Ü!"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher"]
    return [
        (conv, rng.choice([None, *range(-2, 9)]), rng.choice(roles),
         rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}" + rng.choice(".!?x "))
        for conv in convs for _ in range(rng.randint(1, longest))
    ]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_cells_equal_both_searches(seed):
    rng = random.Random(seed)
    for _ in range(60):
        codes = [(rng.choice("suax"), rng.choice("bdt---")) for _ in range(rng.randint(0, 12))]
        joined = "".join(map("".join, codes))
        want = cheapest(codes)
        assert grammar.answer(grammar.span(joined)) == want
        assert intervals(codes) == want
        for cut in range(0, len(joined) + 1, 2):
            cells = [grammar.span(joined[:cut]), grammar.span(joined[cut:])]
            assert grammar.answer(grammar.join(cells)) == want


def test_cells_survive_writing():
    cell = grammar.span("u-a-xtudab")
    assert grammar.read(grammar.write(cell)) == cell


def test_repair_equals_brute_force(spark):
    rows = random_rows(4, [*range(60), None], 9)
    rows += rows[:5]
    found = cr.repair(table(spark, rows))
    assert result(found.summary()) == brute(rows)
    for conv, group in by_conv(found.rows().collect()).items():
        text = "\n".join(f"{r.role}:{r.text}" for r in group)
        want = next(b for b in brute(rows) if b[0] == conv)
        assert hashlib.sha256(text.encode()).hexdigest() == want[-1]
        assert [r.edit for r in group] == [e for e in want[-2] if e != "D"]


def by_conv(rows):
    found = {}
    for r in sorted(rows, key=lambda r: r.place):
        found.setdefault(r.conv, []).append(r)
    return found


def test_long_conversations_cross_blocks_and_tasks(spark):
    rng = random.Random(9)
    rows = [(1, n, rng.choice(["user", "assistant", "system"]), f"Text {n % 900}" + rng.choice(".x"))
            for n in range(3000)]
    rows += [(2, None, "user", "Same.")] * 1500 + [(3, 0, "user", "Hi. " * 100_000)]
    assert result(cr.repair(table(spark, rows)).summary()) == brute(rows)


def test_empty_table_and_wide_gaps(spark):
    assert cr.repair(table(spark, [(1, 1, "user", "x")]).limit(0)).summary().collect() == []
    rows = [(1, -(1 << 63), "user", "A."), (1, (1 << 63) - 1, "assistant", "B.")]
    row = cr.repair(table(spark, rows)).summary().collect()[0]
    assert row.gaps is None and row.audit == "KK"


def test_damage_and_conversations_without_rows(spark):
    rows = random_rows(5, [*range(200), None], 2)
    docs = table(spark, rows)
    found = of_all(docs.select("conv_id").distinct(), cr.repair(damaged(docs)).summary())
    left = [tuple(r) for r in damaged(docs).collect()]
    want = brute(left)
    gone = {r[0] for r in rows} - {r[0] for r in left}
    assert gone
    empty = hashlib.sha256(b"").hexdigest()
    want += [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone]
    assert result(found) == sorted(want, key=str)
