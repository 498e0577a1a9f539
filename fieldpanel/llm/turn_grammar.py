"""Weighted interval parsing of a conversation's roles, in Chomsky normal form.

The role initials of a repaired conversation form ``(s?(ua)+)?``. With the positions START,
SYSTEM, USER and ASSISTANT (what came last), a nonterminal [p, q] derives the edits of a span
of rows that lead from position p to position q, and the grammar is

    [p, q] -> [p, r] [r, q]                       for every r, at every split of a span
    [p, q] -> K | R | D                           for a span of one row
    [p, q] -> I | I I                             for an empty span

A cell holds, for every nonterminal, the least (cost, audit) over all derivations of its span;
the audit is the string of edits. Inserted rows are brought in by closing every cell of one
row under the empty span's rules on its right, and the whole once on its left. Longer spans
come from shorter ones, bottom-up by length. The binary rule exists for every r at every split,
so all splits of a span derive the same edits and one balanced split per span finds the least;
cells then combine in any grouping, which lets spans of one conversation be parsed apart.

Least audits combine as well as least costs do: of two audits of equal cost for one span and
nonterminal none begins with the other, as what follows could only be costly insertions.
"""

from __future__ import annotations

from functools import lru_cache, reduce

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # CUT: an undeleted truncated row
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
# (from, role initial, to)
MOVES = (
    (START, "s", SYSTEM), (START, "u", USER), (SYSTEM, "u", USER),
    (USER, "a", ASSISTANT), (ASSISTANT, "u", USER),
)
LEGAL = {"su", "ua", "au"}

Entry = tuple[int, str]
Cell = tuple[Entry | None, ...]  # one entry per pair of positions, row by row


def _least(one: Entry | None, two: Entry | None) -> Entry | None:
    if one is None or two is None:
        return one or two
    return min(one, two)


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: the binary rule for every r."""
    cell: list[Entry | None] = []
    for p in range(4):
        for q in range(4):
            best = None
            for r in range(4):
                one, two = left[4 * p + r], right[4 * r + q]
                if one is not None and two is not None:
                    best = _least(best, (one[0] + two[0], one[1] + two[1]))
            cell.append(best)
    return tuple(cell)


def _cell(entries: list[tuple[int, int, Entry]]) -> Cell:
    found: dict[tuple[int, int], Entry] = {}
    for p, q, entry in entries:
        found[p, q] = min(found.get((p, q), entry), entry)
    return tuple(found.get((p, q)) for p in range(4) for q in range(4))


def _empty() -> Cell:
    """The cell of the empty span: no more than two insertions lead from p to q."""
    nothing = _cell([(p, p, (0, "")) for p in range(4)])
    once = _cell([(p, q, (INSERT, "I")) for p, i, q in MOVES if i in "ua"])
    return tuple(map(_least, map(_least, nothing, once), combine(once, once)))


EMPTY = _empty()


@lru_cache(maxsize=64)
def row_cell(initial: str, fault: str) -> Cell:
    """One row by its role initial and its fault (b, d, t or -), closed under insertions."""
    edits: list[tuple[int, int, Entry]] = [(p, p, (DELETE, "D")) for p in range(4)]
    if fault not in "bd":
        more = CUT if fault == "t" else 0
        edits += [(p, q, (KEEP + more, "K")) for p, i, q in MOVES if i == initial]
        edits += [(p, q, (REROLE + more, "R")) for p, i, q in MOVES if i in "ua"]
    return combine(_cell(edits), EMPTY)


@lru_cache(maxsize=1 << 15)
def _span(codes: str) -> Cell:
    """The cell of a span; ``codes`` has two characters a row, its initial and its fault."""
    if len(codes) <= 2:
        return row_cell(*codes) if codes else EMPTY
    half = len(codes) // 4 * 2
    return combine(span(codes[:half]), span(codes[half:]))


def span(codes: str) -> Cell:
    """The cell of a span; those of short spans are remembered, which only saves time."""
    return _span(codes) if len(codes) <= 64 else _span.__wrapped__(codes)


def join(cells: list[Cell]) -> Cell:
    """Neighbouring cells pairwise, until one is left."""
    while len(cells) > 1:
        cells = [reduce(combine, cells[i : i + 2]) for i in range(0, len(cells), 2)]
    return cells[0]


def answer(cell: Cell) -> Entry:
    """(cost, audit) of the cheapest repair of the whole."""
    whole = combine(EMPTY, cell)
    return min(e for q in ACCEPTED if (e := whole[4 * START + q]) is not None)


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def write(cell: Cell) -> str:
    return ";".join("" if e is None else f"{e[0]}{e[1]}" for e in cell)


def read(text: str) -> Cell:
    def entry(part: str) -> Entry | None:
        audit = part.lstrip("0123456789")
        return (int(part[: len(part) - len(audit)]), audit) if part else None

    return tuple(map(entry, text.split(";")))
