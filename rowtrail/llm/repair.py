"""Repair of a conversation's structure as a lightest derivation, found with an agenda.

Items are deduced from items. ``row i`` is an axiom of weight (0, ""). ``at i, q`` says that the first i rows are edited and the roles
kept so far leave the automaton of ``(s?(ua)+)?`` in state q. An edit deduces ``at i+1, q'`` from ``at i, q`` and ``row i``; an insertion deduces
``at i, q'`` from ``at i, q``. Each deduction is a function of its antecedents' weights that adds a cost and appends an initial to the
audit. It is superior in the order (cost, audit): no conclusion is lighter than an antecedent, since the audit grows at its end and an axiom
weighs nothing. It is monotone too: two audits of one item with the same cost are never prefixes of one another, because only insertions take no row, and they cost. So
an item is final when the agenda pops it, and the search ends when its goals are.

A long conversation is cut into segments. The weights from each state to each state over a segment are found by the same search, wherever the
segment lies, and compose along the conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import NamedTuple

Weight = tuple[int, str]
#: Fixed: costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States by what has been kept: nothing, a system row, a user row, an assistant row; and where each initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FINAL = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
SPACES = " \t\n\x0b\x0c\r"
GOAL = ("goal", 0, 0)


def lightest(axioms: Iterable[tuple[Weight, Hashable]], deduce: Callable[[Hashable, dict], Iterator[tuple[Weight, Hashable]]], goals: Iterable[Hashable]) -> dict[Hashable, Weight]:
    """Weights of the items that are final once all goals are, or once nothing is left on the agenda.

    ``deduce`` gives the conclusions, with their weights, that an item just made final allows together with others that are.
    """
    agenda = [(cost, audit, item) for (cost, audit), item in axioms]
    heapq.heapify(agenda)
    final: dict[Hashable, Weight] = {}
    missing = set(goals)
    while agenda and missing:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        missing.discard(item)
        for (total, said), conclusion in deduce(item, final):
            if conclusion not in final:
                heapq.heappush(agenda, (total, said, conclusion))
    return final


class Row(NamedTuple):
    role: str
    text: str
    fault: str | None


def fault_of(text: str, repeated: bool) -> str | None:
    """A row's first fault."""
    last = text.rstrip(SPACES)[-1:]
    return BLANK if not last else DUPLICATE if repeated else None if last in ".!?" else CUT


def edits(row: Row, state: int) -> Iterator[tuple[Weight, int]]:
    """What may be done with a row in a state, and where it leads."""
    yield (DELETE, "D"), state
    if row.fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED if row.fault == CUT else 0
    for initial, then in NEXT[state].items():
        if row.role[:1] == initial:
            yield (extra, "K"), then
        if then in ROLES:
            yield (REROLE + extra, "R"), then


def _deductions(rows: list[Row], closing: Iterable[int]) -> Callable[[Hashable, dict], Iterator[tuple[Weight, Hashable]]]:
    """The deductions over a list of rows; the goal item follows from those states after the last row that ``closing`` names."""
    def deduce(item: tuple[str, int, int], final: dict) -> Iterator[tuple[Weight, Hashable]]:
        kind, i, state = item
        if kind == "goal":
            return
        if i < len(rows) and ("row", i, 0) in final:
            for left in (state,) if kind == "at" else STATES:
                if ("at", i, left) in final:
                    cost, audit = final["at", i, left]
                    for (more, letter), then in edits(rows[i], left):
                        yield (cost + more, audit + letter), ("at", i + 1, then)
        if kind == "at":
            cost, audit = final[item]
            for then in NEXT[state].values():
                if then in ROLES:
                    yield (cost + INSERT, audit + "I"), ("at", i, then)
            if i == len(rows) and state in closing:
                yield (cost, audit), GOAL

    return deduce


def _axioms(rows: list[Row], state: int) -> list[tuple[Weight, Hashable]]:
    return [((0, ""), ("row", i, 0)) for i in range(len(rows))] + [((0, ""), ("at", 0, state))]


def lightest_repair(rows: list[Row]) -> Weight:
    """Cost and audit of a whole conversation's cheapest repair."""
    return lightest(_axioms(rows, START), _deductions(rows, FINAL), [GOAL])[GOAL]


def lightest_from(rows: list[Row], state: int) -> dict[int, Weight]:
    """Lightest weights over a segment from a state to each state that can be reached."""
    final = lightest(_axioms(rows, state), _deductions(rows, ()), [("at", len(rows), then) for then in STATES])
    return {then: final["at", len(rows), then] for then in STATES if ("at", len(rows), then) in final}


def repaired(rows: list[Row], state: int, audit: str) -> Iterator[str]:
    """The rows an audit leaves, as ``role:text``; a state and an initial say which role is meant."""
    i = 0
    for letter in audit:
        if letter == "I":
            state = USER if state != USER else ASSISTANT
            yield f"{ROLES[state]}:"
            continue
        row, i = rows[i], i + 1
        if letter == "K":
            state = NEXT[state][row.role[:1]]
            yield f"{row.role}:{row.text}"
        elif letter == "R":
            state = USER if state != USER else ASSISTANT
            yield f"{ROLES[state]}:{row.text}"


class Along:
    """The lightest repairs along a conversation that comes segment by segment: one for each state, with the digest of what it leaves."""

    def __init__(self):
        self.best: dict[int, tuple[int, str, object]] = {START: (0, "", hashlib.sha256())}

    def add(self, rows: list[Row], weights: dict[int, dict[int, Weight]]) -> None:
        """``weights``: of the segment, from each state to each state."""
        best = {}
        for then in STATES:
            ways = [(cost + weights[q][then][0], audit + weights[q][then][1], q) for q, (cost, audit, _) in self.best.items() if then in weights[q]]
            if ways:
                cost, audit, q = min(ways)
                digest = self.best[q][2].copy()
                for line in repaired(rows, q, weights[q][then][1]):
                    # A state other than the first has left a row already.
                    digest.update(("\n" if q != START else "").encode() + line.encode())
                    q = -1
                best[then] = (cost, audit, digest)
        self.best = best

    def ended(self) -> tuple[int, str, str]:
        cost, audit, digest = min((self.best[q] for q in FINAL if q in self.best), key=lambda found: found[:2])
        return cost, audit, digest.hexdigest()
