"""Alignment of a conversation's turns to the alternating grammar ``(s?(ua)+)?``, by target length.

A turn is one symbol: ``-`` if it has to go, else the initial of its role (``s``, ``u``, ``a``, or ``x`` for any other),
upper case if it is truncated.  For every feasible target length a Wagner-Fischer table is filled inside the Ukkonen
band that the cheapest alignment so far allows; its backtrace takes the least of the cheapest edit strings.  Two edit
strings of equal cost over the same turns are never a prefix of each other (the longer would hold more inserts), so the
least string of two neighbouring blocks is the least string of the first followed by that of the second.  Results of
blocks, one per pair of grammar states, therefore combine in any grouping.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

# Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Grammar states by what was put out last: nothing, s, u, a; a conversation may end at the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = STATES = (0, 1, 2, 3)
ENDS = (START, AFTER_A)
BLOCK = 24

# Cheapest edits from one state to another: cost and edit string; a missing pair cannot be reached.
Matrix = dict[tuple[int, int], tuple[int, str]]


def _target(entry: int, with_s: bool, length: int) -> str:
    """The ``length`` initials that follow ``entry``."""
    if with_s:
        return "s" + _target(AFTER_S, False, length - 1)
    first, second = ("a", "u") if entry == AFTER_U else ("u", "a")
    return (first + second) * (length // 2) + first * (length % 2)


def _exit(entry: int, target: str) -> int:
    return {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[target[-1]] if target else entry


def _least_change(rows: int, length: int) -> int:
    """What any alignment of so many rows to so many initials costs."""
    return DELETE * (rows - length) if rows > length else INSERT * (length - rows)


def _pairing(symbol: str, initial: str) -> int | None:
    """Cost of putting a turn out under an initial, None if that is not allowed."""
    if symbol == "-":
        return None
    late = TRUNCATED if symbol.isupper() else 0
    if symbol.lower() == initial:
        return late
    return None if initial == "s" else RENAME + late


def _banded(symbols: str, target: str, limit: int) -> tuple[int, str] | None:
    """Cheapest alignment and its least edit string, None if it costs more than ``limit``."""
    rows, length, far = len(symbols), len(target), limit + 1
    rest = [[far] * (length + 2) for _ in range(rows + 2)]
    for i in range(rows, -1, -1):
        here, below = rest[i], rest[i + 1]
        # Cells outside need more deletions or insertions than the limit pays for.
        for j in range(min(length, i + limit // INSERT), max(0, i - limit // DELETE) - 1, -1):
            if i == rows and j == length:
                here[j] = 0
                continue
            best = far
            if i < rows:
                best = below[j] + DELETE
                if j < length:
                    pair = _pairing(symbols[i], target[j])
                    if pair is not None and below[j + 1] + pair < best:
                        best = below[j + 1] + pair
            if j < length and target[j] != "s" and here[j + 1] + INSERT < best:
                best = here[j + 1] + INSERT
            if best + _least_change(i, j) <= limit:
                here[j] = best
    if rest[0][0] > limit:
        return None
    i = j = 0
    edits = []
    while i < rows or j < length:
        left = rest[i][j]
        if i < rows and rest[i + 1][j] + DELETE == left:
            edits.append("D")
            i += 1
        elif j < length and target[j] != "s" and rest[i][j + 1] + INSERT == left:
            edits.append("I")
            j += 1
        else:
            edits.append("K" if symbols[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(edits)


def _affordable(symbols: str, entry: int, leave: int) -> int:
    """Cost of some alignment that ends in ``leave``: turn by turn the cheaper of putting it out and deleting it."""
    if leave == START:
        return DELETE * len(symbols)
    if leave == AFTER_S:
        return DELETE * len(symbols) + TRUNCATED
    state, cost = entry, 0
    for symbol in symbols:
        initial = "a" if state == AFTER_U else "u"
        pair = _pairing(symbol, initial)
        if pair is None or pair > DELETE:
            cost += DELETE
        else:
            cost, state = cost + pair, _exit(state, initial)
    # One insert leads from user to assistant and back, two from the start or a system turn.
    steps = 0 if state == leave else 1 if leave == AFTER_U or state == AFTER_U else 2
    return cost + INSERT * steps


@lru_cache(maxsize=1 << 15)
def align(symbols: str, entry: int, leave: int) -> tuple[int, str] | None:
    """Cheapest edits of the turns that lead from ``entry`` to ``leave``; the least edit string among equals."""
    rows = len(symbols)
    limit, best = _affordable(symbols, entry, leave), None
    lengths = sorted(range(rows + limit // INSERT + 1), key=lambda k: (_least_change(rows, k), k))
    for length in lengths:
        if _least_change(rows, length) > limit:
            break
        for with_s in (False, True) if entry == START and length else (False,):
            target = _target(entry, with_s, length)
            if _exit(entry, target) != leave:
                continue
            found = _banded(symbols, target, limit)
            if found and (best is None or found < best):
                best, limit = found, found[0]
    return best


def conversation(symbols: str) -> tuple[int, str]:
    """Cost and edit string of a whole conversation; a long one is joined from blocks, in time linear in its turns."""
    if len(symbols) <= BLOCK:
        return min(found for leave in ENDS if (found := align(symbols, START, leave)) is not None)
    states = {START: (0, "")}
    for at in range(0, len(symbols), BLOCK):
        part, onward = symbols[at:at + BLOCK], {}
        for entry, (cost, edits) in states.items():
            for leave in STATES:
                found = align(part, entry, leave)
                if found is not None:
                    sum_ = (cost + found[0], edits + found[1])
                    if leave not in onward or sum_ < onward[leave]:
                        onward[leave] = sum_
        states = _undominated(onward)
    return min(states[leave] for leave in ENDS if leave in states)


def _undominated(states: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """States that can still lead to a cheapest alignment.

    After a u one insert leads to after an a, and back; after an s all goes on as after an a; before everything, the one
    thing more is to keep a later s, which after an a is deleted.
    """
    far = 1 << 60
    after_u, after_a = states.get(AFTER_U, (far,))[0], states.get(AFTER_A, (far,))[0]
    best_a, best_u = min(after_a, after_u + INSERT), min(after_u, after_a + INSERT)
    limits = {START: best_a + DELETE, AFTER_S: best_a, AFTER_U: best_u, AFTER_A: best_a}
    return {state: found for state, found in states.items() if found[0] <= limits[state]}


def block(symbols: str) -> Matrix:
    return {(a, b): found for a in STATES for b in STATES if (found := align(symbols, a, b)) is not None}


def joined(first: Matrix, second: Matrix) -> Matrix:
    out: Matrix = {}
    for (a, k), (cost, edits) in first.items():
        for b in STATES:
            if (k, b) in second:
                more, then = second[k, b]
                found = (cost + more, edits + then)
                if (a, b) not in out or found < out[a, b]:
                    out[a, b] = found
    return out


class Chain:
    """Blocks joined in order, pairs of equal size first, so that edit strings are copied log(n) times."""

    def __init__(self) -> None:
        self._parts: list[tuple[int, Matrix]] = []

    def add(self, part: Matrix) -> None:
        size = 1
        while self._parts and self._parts[-1][0] == size:
            part = joined(self._parts.pop()[1], part)
            size *= 2
        self._parts.append((size, part))

    def result(self) -> Matrix:
        parts = [part for _, part in self._parts]
        whole = parts.pop()
        while parts:
            whole = joined(parts.pop(), whole)
        return whole


def chained(parts: Iterable[Matrix]) -> Matrix:
    chain = Chain()
    for part in parts:
        chain.add(part)
    return chain.result()
