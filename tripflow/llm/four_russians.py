"""Cheapest repairs of role sequences by block tables over normalised cost vectors.

A conversation is a string of symbols, one per row. From each place on, the rest costs something that depends on
where the output stands: a vector of four costs. Less its least entry there are only a few such vectors, so what a
block of BLOCK symbols does to each of them is looked up in a table that is made once, whatever the rows are. Blocks
are taken from the end of a conversation backward; the edits are then read forward, block by block.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4
# Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# States of the output: nothing yet, a system row, an open user row, whole pairs.
EMPTY, SYSTEM, OPEN, CLOSED = range(4)
# A row's symbol: 0 must go; else 1 + 2 * class of its role + truncated.
CLASSES = "sua"
OTHER = len(CLASSES)
SYMBOLS = 1 + 2 * (OTHER + 1)
_FAR = 1 << 20

Vector = tuple[int, int, int, int]


def after_insert(state: int) -> int:
    """Where an inserted or reroled row leads: an assistant row to an open pair, a user row elsewhere."""
    return CLOSED if state == OPEN else OPEN


def after_keep(state: int, role: int) -> int | None:
    """Where a kept row of this class leads, or None if it can't stand here."""
    if role == 0:
        return SYSTEM if state == EMPTY else None
    if role == 1:
        return None if state == OPEN else OPEN
    return CLOSED if role == 2 and state == OPEN else None


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(2):
        costs = [min(c, INSERT + costs[after_insert(q)]) for q, c in enumerate(costs)]
    return tuple(costs)


END = _with_inserts([0, _FAR, _FAR, 0])


def _choices(symbol: int, state: int, after: Vector) -> list[tuple[str, int, int]]:
    """(initial, cost of it and all that follows, next state) of the edits that take a row, in ASCII order."""
    found = [("D", DELETE + after[state], state)]
    if symbol:
        role, more = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
        kept, reroled = after_keep(state, role), after_insert(state)
        if kept is not None:
            found.append(("K", more + after[kept], kept))
        found.append(("R", REROLE + more + after[reroled], reroled))
    return found


def before(symbol: int, after: Vector) -> Vector:
    """The costs in front of a row, from those behind it."""
    return _with_inserts([min(c for _, c, _ in _choices(symbol, q, after)) for q in range(4)])


class Tables:
    """All normalised vectors, and what each symbol and each block of symbols turns them into."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[Vector] = [END]
        place, step, paid = {END: 0}, [], []
        for vector in self.vectors:  # grows while new ones are met
            step.append([])
            paid.append([])
            for symbol in range(SYMBOLS):
                found = before(symbol, vector)
                least = min(found)
                found = tuple(c - least for c in found)
                if found not in place:
                    place[found] = len(self.vectors)
                    self.vectors.append(found)
                step[-1].append(place[found])
                paid[-1].append(least)
        self.step, self.paid = np.array(step), np.array(paid)
        self.next, self.cost = self.step, self.paid
        for _ in range(block - 1):
            # One more symbol in front: the rest of the block is taken first.
            rest, cost = self.next, self.cost
            self.next = np.concatenate([self.step[rest, s] for s in range(SYMBOLS)], axis=1)
            self.cost = np.concatenate([cost + self.paid[rest, s] for s in range(SYMBOLS)], axis=1)
        self.traced: dict[tuple[int, tuple[int, ...], int], tuple[str, int]] = {}

    def trace(self, vector: int, symbols: tuple[int, ...], state: int) -> tuple[str, int]:
        """(edits, state behind them) of a block, given the vector behind it: the ASCII-least of the cheapest."""
        key = (vector, symbols, state)
        if key not in self.traced:
            costs = [self.vectors[vector]]
            for symbol in reversed(symbols):
                costs.append(before(symbol, costs[-1]))
            costs.reverse()
            edits, q = [], state
            for i, symbol in enumerate(symbols):
                while True:
                    options = _choices(symbol, q, costs[i + 1])
                    options.insert(1, ("I", INSERT + costs[i][after_insert(q)], after_insert(q)))
                    edit, _, q = next(o for o in options if o[1] == costs[i][q])
                    edits.append(edit)
                    if edit != "I":
                        break
            self.traced[key] = "".join(edits), q
        return self.traced[key]

    def repair(self, strings: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
        """(edits, cost) of each string of symbols. All strings advance together, a block at a time."""
        sizes = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-sizes, kind="stable")
        blocks = sizes // self.block
        flat = np.concatenate([*strings, np.zeros(0, np.int64)]).astype(np.int64)
        ends = np.cumsum(sizes)
        powers = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        vector, cost = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
        behind = []
        for k in range(int(blocks.max(initial=0))):
            some = order[: np.searchsorted(-blocks[order], -k, side="left")]  # those with more than k blocks
            at = (ends[some] - (k + 1) * self.block)[:, None] + np.arange(self.block)
            code = flat[at] @ powers
            behind.append(dict(zip(some.tolist(), vector[some].tolist(), strict=True)) if len(some) < 3 else vector.copy())
            cost[some] += self.cost[vector[some], code]
            vector[some] = self.next[vector[some], code]
        audits = []
        for i, symbols in enumerate(strings):
            lead, v = int(sizes[i] % self.block), int(vector[i])
            for symbol in reversed(symbols[:lead].tolist()):
                cost[i] += self.paid[v, symbol]
                v = int(self.step[v, symbol])
            cost[i] += self.vectors[v][EMPTY]
            edits, state = self.trace(int(vector[i]), tuple(symbols[:lead].tolist()), EMPTY)
            pieces, listed = [edits], symbols.tolist()
            for k in range(int(blocks[i]) - 1, -1, -1):
                start = int(sizes[i]) - (k + 1) * self.block
                edits, state = self.trace(int(behind[k][i]), tuple(listed[start : start + self.block]), state)
                pieces.append(edits)
            while state in (SYSTEM, OPEN):
                pieces.append("I")
                state = after_insert(state)
            audits.append("".join(pieces))
        return audits, cost
