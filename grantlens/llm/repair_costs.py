"""Cheapest edits of a sequence of roles, by tables over blocks of symbols.

A conversation is read as a string of symbols, one per row. An automaton says which sequences of
roles are legal. The vector of the least costs to the end, one number per state of the automaton,
takes few shapes once its least number is subtracted; all that can arise are numbered here, and a
table says for every shape and every block of ``BLOCK`` symbols which shape stands before the block
and by how much its costs are higher (the method of Four Russians). A conversation is so passed from
its end in steps of a block. For the edits themselves each block is opened again, from its right end.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Symbols are 2 * role + truncated, or GONE for a row that must be deleted.
ROLES, GONE = "sua", 8
SYMBOLS, BLOCK = 9, 4
#: States: nothing yet, after the system's turn, after the user's, after the assistant's.
STATES, FIRST, AFTER = 4, 0, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role that an inserted or changed row must have, by state.
GIVEN = ("user", "user", "assistant", "user")
INSERTED = (2, 2, 3, 2)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 40


def with_inserts(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs where rows may be inserted first."""
    none, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return tuple(min(cost, NEVER) for cost in (min(none, INSERT + user), min(system, INSERT + user), user, assistant))


def choices(symbol: int, state: int):
    """Letter, cost and next state of each edit of one row, least letter first."""
    yield "D", DELETE, state
    if symbol == GONE:
        return
    late = TRUNCATED * (symbol % 2)
    kept = AFTER.get((state, ROLES[symbol // 2])) if symbol // 2 < len(ROLES) else None
    if kept is not None:
        yield "K", late, kept
    yield "R", REROLE + late, INSERTED[state]


def before(symbol: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs before a row from those after it."""
    return with_inserts(tuple(min(cost + costs[to] for _, cost, to in choices(symbol, state)) for state in range(STATES)))


#: At the end a legal sequence is empty or ends with the assistant.
END = with_inserts((0, NEVER, NEVER, 0))


class Tables:
    """All shapes of cost vectors, their transitions over single symbols and over blocks."""

    def __init__(self) -> None:
        self.shapes: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        units = [tuple(0 if k == state else NEVER for k in range(STATES)) for state in range(STATES)]
        self.end = self._shape(END)[0]
        self.units = [self._shape(with_inserts(unit))[0] for unit in units]
        shape, raise_ = [], []
        for costs in self.shapes:  # grows while it is read
            found = [self._shape(before(symbol, costs)) for symbol in range(SYMBOLS)]
            shape.append([k for k, _ in found])
            raise_.append([more for _, more in found])
        self.shape, self.raised = np.array(shape, np.int32), np.array(raise_, np.int64)
        #: Tables over blocks; a block's number has its first symbol as the highest digit.
        self.block_shape, self.block_raised = np.arange(len(self.shapes), dtype=np.int32)[:, None], np.zeros((len(self.shapes), 1), np.int64)
        for _ in range(BLOCK):
            # one more symbol in front of what is known
            ahead = [self.shape[self.block_shape, symbol] for symbol in range(SYMBOLS)]
            more = [self.raised[self.block_shape, symbol] + self.block_raised for symbol in range(SYMBOLS)]
            self.block_shape, self.block_raised = np.concatenate(ahead, axis=1), np.concatenate(more, axis=1)
        self.edits = [[[self._edit(shape, symbol, state) for state in range(STATES)] for symbol in range(SYMBOLS)] for shape in range(len(self.shapes))]

    def _shape(self, costs: tuple[int, ...]) -> tuple[int, int]:
        least = min(costs)
        shape = tuple(NEVER if cost >= NEVER // 2 else cost - least for cost in costs)
        if shape not in self.number:
            self.number[shape] = len(self.shapes)
            self.shapes.append(shape)
        return self.number[shape], least

    def shape_of(self, costs) -> int:
        """The number of the shape of ``costs``, which must be one that can arise."""
        least = min(costs)
        return self.number[tuple(NEVER if cost >= NEVER // 2 else cost - least for cost in costs)]

    def _edit(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """The least letters that spend one row at least cost, inserts before it first, and the next state."""
        costs = self.shapes[after]
        here = before(symbol, costs)
        letters = ""
        if here[state] >= NEVER // 2:
            return letters, state
        while True:
            options = [(letter, to) for letter, cost, to in choices(symbol, state) if cost + costs[to] == here[state]]
            if INSERT + here[INSERTED[state]] == here[state]:
                options.append(("I", INSERTED[state]))
            letter, state = min(options)
            letters += letter
            if letter != "I":
                return letters, state

    def passed(self, symbols: np.ndarray, shape: int) -> tuple[int, int, list[int]]:
        """From the right end's shape: shape and raise before ``symbols``, and the shapes right of each block."""
        whole = len(symbols) // BLOCK * BLOCK
        raised = 0
        for symbol in symbols[whole:][::-1].tolist():
            raised += int(self.raised[shape, symbol])
            shape = int(self.shape[shape, symbol])
        numbers = symbols[:whole].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
        bounds = []
        for number in numbers[::-1].tolist():
            bounds.append(shape)
            raised += int(self.block_raised[shape, number])
            shape = int(self.block_shape[shape, number])
        return shape, raised, bounds[::-1]

    def matrix(self, symbols: np.ndarray) -> list[int]:
        """Least cost from each state before ``symbols`` to each state after them, row by row."""
        columns = []
        for unit in self.units:
            shape, raised, _ = self.passed(symbols, unit)
            columns.append([cost if cost >= NEVER // 2 else cost + raised for cost in self.shapes[shape]])
        return [columns[after][state] for state in range(STATES) for after in range(STATES)]

    def traced(self, symbols: np.ndarray, shape: int, bounds: list[int], state: int) -> tuple[list[str], list[int], int]:
        """Letters and state before each row, by the least edits from ``state``; and the state after all."""
        letters, states = [], []
        whole = len(bounds) * BLOCK
        parts = [(symbols[k * BLOCK : (k + 1) * BLOCK].tolist(), right) for k, right in enumerate(bounds)]
        for part, right in [*parts, (symbols[whole:].tolist(), shape)]:
            after = [right]
            for symbol in part[:0:-1]:  # the block opened from its right end
                after.append(int(self.shape[after[-1], symbol]))
            for symbol, costs in zip(part, after[::-1], strict=False):
                states.append(state)
                letter, state = self.edits[costs][symbol][state]
                letters.append(letter)
        return letters, states, state


@cache
def tables() -> Tables:
    return Tables()


def joined(matrix: list[int], costs: list[int]) -> list[int]:
    """Least costs before a piece from its matrix and the costs after it."""
    return [
        min(min(matrix[STATES * state + after] + costs[after], NEVER) for after in range(STATES)) for state in range(STATES)
    ]


#: What is inserted at the end, by state.
LAST = ("", "II", "I", "")
