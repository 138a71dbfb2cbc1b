"""Byte automata for sets of regular expressions, and their scan over many texts at once.

Rules are written in the common core of regular expressions: literals, escapes, classes, groups,
alternatives and the quantifiers ``? * + {m} {m,} {m,n}``. Each becomes a set of positions with
follow sets; the subset construction runs over all rules together, and the result is minimised by
partition refinement. A state is a row of a transition array over classes of equal bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RESET = 0xFF  # no byte of UTF-8; leads back to the start from every state
LANES = 4096
LANE_BYTES = 256


@dataclass(frozen=True)
class Rule:
    """``trigger`` matches a beginning of every match; by default it is the whole pattern."""

    name: str
    pattern: str
    trigger: str = ""
    any_case: bool = False


class _Parser:
    """Positions, their byte sets and their follow sets, rule after rule."""

    def __init__(self) -> None:
        self.bytes: list[int] = []  # of a position, as bits
        self.follow: list[int] = []  # positions after a position, as bits

    def rule(self, rule: Rule, anchored: bool) -> tuple[bool, int, int]:
        self.text = rule.pattern if anchored else rule.trigger or rule.pattern
        self.at, self.any_case = 0, rule.any_case
        node = self.either()
        if self.at != len(self.text):
            raise ValueError(f"Rule {rule.name}: unexpected {self.text[self.at :]!r}")
        return self.build(node)

    # -- text to tree ---------------------------------------------------------

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def either(self):
        parts = [self.chain()]
        while self.peek() == "|":
            self.take()
            parts.append(self.chain())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def chain(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("and", parts)

    def repeated(self, node):
        sign = self.peek()
        if sign and sign in "?*+":
            self.take()
            return ("times", node, int(sign == "+"), 1 if sign == "?" else None)
        if sign == "{":
            end = self.text.index("}", self.at)
            low, comma, high = self.text[self.at + 1 : end].partition(",")
            self.at = end + 1
            return ("times", node, int(low), (int(high) if high else None) if comma else int(low))
        return node

    def atom(self):
        sign = self.take()
        if sign == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            node = self.either()
            if self.take() != ")":
                raise ValueError("A group is not closed")
            return node
        if sign == "[":
            return self.set_()
        return ("set", self.folded(1 << self.escaped(sign)))

    def escaped(self, sign: str) -> int:
        if sign == "\\":
            sign = self.take()
            if sign == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        if ord(sign) > 127:
            raise ValueError("Rules are written in ASCII")
        return ord(sign)

    def set_(self):
        negated = self.peek() == "^"
        self.at += negated
        bits = 0
        while self.peek() != "]":
            low = high = self.escaped(self.take())
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.escaped(self.take())
            bits |= (1 << high + 1) - (1 << low)
        self.take()
        return ("set", ((1 << 128) - 1) & ~bits if negated else self.folded(bits))

    def folded(self, bits: int) -> int:
        if self.any_case:
            for upper in range(65, 91):
                if bits >> upper & 1 or bits >> upper + 32 & 1:
                    bits |= 1 << upper | 1 << upper + 32
        return bits

    # -- tree to positions: (may be empty, first positions, last positions) ------

    def link(self, last: int, first: int) -> None:
        for p in _bits(last):
            self.follow[p] |= first

    def build(self, node) -> tuple[bool, int, int]:
        if node[0] == "set":
            self.bytes.append(node[1])
            self.follow.append(0)
            own = 1 << len(self.bytes) - 1
            return False, own, own
        if node[0] == "or":
            parts = [self.build(x) for x in node[1]]
            firsts = lasts = 0
            for _, first, last in parts:
                firsts, lasts = firsts | first, lasts | last
            return any(p[0] for p in parts), firsts, lasts
        if node[0] == "and":
            whole = (True, 0, 0)
            for x in node[1]:
                whole = self.join(whole, self.build(x))
            return whole
        _, inner, low, high = node
        whole = (True, 0, 0)
        for _ in range(low - (high is None and low > 0)):
            whole = self.join(whole, self.build(inner))
        if high is None:
            empty, first, last = self.build(inner)
            self.link(last, first)
            return self.join(whole, (empty or low == 0, first, last))
        tail: list[tuple[bool, int, int]] = []
        for _ in range(high - low):
            tail.append(self.build(inner))
        rest = (True, 0, 0)
        for part in reversed(tail):
            _, first, last = self.join(part, rest)
            rest = (True, first, last)
        return self.join(whole, rest)

    def join(self, left, right) -> tuple[bool, int, int]:
        self.link(left[2], right[1])
        return (
            left[0] and right[0],
            left[1] | (right[1] if left[0] else 0),
            right[2] | (left[2] if right[0] else 0),
        )


def _bits(mask: int):
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


@dataclass(frozen=True)
class Automaton:
    """``table[state * width + group[byte]]`` is the next state times ``width``.

    State 0 is the start; ``accepts`` has per state the bits of the rules that end there; ``dead``
    is the state without a way on, or -1.
    """

    table: np.ndarray
    group: np.ndarray
    accepts: np.ndarray
    width: int
    dead: int

    @property
    def states(self) -> int:
        return len(self.accepts)


def compile_rules(rules: list[Rule], anchored: bool = False) -> Automaton:
    """One minimal automaton: of the triggers, which may begin at every byte, or, anchored, of the
    whole patterns from the first byte on.

    Triggers leave out long counted tails: a prefix that may begin again inside its own tail would
    otherwise multiply the states.
    """
    parser = _Parser()
    firsts, ends = 0, []
    for rule in rules:
        empty, first, last = parser.rule(rule, anchored)
        if empty:
            raise ValueError(f"Rule {rule.name} matches the empty text")
        firsts |= first
        ends.append(last)

    # Bytes that no position tells apart share a column.
    signs = [tuple(b >> byte & 1 for b in parser.bytes) for byte in range(256)]
    columns = {sign: i for i, sign in enumerate(dict.fromkeys(signs))}
    group = np.array([columns[s] for s in signs], np.uint8)
    admits = [sum(1 << p for p, on in enumerate(sign) if on) for sign in columns]
    reset = int(group[RESET])

    # Subset construction; a state is the set of positions just read. -1: anchored and begun.
    start = (0, True)
    number = {start: 0}
    queue, rows = [start], []
    for state, begin in queue:
        after = firsts if begin else 0
        for p in _bits(state):
            after |= parser.follow[p]
        row = []
        for column, admitted in enumerate(admits):
            to = start if column == reset and not anchored else (after & admitted, not anchored)
            if to not in number:
                number[to] = len(queue)
                queue.append(to)
            row.append(number[to])
        rows.append(row)
    table = np.array(rows, np.int64)
    accepts = np.array(
        [sum(1 << k for k, end in enumerate(ends) if s & end) for s, _ in queue], np.int64
    )
    table, accepts = _minimised(table, accepts)
    width = table.shape[1]
    sinks = [s for s in range(len(accepts)) if not accepts[s] and (table[s] == s).all()]
    return Automaton(
        np.ascontiguousarray(table.ravel() * width), group, accepts, width, max(sinks, default=-1)
    )


def _minimised(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart: blocks are split by where their states lead."""
    weights = np.random.default_rng(1).integers(1, 2**63, table.shape[1] + 1, dtype=np.uint64) | 1
    _, block = np.unique(accepts, return_inverse=True)
    count = 0
    while count != block.max() + 1:
        count = block.max() + 1
        mixed = (block[table].astype(np.uint64) + 1) * weights[1:]
        sign = mixed.sum(axis=1) + (block.astype(np.uint64) + 1) * weights[0]
        _, block = np.unique(sign, return_inverse=True)
    # The start becomes state 0.
    _, first = np.unique(block, return_index=True)
    order = np.argsort(first)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    keep = first[order]
    return place[block[table[keep]]], accepts[keep]


def run_states(auto: Automaton, data: bytes) -> np.ndarray:
    """The state after each byte, in one pass over the data from the start state.

    The data is cut into lanes that step together. A lane begins in the start state; where the lane
    before ended in another, the lane is read again from there until its states agree.
    """
    raw = np.frombuffer(data, np.uint8)
    lanes = max(1, min(LANES, len(raw) // LANE_BYTES))
    steps = -(-len(raw) // lanes)
    padded = np.full(lanes * steps, RESET, np.uint8)
    padded[: len(raw)] = raw
    columns = np.ascontiguousarray(auto.group[padded].reshape(lanes, steps).T)
    states = np.empty((steps, lanes), np.int32)
    state = np.zeros(lanes, np.int64)
    index = np.empty(lanes, np.int64)
    for step in range(steps):
        np.add(state, columns[step], out=index)
        np.take(auto.table, index, out=state, mode="clip")
        states[step] = state
    changed = np.arange(1, lanes)
    while len(changed):
        state = states[-1, changed - 1].astype(np.int64)
        open_ = changed[state != 0]
        state = state[state != 0]
        before = states[-1].copy()
        for step in range(steps):
            if not len(open_):
                break
            state = auto.table[state + columns[step, open_]]
            differs = states[step, open_] != state
            open_, state = open_[differs], state[differs]
            states[step, open_] = state
        changed = np.flatnonzero(states[-1] != before) + 1
        changed = changed[changed < lanes]
    return states.T.reshape(-1)[: len(raw)] // auto.width


def longest(auto: Automaton, data: bytes, start: int) -> int:
    """The end of the longest match of an anchored automaton that begins at ``start``, or -1."""
    table, group, accepts = auto.table, auto.group, auto.accepts
    state, end, dead, width = 0, -1, auto.dead * auto.width, auto.width
    for at in range(start, len(data)):
        state = table[state + group[data[at]]]
        if state == dead:
            break
        if accepts[state // width]:
            end = at + 1
    return end
