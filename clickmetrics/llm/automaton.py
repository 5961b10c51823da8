"""Regular expressions over bytes, compiled to minimal deterministic automata.

The patterns are those that secret rules use: literals, classes, groups, alternation and the
repetitions ``? * + {n} {n,} {n,m}``. An automaton finds the longest match, which is the one of a
greedy pattern wherever the next byte decides between going on and stopping.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}
SPACE = frozenset(b" \t\n\r\f\v")
DIGIT = frozenset(b"0123456789")


class PatternError(ValueError):
    pass


class _Reader:
    """Reads a pattern into nested tuples: ('set', bytes), ('cat', parts), ('alt', parts),
    ('rep', part, least, most or None)."""

    def __init__(self, pattern: str, any_case: bool) -> None:
        self.pattern, self.at, self.any_case = pattern, 0, any_case

    def read(self):
        node = self._alternatives()
        if self.at < len(self.pattern):
            raise PatternError(f"unexpected {self.pattern[self.at]!r} in {self.pattern!r}")
        return node

    def _peek(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def _take(self) -> str:
        char = self._peek()
        if not char:
            raise PatternError(f"{self.pattern!r} ends too early")
        self.at += 1
        return char

    def _alternatives(self):
        parts = [self._sequence()]
        while self._peek() == "|":
            self._take()
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _sequence(self):
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated(self._single()))
        return ("cat", parts)

    def _single(self):
        char = self._take()
        if char == "(":
            node = self._alternatives()
            if self._take() != ")":
                raise PatternError(f"group not closed in {self.pattern!r}")
            return node
        if char == "[":
            return ("set", self._class())
        if char == "\\":
            return ("set", self._cased(self._escaped()))
        return ("set", self._cased(frozenset(char.encode("ascii"))))

    def _escaped(self) -> frozenset[int]:
        char = self._take()
        if char == "x":
            return frozenset([int(self._take() + self._take(), 16)])
        named = {"s": SPACE, "d": DIGIT}.get(char)
        return named or frozenset(ESCAPES.get(char, char).encode("ascii"))

    def _class(self) -> frozenset[int]:
        negated = self._peek() == "^"
        if negated:
            self._take()
        members: set[int] = set()
        while self._peek() != "]":
            char = self._take()
            low = self._escaped() if char == "\\" else frozenset(char.encode("ascii"))
            following = self.pattern[self.at : self.at + 2]
            if len(low) == 1 and following[:1] == "-" and following[1:] not in ("", "]"):
                self._take()
                char = self._take()
                high = self._escaped() if char == "\\" else frozenset(char.encode("ascii"))
                members |= set(range(min(low), max(high) + 1))
            else:
                members |= low
        self._take()
        cased = self._cased(frozenset(members))
        return frozenset(range(256)) - cased if negated else cased

    def _cased(self, members: frozenset[int]) -> frozenset[int]:
        if not self.any_case:
            return members
        text = bytes(members)
        return frozenset(text.lower() + text.upper())

    def _repeated(self, node):
        bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}
        while (char := self._peek()) in ("?", "*", "+", "{") and char:
            self._take()
            if char == "{":
                inside = ""
                while (digit := self._take()) != "}":
                    inside += digit
                least, comma, most = inside.partition(",")
                low = int(least)
                node = ("rep", node, low, int(most) if most else None if comma else low)
            else:
                node = ("rep", node, *bounds[char])
        return node


def read_pattern(pattern: str, any_case: bool = False):
    """A pattern's tree; ``any_case`` lets ASCII letters match in either case."""
    return _Reader(pattern, any_case).read()


class _Fragments:
    """A nondeterministic automaton: steps on byte sets, and steps that read nothing."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node, start: int, backward: bool) -> int:
        """Put ``node`` after ``start``; the state reached after it."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in reversed(node[1]) if backward else node[1]:
                start = self.add(part, start, backward)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                self.free[self.add(part, start, backward)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start, backward)
        if most is None:
            loop, end = self.state(), self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop, backward)].append(loop)
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start, backward)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in found:
                    found.add(state)
                    todo.append(state)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """Transitions as one flat list: the state after byte ``b`` is ``table[state + b]``.

    A state is the offset of its row. Accepting states come last, from ``accepting`` on;
    ``accepts`` gives their rules as bits. ``dead`` is the state without a way out, if any.
    """

    table: list[int]
    start: int
    accepting: int
    accepts: dict[int, int]
    dead: int

    @property
    def states(self) -> int:
        return len(self.table) // 256

    def marks_backward(self, data: bytes) -> list[tuple[int, int]]:
        """One pass over the bytes from the last to the first: (position, rules that have a match
        starting there), rightmost first. For an automaton of reversed patterns, unanchored."""
        table, accepting, accepts = self.table, self.accepting, self.accepts
        marks, state, at = [], self.start, len(data)
        for byte in reversed(data):
            at -= 1
            state = table[state + byte]
            if state >= accepting:
                marks.append((at, accepts[state]))
        return marks

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at ``start``, or -1."""
        table, accepting, dead, state = self.table, self.accepting, self.dead, self.start
        end = start if state >= accepting else -1
        for at in range(start, len(data)):
            state = table[state + data[at]]
            if state == dead:
                break
            if state >= accepting:
                end = at + 1
        return end


def compile_patterns(trees: list, backward: bool = False, anywhere: bool = False) -> Automaton:
    """One automaton for all patterns, by subset construction, then minimised.

    ``backward`` reads the patterns from their ends, ``anywhere`` lets a match begin at any byte.
    """
    parts = _Fragments()
    root = parts.state()
    ends = {}
    for rule, tree in enumerate(trees):
        first = parts.state()
        parts.free[root].append(first)
        ends[parts.add(tree, first, backward)] = 1 << rule
    sets = {members for steps in parts.steps for members, _ in steps}
    classes = _byte_classes(sets)
    samples = [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]

    begin = parts.closure([root])
    numbers, todo, rows = {begin: 0}, [begin], []
    for states in todo:
        row = []
        for byte in samples:
            reached = {end for s in states for members, end in parts.steps[s] if byte in members}
            target = parts.closure(reached | {root} if anywhere else reached)
            if target not in numbers:
                numbers[target] = len(numbers)
                todo.append(target)
            row.append(numbers[target])
        rows.append(row)
    accepts = np.array([sum(ends.get(s, 0) for s in states) for states in todo], dtype=object)
    return _minimal(np.array(rows), accepts, classes)


def _byte_classes(sets) -> np.ndarray:
    """A number for each byte; bytes that no set tells apart share one."""
    signs = np.array([[byte in members for members in sets] for byte in range(256)], dtype=bool)
    return np.unique(signs, axis=0, return_inverse=True)[1].ravel()


def _minimal(rows: np.ndarray, accepts: np.ndarray, classes: np.ndarray) -> Automaton:
    """Merge states that no text can tell apart: split by acceptance, then by where each class of
    bytes leads, until nothing splits."""
    block = np.unique(accepts.astype(str), return_inverse=True)[1].ravel()
    while True:
        signs = np.column_stack([block, block[rows]])
        finer = np.unique(signs, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    first = np.unique(block, return_index=True)[1]
    order = sorted(range(len(first)), key=lambda b: (accepts[first[b]] != 0, first[b]))
    place = np.empty(len(first), dtype=int)
    place[order] = np.arange(len(first))
    merged = place[block[rows[first[order]]]]
    table = (merged[:, classes] * 256).ravel().tolist()
    masks = [int(accepts[first[b]]) for b in order]
    accepting = next((i for i, mask in enumerate(masks) if mask), len(masks))
    loops = [
        i for i in range(accepting) if (merged[i] == i).all()
    ]
    return Automaton(
        table=table,
        start=int(place[block[0]]) * 256,
        accepting=accepting * 256,
        accepts={i * 256: mask for i, mask in enumerate(masks) if mask},
        dead=loops[0] * 256 if loops else -1,
    )
