"""One minimal automaton for several byte patterns: it finds where any of them occurs in a single pass over the bytes."""

from __future__ import annotations

from re import _constants as C, _parser as P

import numpy as np


class _Graph:
    """States joined by byte sets and by free steps."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.steps: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def add(self, items, at: int) -> int:
        """Append a parsed pattern behind ``at``; returns its last state."""
        for op, value in items:
            if op is C.LITERAL or op is C.IN:
                to = self.state()
                self.steps[at].append((_bytes(op, value), to))
                at = to
            elif op is C.SUBPATTERN:
                at = self.add(value[-1], at)
            elif op is C.BRANCH:
                to = self.state()
                for branch in value[1]:
                    self.free[self.add(branch, at)].append(to)
                at = to
            elif op is C.MAX_REPEAT:
                low, high, inner = value
                for _ in range(low):
                    at = self.add(inner, at)
                if high is C.MAXREPEAT:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add(inner, loop)].append(loop)
                    at = loop
                else:
                    to = self.state()
                    self.free[at].append(to)
                    for _ in range(high - low):
                        at = self.add(inner, at)
                        self.free[at].append(to)
                    at = to
            else:
                raise ValueError(f"a rule may not use {op}")
        return at

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


def _bytes(op, value) -> frozenset:
    out: set[int] = set()
    for kind, x in [(op, value)] if op is C.LITERAL else value:
        if kind is C.LITERAL:
            out.add(x)
        elif kind is C.RANGE:
            out.update(range(x[0], x[1] + 1))
        else:
            raise ValueError(f"a rule may not use {kind}")
    return frozenset(out)


class Automaton:
    """``table[state, byte class]`` over the patterns; a state with marks (bit i: pattern i has occurred) is never left.

    Built by subset construction over the joined patterns and reduced to the fewest states. The size depends on the patterns alone.
    """

    def __init__(self, patterns: list[str]) -> None:
        graph, ends = _Graph(), {}
        start = graph.state()
        for i, pattern in enumerate(patterns):
            ends[graph.add(P.parse(pattern), start)] = 1 << i
        sets = sorted({s for steps in graph.steps for s, _ in steps}, key=sorted)
        member = np.array([[b in s for s in sets] for b in range(256)])
        _, first, classes = np.unique(member, axis=0, return_index=True, return_inverse=True)
        self.classes = classes.reshape(-1).astype(np.uint8)
        opening = graph.closure([start])
        number, table, marks, todo = {opening: 0}, [], [], [opening]
        while todo:
            own = todo.pop(0)
            mark = sum(bit for end, bit in ends.items() if end in own) if isinstance(own, frozenset) else own
            marks.append(mark)
            line = []
            for byte in first.tolist():
                if mark:
                    to = mark
                else:
                    to = graph.closure({t for s in own for allowed, t in graph.steps[s] if byte in allowed} | opening)
                    found = sum(bit for end, bit in ends.items() if end in to)
                    to = found or to
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                line.append(number[to])
            table.append(line)
        self._minimise(np.array(table, np.int32), np.array(marks, np.int64))
        #: Bytes after which nothing is remembered: a text may be cut there.
        idle = (self.table[self.marks == 0] == 0).all(0)
        self.cuts = idle[self.classes]
        width = self.table.shape[1]
        self._flat = (self.table * width).astype(np.int32).reshape(-1)
        self._marks = self.marks
        self._list = self._flat.tolist()

    def _minimise(self, table: np.ndarray, marks: np.ndarray) -> None:
        """Split states by their marks, then by where their steps lead, until nothing splits any more."""
        _, group = np.unique(marks, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
            finer = finer.reshape(-1)
            if finer.max() == group.max():
                break
            group = finer
        order = np.full(group.max() + 1, len(group))
        np.minimum.at(order, group, np.arange(len(group)))
        rank = np.argsort(np.argsort(order))
        group, first = rank[group], np.sort(order)
        self.table, self.marks = group[table[first]], marks[first]

    def scan(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, together: int = 2048) -> np.ndarray:
        """The marks for each stretch of bytes; stretches advance side by side, those over ``together`` bytes one by one."""
        codes, width = self.classes[raw], self.table.shape[1]
        sizes = ends - starts
        state = np.zeros(len(starts), np.int32)
        order = np.argsort(-sizes, kind="stable")
        long = int(np.searchsorted(-sizes[order], -together))
        for k in order[:long].tolist():
            at, step = 0, self._list
            for code in codes[starts[k]:ends[k]].tolist():
                at = step[at + code]
            state[k] = at
        order = order[long:]
        if len(order):
            begin, own = starts[order], np.zeros(len(order), np.int32)
            active = np.searchsorted(-sizes[order], -np.arange(int(sizes[order[0]])), "left")
            for t, n in enumerate(active.tolist()):
                own[:n] = self._flat[own[:n] + codes[begin[:n] + t]]
            state[order] = own
        return self._marks[state // width]
