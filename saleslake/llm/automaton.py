"""One deterministic automaton for all rules: subset construction, minimisation, byte scan.

A rule is ``head`` (a regular expression) followed by at least ``least`` characters of one class
``tail``. No head may hold a whole match of its own rule.
"""

from __future__ import annotations

import re._constants as op
import re._parser
from dataclasses import dataclass

import numpy as np

SEPARATOR = 0xFF  # in no UTF-8 text: the automaton starts anew there
LANES = 4096


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    tail: str
    least: int
    ignore_case: bool = False  # of the letters in the head


class _Nfa:
    """Thompson's construction. Edges are (byte mask, target); ``free`` are moves without a byte."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, parsed, start: int, fold: bool) -> int:
        """The end state of a path for the parsed expression that begins at ``start``."""
        for kind, value in parsed:
            if kind is op.MAX_REPEAT:
                low, high, body = value
                for _ in range(low):
                    start = self.add(body, start, fold)
                if high is op.MAXREPEAT:
                    loop = self.state()
                    self.free[start].append(loop)
                    self.free[self.add(body, loop, fold)].append(loop)
                    start = loop
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.free[start].append(end)
                        start = self.add(body, start, fold)
                    self.free[start].append(end)
                    start = end
            elif kind is op.BRANCH:
                end = self.state()
                for body in value[1]:
                    first = self.state()
                    self.free[start].append(first)
                    self.free[self.add(body, first, fold)].append(end)
                start = end
            elif kind is op.SUBPATTERN:
                start = self.add(value[3], start, fold)
            else:
                end = self.state()
                self.edges[start].append((_mask(kind, value, fold), end))
                start = end
        return start

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for target in self.free[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


def _mask(kind, value, fold: bool) -> int:
    """Bytes that a literal or class accepts, as bits of an integer. ASCII only."""
    if kind is op.LITERAL:
        members = [value]
    elif kind is op.IN and value[0][0] is not op.NEGATE:
        members = [c for k, v in value for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1))]
    else:
        raise ValueError(f"rules hold literals, positive classes, groups and repeats, not {kind}")
    if max(members) > 127:
        raise ValueError("rules are in ASCII")
    if fold:
        members += [ord(f(chr(c))) for c in members for f in (str.lower, str.upper)]
    return sum(1 << c for c in set(members))


def _subsets(nfa: _Nfa, start: frozenset[int], accepts: dict[int, int], again: bool) -> tuple[np.ndarray, np.ndarray]:
    """Table [state, byte] and accepted rules per state (bits). ``again``: a match may begin anywhere."""
    index, order, rows, marks = {start: 0}, [start], [], []
    for at in order:  # grows while it is walked
        marks.append(sum(1 << r for r in {accepts[s] for s in at if s in accepts}))
        row = np.zeros(256, dtype=np.int64)
        moves = [e for s in at for e in nfa.edges[s]]
        of_mask: dict[tuple[int, ...], int] = {}
        for byte in range(256):
            to = tuple(sorted({t for m, t in moves if m >> byte & 1}))
            if to not in of_mask:
                closed = nfa.closure(to)
                closed = closed | start if again else closed
                if closed not in index:
                    index[closed] = len(order)
                    order.append(closed)
                of_mask[to] = index[closed]
            row[byte] = of_mask[to]
        rows.append(row)
    return np.array(rows), np.array(marks, dtype=np.int64)


def _minimised(table: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States that accept the same rules after every continuation become one; state 0 stays 0."""
    _, part = np.unique(marks, return_inverse=True)
    while True:
        view = np.column_stack([part, part[table]])
        _, finer = np.unique(view, axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    _, first, part = np.unique(part, return_index=True, return_inverse=True)
    rank = np.argsort(np.argsort(first))  # by first appearance, so that 0 stays 0
    keep = first[np.argsort(rank)]
    return rank[part][table[keep]], marks[keep]


class Scanner:
    """Finds the matches of all rules in one pass over the bytes of many texts."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        nfa, accepts, starts = _Nfa(), {}, []
        self.back = []
        for r, rule in enumerate(rules):
            head = re._parser.parse(rule.head)
            (tail,) = re._parser.parse(rule.tail)
            start = nfa.state()
            starts.append(start)
            last = nfa.state()
            nfa.edges[nfa.add(head, start, rule.ignore_case)].append((_mask(*tail, False), last))
            nfa.edges[last].append((_mask(*tail, False), last))
            accepts[last] = r
            self.back.append(self._backward(head, rule.ignore_case))
        table, marks = _minimised(*_subsets(nfa, nfa.closure(starts), accepts, True))
        self.states = len(table)
        self.table = table.astype(np.uint16)
        self.marks = marks.astype(np.min_scalar_type(int(marks.max())))

    @staticmethod
    def _backward(head, fold: bool) -> tuple[list[list[int]], list[bool]]:
        """The automaton of the head read from its end."""
        nfa = _Nfa()
        start = nfa.state()
        end = nfa.add(head, start, fold)
        turned = _Nfa()
        for _ in nfa.edges:
            turned.state()
        for s, edges in enumerate(nfa.edges):
            for mask, t in edges:
                turned.edges[t].append((mask, s))
            for t in nfa.free[s]:
                turned.free[t].append(s)
        table, marks = _minimised(*_subsets(turned, turned.closure([end]), {start: 0}, False))
        return table.tolist(), (marks > 0).tolist()

    def _pass(self, data: np.ndarray) -> np.ndarray:
        """The state after every byte. Lanes of equal length run side by side from the start
        state; where the lane before ends in another state, the lane runs anew until both agree."""
        length = max(1, -(-len(data) // LANES))
        padded = np.full(length * LANES, SEPARATOR, dtype=np.uint8)
        padded[: len(data)] = data
        lanes = np.ascontiguousarray(padded.reshape(LANES, length).T)
        flat = self.table.ravel()
        out = np.empty((length, LANES), dtype=np.uint16)
        state = np.zeros(LANES, dtype=np.int64)
        for i in range(length):
            state = flat[(state << 8) + lanes[i]].astype(np.int64)
            out[i] = state
        lane = np.arange(1, LANES)
        while len(lane):
            state, redone = out[-1, lane - 1].astype(np.int64), []
            before = out[-1, lane].copy()
            active = lane
            for i in range(length):
                state = flat[(state << 8) + lanes[i, active]].astype(np.int64)
                differ = state != out[i, active]
                if not differ.any():
                    break
                active, state = active[differ], state[differ]
                out[i, active] = state
            changed = lane[before != out[-1, lane]]
            lane = changed[changed + 1 < LANES] + 1
        return out.T.ravel()[: len(data)]

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Of each text (rule, start, end) by rule and place, in bytes: leftmost, not overlapping,
        whole runs of the tail; a match whose tail is too short is dropped but uses its bytes."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not texts:
            return found
        joined = b"\xff".join(texts) + b"\xff"
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        accepted = self.marks[self._pass(np.frombuffer(joined, dtype=np.uint8))]
        for r, rule in enumerate(self.rules):
            on = np.concatenate([[False], (accepted >> r & 1).astype(bool), [False]])
            edges = np.flatnonzero(on[1:] != on[:-1])
            first, last = edges[::2], edges[1::2]
            settled, used = -1, 0  # the last interval looked at, and the end of the last match up to it
            for j in np.flatnonzero(last - first >= rule.least).tolist():
                text = int(np.searchsorted(begins, first[j], side="right")) - 1
                match, used = self._match(joined, r, first, last, j, settled, max(int(begins[text]), used))
                settled = j
                if match and match[2] - match[1] >= rule.least:
                    found[text].append((r, match[0] - int(begins[text]), match[2] - int(begins[text])))
        return found

    def _start(self, joined: bytes, r: int, tail: int, bound: int) -> int:
        """The leftmost place from ``bound`` on where a head ends at ``tail``; -1: none."""
        table, final = self.back[r]
        state, at, best = 0, tail, tail if final[0] else -1
        dead = self._dead(r)
        while at > bound and state != dead:
            at -= 1
            state = table[state][joined[at]]
            if final[state]:
                best = at
        return best

    def _dead(self, r: int) -> int:
        table, final = self.back[r]
        return next((s for s, row in enumerate(table) if not final[s] and all(t == s for t in row)), -1)

    def _match(
        self, joined: bytes, r: int, first, last, j: int, settled: int, used: int
    ) -> tuple[tuple[int, int, int] | None, int]:
        """(start, start of the tail, end) of the match that ends with interval j of tail characters,
        and the end of the last match so far. It may not begin in an earlier match, so intervals that
        reach into it are settled first, from the last settled one on: each is looked at once."""
        chain = [j]
        start = self._start(joined, r, int(first[j]), used)
        while chain[-1] - 1 > settled and last[chain[-1] - 1] > start >= 0 and last[chain[-1] - 1] > used:
            chain.append(chain[-1] - 1)
            start = self._start(joined, r, int(first[chain[-1]]), used)
        match = None
        for i in reversed(chain):
            match = None
            for tail in range(int(first[i]), int(last[i])):
                s = self._start(joined, r, tail, used)
                if s >= used:
                    match = (s, tail, int(last[i]))
                    used = int(last[i])
                    break
        return match, used
