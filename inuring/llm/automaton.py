"""Regular expressions as one deterministic automaton: subset construction, minimisation, transition arrays by byte."""

from __future__ import annotations

import numpy as np

#: Repeats without an upper bound.
ENDLESS = -1


class Pattern:
    """A byte pattern as a tree: ("set", bytes), ("seq", trees), ("alt", trees) or ("repeat", tree, low, high).

    Literals, escaped signs, ``\\xHH``, classes in brackets, groups, alternatives and the repeats ``? * + {n} {n,} {n,m}``.
    """

    def __init__(self, pattern: bytes):
        self.text, self.at = pattern, 0
        self.tree = self._alternatives()
        if self.at < len(pattern):
            raise ValueError(f"not supported in a rule: {pattern[self.at :]!r}")

    def _ahead(self) -> bytes:
        return self.text[self.at : self.at + 1]

    def _alternatives(self):
        branches = [self._sequence()]
        while self._ahead() == b"|":
            self.at += 1
            branches.append(self._sequence())
        return branches[0] if len(branches) == 1 else ("alt", branches)

    def _sequence(self):
        parts = []
        while self._ahead() not in (b"", b"|", b")"):
            parts.append(self._repeated(self._one()))
        return ("seq", parts)

    def _repeated(self, tree):
        while self._ahead() and self._ahead() in b"?*+{":
            sign = self._ahead()
            self.at += 1
            if sign == b"{":
                end = self.text.index(b"}", self.at)
                low, comma, high = self.text[self.at : end].partition(b",")
                tree = ("repeat", tree, int(low), (int(high) if high else ENDLESS) if comma else int(low))
                self.at = end + 1
            else:
                tree = ("repeat", tree, int(sign == b"+"), 1 if sign == b"?" else ENDLESS)
        return tree

    def _one(self):
        sign = self._ahead()
        if sign == b"(":
            self.at += 3 if self.text[self.at : self.at + 3] == b"(?:" else 1
            tree = self._alternatives()
            if self._ahead() != b")":
                raise ValueError("a group is not closed")
            self.at += 1
            return tree
        if sign == b"[":
            return ("set", self._class())
        if sign in (b".", b"^", b"$", b"*", b"+", b"?", b"{"):
            raise ValueError(f"not supported in a rule: {sign!r}")
        return ("set", frozenset([self._byte()]))

    def _byte(self) -> int:
        sign = self._ahead()
        self.at += 1
        if sign == b"\\":
            kind = self._ahead()
            self.at += 1
            if kind == b"x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
            if kind.isalnum():
                raise ValueError(f"not supported in a rule: {kind!r}")
            return kind[0]
        return sign[0]

    def _class(self) -> frozenset[int]:
        self.at += 1
        negated = self._ahead() == b"^"
        self.at += negated
        out: set[int] = set()
        while self._ahead() != b"]":
            low = high = self._byte()
            if self._ahead() == b"-" and self.text[self.at + 1 : self.at + 2] != b"]":
                self.at += 1
                high = self._byte()
            out |= set(range(low, high + 1))
        self.at += 1
        return frozenset(set(range(256)) - out if negated else out)


class Nfa:
    """Nondeterministic automaton over bytes; ``steps[s]`` holds (byte set, target), ``free[s]`` targets without a byte."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, tree, at: int, backward: bool = False) -> int:
        """Append a pattern's tree after state ``at``, from its end to its start if ``backward``; the state that ends it."""
        kind, arg, *bounds = tree
        if kind == "seq":
            for part in reversed(arg) if backward else arg:
                at = self.add(part, at, backward)
            return at
        end = self.state()
        if kind == "set":
            self.steps[at].append((arg, end))
        elif kind == "alt":
            for branch in arg:
                start = self.state()
                self.free[at].append(start)
                self.free[self.add(branch, start, backward)].append(end)
        else:
            low, high = bounds
            for _ in range(low):
                at = self.add(arg, at, backward)
            if high == ENDLESS:
                loop = self.state()
                self.free[at].append(loop)
                self.free[self.add(arg, loop, backward)].append(loop)
                at = loop
            else:
                for _ in range(high - low):
                    self.free[at].append(end)
                    at = self.add(arg, at, backward)
            self.free[at].append(end)
        return end


class Dfa:
    """``kind`` maps a byte to its class; a state is the offset of its row, so ``step[state + kind[byte]]`` is the next state,
    and ``accepts[w][state]`` has bit r if the match of rule 64 w + r may end here.

    State 0 is the start. With ``anchored`` False a match may begin at any byte; ``backward`` reads matches from their ends.
    """

    def __init__(self, patterns: list[bytes], anchored: bool = False, backward: bool = False):
        nfa = Nfa()
        start = nfa.state()
        if not anchored:
            nfa.steps[start].append((frozenset(range(256)), start))
        ends = {}
        for r, pattern in enumerate(patterns):
            first = nfa.state()
            nfa.free[start].append(first)
            ends[nfa.add(Pattern(pattern).tree, first, backward)] = r
        kinds = np.zeros((256, sum(map(len, nfa.steps))), bool)
        for k, allowed in enumerate(x[0] for s in nfa.steps for x in s):
            kinds[list(allowed), k] = True
        _, some, kind = np.unique(kinds, axis=0, return_index=True, return_inverse=True)
        closed = [self._closure(nfa, s) for s in range(len(nfa.steps))]
        after = [[0] * len(some) for _ in nfa.steps]  # by state and kind of byte: bits of the states reached
        for s, steps in enumerate(nfa.steps):
            for allowed, to in steps:
                for k, b in enumerate(some):
                    if b in allowed:
                        after[s][k] |= closed[to]
        numbers, queue, table, accepts = {closed[start]: 0}, [closed[start]], [], []
        for states in queue:  # grows while it is read
            inside = [s for s in range(len(nfa.steps)) if states >> s & 1]
            accepts.append(sum(1 << ends[s] for s in inside if s in ends))
            row = []
            for k in range(len(some)):
                to = 0
                for s in inside:
                    to |= after[s][k]
                if to not in numbers:
                    numbers[to] = len(queue)
                    queue.append(to)
                row.append(numbers[to])
            table.append(row)
        numbers = {bits: k for k, bits in enumerate(dict.fromkeys(accepts))}  # of the sets of rules
        table, kinds_of = self._minimal(np.array(table), np.array([numbers[bits] for bits in accepts]))
        accepts = [list(numbers)[k] for k in kinds_of]
        self.kind, wide = kind.ravel().astype(np.uint8), table.shape[1]
        self.step = (table * wide).astype(np.int32).ravel()
        self.rules = len(patterns)
        self.accepts = [np.repeat(np.array([bits >> 64 * w & (1 << 64) - 1 for bits in accepts], np.uint64), wide) for w in range(-(-self.rules // 64) or 1)]
        #: Bytes after which every state is the start again: no match contains one.
        self.resets = (table == 0).all(axis=0)[self.kind]
        #: Anchored: the state that no byte leaves and that accepts nothing, else -1.
        dead = np.flatnonzero((table == np.arange(len(table))[:, None]).all(axis=1) & np.array([not bits for bits in accepts]))
        self.dead = int(dead[0]) * wide if len(dead) else -1

    @staticmethod
    def _closure(nfa: Nfa, s: int) -> int:
        seen, todo = 1 << s, [s]
        while todo:
            for to in nfa.free[todo.pop()]:
                if not seen >> to & 1:
                    seen |= 1 << to
                    todo.append(to)
        return seen

    @staticmethod
    def _minimal(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States that no input tells apart are merged; the start stays state 0."""
        label = np.unique(accepts, return_inverse=True)[1].ravel()
        while True:
            finer = np.unique(np.column_stack([label, label[table]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == label.max():
                break
            label = finer
        _, some, label = np.unique(label, return_index=True, return_inverse=True)
        order = np.argsort(some, kind="stable")  # the class of state 0 comes first
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        label = rank[label.ravel()]
        some = some[order]
        return label[table[some]], accepts[some]

    def scan(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each segment (a row) the bits of all rules with a match in it, in one pass over the bytes.

        Segments go forward side by side, longest first, a byte of each at a step; the last few are finished one by one.
        """
        order = np.argsort(starts - ends, kind="stable")
        data, at, left = self.kind[data], starts[order], (ends - starts)[order]
        state, found = np.zeros(len(order), np.int32), np.zeros((len(self.accepts), len(order)), np.uint64)
        live, done = len(order), 0
        while live:
            live = int(np.searchsorted(-left, -done, side="left"))  # segments longer than what is done
            if live < 16:
                break
            state[:live] = self.step[state[:live] + data[at[:live] + done]]
            for own, accepts in zip(found, self.accepts):
                own[:live] |= accepts[state[:live]]
            done += 1
        if live:
            step, every, _ = self._lists()
        for i in range(live):
            s, bits = int(state[i]), 0
            for b in data[at[i] + done : at[i] + left[i]].tobytes():
                s = step[s + b]
                bits |= every[s]
            for w, own in enumerate(found):
                own[i] |= np.uint64(bits >> 64 * w & (1 << 64) - 1)
        out = np.zeros((len(order), len(self.accepts)), np.uint64)
        out[order] = found.T
        return out

    def ends(self, data: bytes) -> list[int]:
        """Places after which a match ends, for an automaton that isn't anchored; for one that reads backward, of the data
        read so."""
        step, accepts, _ = self._lists()
        out, s = [], 0
        for j, b in enumerate(self.kind[np.frombuffer(data, np.uint8)].tobytes(), 1):
            s = step[s + b]
            if accepts[s]:
                out.append(j)
        return out

    def longest(self, data: bytes, starts: list[int]) -> list[tuple[int, int]]:
        """Leftmost-longest matches without overlap, for an anchored automaton. ``starts`` are the places at which a match
        begins, rising, so no byte is read in vain but those after a match's last end."""
        step, accepts, dead = self._lists()
        data, out, done = self.kind[np.frombuffer(data, np.uint8)].tobytes(), [], 0
        for i in starts:
            if i < done:
                continue
            s = 0
            for j in range(i, len(data)):
                s = step[s + data[j]]
                if s == dead:
                    break
                if accepts[s]:
                    done = j + 1
            out.append((i, done))
        return out

    def _lists(self) -> tuple[list[int], list[int], int]:
        if not hasattr(self, "_made"):
            accepts = [sum(int(word[s]) << 64 * w for w, word in enumerate(self.accepts)) for s in range(len(self.step))]
            self._made = self.step.tolist(), accepts, self.dead
        return self._made
