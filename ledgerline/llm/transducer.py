"""Minimal acyclic transducers: sorted strings in, their lexicographic ordinals out.

``Builder`` takes strings in ascending order and keeps the path of the last one
open; a state that no later string can change is closed, and is the same as any
closed before with the same arcs.  So only the minimal automaton is held, never a
trie.  An arc's output is the number of strings that come before all that go
through it from its state; the outputs along a string's path add up to its ordinal.

``Walker`` holds the transducers of several keys as one table of arcs and moves
many strings through it together, a byte at a time, where they stand in the text.
"""

from __future__ import annotations

import numpy as np

#: The golden ratio in 64 bits, signed.
_MIX = np.int64(-7046029254386353131)
ARC = np.dtype([("state", "<i4"), ("byte", "u1"), ("next", "<i4"), ("out", "<i4")])


class Builder:
    def __init__(self) -> None:
        self.closed: dict[tuple, int] = {}
        self.accepts: list[int] = []  # of each closed state: how many strings go on from it
        self.final: list[bool] = []
        self.arcs: list[tuple[int, int, int, int]] = []
        self.last: bytes | None = None
        self.path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
        self.n = 0

    def _close(self, depth: int) -> None:
        """Close the open states below ``depth``."""
        while len(self.path) - 1 > depth:
            final, arcs = self.path.pop()
            key = (final[0], *arcs)
            state = self.closed.get(key)
            if state is None:
                state = self._new(final[0], arcs)
                self.closed[key] = state
            self.path[-1][1].append((self.last[len(self.path) - 1], state))

    def _new(self, final: bool, arcs: list[tuple[int, int]]) -> int:
        state, below = len(self.accepts), int(final)
        for byte, to in arcs:
            self.arcs.append((state, byte, to, below))
            below += self.accepts[to]
        self.accepts.append(below)
        self.final.append(final)
        return state

    def add(self, term: bytes) -> None:
        """The next string; strings come in strictly ascending order of bytes."""
        last, same = self.last, 0
        if last is not None:
            if term <= last:
                raise ValueError("strings must ascend")
            most = min(len(last), len(term))
            while same < most and last[same] == term[same]:
                same += 1
            self._close(same)
        for _ in range(len(term) - same):
            self.path.append(([False], []))
        self.path[-1][0][0] = True
        self.last = term
        self.n += 1

    def finish(self) -> bytes:
        """Arcs of all states, the root the last one; then the final states."""
        self._close(0)
        final, arcs_ = self.path[0]
        self._new(final[0], arcs_)
        arcs = np.array(self.arcs, ARC) if self.arcs else np.empty(0, ARC)
        head = np.array([len(arcs), len(self.accepts), self.n], "<i8")
        return head.tobytes() + arcs.tobytes() + np.packbits(np.array(self.final, bool)).tobytes()


class Walker:
    """Transducers by key: ``root`` has the first state and ``size`` the number of strings of each."""

    def __init__(self, made: dict[str, bytes]):
        self.root: dict[str, int] = {}
        self.size: dict[str, int] = {}
        parts, final, states = [], [], 0
        for key, blob in sorted(made.items()):
            n_arcs, n_states, n = np.frombuffer(blob, "<i8", 3).tolist()
            arcs = np.frombuffer(blob, ARC, n_arcs, 24)
            bits = np.frombuffer(blob, np.uint8, offset=24 + n_arcs * ARC.itemsize)
            parts.append(((arcs["state"].astype(np.int64) + states) << 8 | arcs["byte"], arcs["next"] + np.int32(states), arcs["out"]))
            final.append(np.unpackbits(bits, count=n_states).astype(bool))
            states += n_states
            self.root[key], self.size[key] = states - 1, n
        keys, to, out = (np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in range(3))
        self.final = np.concatenate(final) if final else np.empty(0, bool)
        self._fill(keys, to, out)

    def _fill(self, keys: np.ndarray, to: np.ndarray, out: np.ndarray) -> None:
        """A table of at least twice as many slots as arcs, open addressing: an arc is in the first free slot from its own on."""
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.key = np.full(1 << bits, -1, np.int64)
        self.to, self.out = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.key[slot[left]] < 0]
            self.key[slot[free]] = keys[free]  # of several, the last one gets it
            got = free[self.key[slot[free]] == keys[free]]
            self.to[slot[got]], self.out[slot[got]] = to[got], out[got]
            left = left[self.key[slot[left]] != keys[left]]
            slot[left] = slot[left] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys * _MIX >> np.int64(20) & self.mask

    def _arcs(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each arc, or one that holds none."""
        slot = self._slot(keys)
        held = self.key[slot]
        odd = np.flatnonzero((held != keys) & (held >= 0))
        while len(odd):
            slot[odd] = slot[odd] + 1 & self.mask
            held = self.key[slot[odd]]
            odd = odd[(held != keys[odd]) & (held >= 0)]
        return slot

    def ordinals(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Of the strings data[start:end], each from its root: the ordinal, or -1."""
        found = np.full(len(start), -1, np.int64)
        live = np.flatnonzero((root >= 0) & (end > start))
        at, stop, state, total = start[live], end[live], root[live].astype(np.int64), np.zeros(len(live), np.int64)
        while len(live):
            key = state << 8 | data[at]
            slot = self._arcs(key)
            known = self.key[slot] == key
            live, at, stop, total, slot = live[known], at[known] + 1, stop[known], total[known], slot[known]
            total += self.out[slot]
            state = self.to[slot].astype(np.int64)
            ended = at == stop
            good = ended & self.final[state]
            found[live[good]] = total[good]
            on = ~ended
            live, at, stop, state, total = live[on], at[on], stop[on], state[on], total[on]
        return found
