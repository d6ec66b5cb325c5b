"""A minimal acyclic transducer from byte strings to their places in the sorted list.

Built from sorted distinct keys: as soon as the next key leaves a branch, the
branch's states are final and each is replaced by an equal one if there is one
(same finality, same arcs to the same states), so the automaton is minimal
without ever being larger than its result plus one path. An arc's output is the
number of keys that sort before everything behind it, so the outputs along a
key's path add up to the key's ordinal.

``stream`` walks any number of byte ranges at once: a step reads one byte of
every range that is still alive.
"""

from __future__ import annotations

import io
from collections.abc import Iterable

import numpy as np

_FREE = -1
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    def __init__(self, final: np.ndarray, arcs: np.ndarray, target: np.ndarray, output: np.ndarray, start: int, n: int) -> None:
        """``arcs`` are state * 256 + byte; the rest goes with them, ``final`` with the states."""
        self.final, self.arcs, self.target, self.output, self.start, self.n = final, arcs, target, output, start, n
        bits = max(3, int(4 * max(len(arcs), 1) - 1).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._key = np.full(1 << bits, _FREE, np.int64)
        self._arc = np.zeros(1 << bits, np.int32)
        left, place = np.arange(len(arcs)), self._place(arcs)
        while len(left):
            free = self._key[place] == _FREE
            spot, first = np.unique(place[free], return_index=True)
            put = left[free][first]
            self._key[spot], self._arc[spot] = arcs[put], put
            stays = self._key[place] != arcs[left]
            left, place = left[stays], (place[stays] + 1) & self._mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self._shift).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Arc of every key, -1 where there is none."""
        place = self._place(keys)
        held = self._key[place]
        arc = np.where(held == keys, self._arc[place], -1)
        todo = np.flatnonzero((held != keys) & (held != _FREE))
        while len(todo):
            place[todo] = (place[todo] + 1) & self._mask
            held = self._key[place[todo]]
            hit = held == keys[todo]
            arc[todo[hit]] = self._arc[place[todo[hit]]]
            todo = todo[~hit & (held != _FREE)]
        return arc

    def stream(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray | None = None,
               before: np.ndarray | None = None) -> np.ndarray:
        """Ordinal of every range ``data[start:end]``, -1 where it is no key.

        ``states`` and ``before`` go on from where ``walk`` has been (a state of -1 has no way on).
        """
        out = np.full(len(starts), -1, np.int64)
        state = np.full(len(starts), self.start, np.int64) if states is None else states.astype(np.int64)
        total = np.zeros(len(starts), np.int64) if before is None else before.astype(np.int64)
        alive = np.flatnonzero(state >= 0)
        state, total, at, end = state[alive], total[alive], starts[alive].astype(np.int64), ends[alive].astype(np.int64)
        while len(alive):
            over = at >= end
            if over.any():
                ok = over & self.final[state]
                out[alive[ok]] = total[ok]
                go = ~over
                alive, state, total, at, end = alive[go], state[go], total[go], at[go], end[go]
                if not len(alive):
                    break
            arc = self._find(state * 256 + data[at])
            go = arc >= 0
            arc = arc[go]
            alive, state, total, at, end = alive[go], self.target[arc].astype(np.int64), total[go] + self.output[arc], at[go] + 1, end[go]
        return out

    def walk(self, prefix: bytes) -> tuple[int, int]:
        """(state, keys that sort before) after ``prefix``; (-1, 0) if no key has it."""
        state, total = self.start, 0
        for byte in prefix:
            arc = int(self._find(np.array([state * 256 + byte], np.int64))[0])
            if arc < 0:
                return -1, 0
            state, total = int(self.target[arc]), total + int(self.output[arc])
        return state, total

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, final=self.final, arcs=self.arcs, target=self.target, output=self.output, ends=np.array([self.start, self.n], np.int64))
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> Transducer:
        with np.load(io.BytesIO(raw)) as held:
            start, n = (int(x) for x in held["ends"])
            return Transducer(held["final"], held["arcs"], held["target"], held["output"], start, n)


def build(keys: Iterable[bytes]) -> Transducer:
    """The minimal transducer of distinct keys in ascending order (else ValueError)."""
    known: dict[tuple, int] = {}
    finals: list[bool] = []
    sizes: list[int] = []       # keys behind a state
    heads: list[int] = []       # arcs, flat
    targets: list[int] = []
    outputs: list[int] = []
    path: list[list] = [[False, []]]  # states of the last key that may still grow: [final, [(byte, state), ...]]
    last: bytes | None = None

    def settled(node: list) -> int:
        final, arcs = node
        same = (final, *arcs)
        state = known.get(same)
        if state is None:
            state = known[same] = len(finals)
            finals.append(final)
            size = int(final)
            for byte, child in arcs:
                heads.append(state * 256 + byte)
                targets.append(child)
                outputs.append(size)
                size += sizes[child]
            sizes.append(size)
        return state

    n = 0
    for key in keys:
        if last is not None and key <= last:
            raise ValueError("keys must be distinct and in ascending order")
        shared = 0
        if last is not None:
            most = min(len(last), len(key))
            while shared < most and last[shared] == key[shared]:
                shared += 1
            while len(path) > shared + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], settled(node)))
        path.extend([False, []] for _ in range(len(key) - shared))
        path[-1][0] = True
        last = key
        n += 1
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], settled(node)))
    start = settled(path[0])
    return Transducer(np.array(finals, bool), np.array(heads, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64), start, n)
