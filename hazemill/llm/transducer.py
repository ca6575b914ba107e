"""A minimal acyclic transducer from sorted byte strings to their ordinals.

Built in one pass over the sorted strings: when the next string leaves a branch, the states of
that branch cannot grow any more and each is replaced by an equal one where the register has it.
A state counts the strings it accepts; the output of an arc is the number of strings that come
before its branch, so outputs along a string's path sum up to the string's ordinal. Outputs follow
from the states alone, so the smallest automaton is the smallest transducer too.

Arcs are three arrays sorted by (state, byte); many strings are streamed through at once.
"""

from __future__ import annotations

import io
from collections.abc import Iterable

import numpy as np


class Transducer:
    def __init__(self, arcs: np.ndarray, target: np.ndarray, output: np.ndarray, final: np.ndarray):
        """``arcs`` holds state * 256 + byte, ascending; the root is the last state."""
        self.arcs, self.target, self.output, self.final = arcs, target, output, final
        self.root = len(final) - 1

    @staticmethod
    def build(strings: Iterable[bytes]) -> Transducer:
        """From different strings in ascending order."""
        register: dict[tuple, int] = {}
        arcs: list[int] = []
        target: list[int] = []
        output: list[int] = []
        finals: list[bool] = []
        counts: list[int] = []

        def frozen(state: list) -> int:
            key = (state[0], *state[1])
            if (known := register.get(key)) is not None:
                return known
            number = register[key] = len(finals)
            running = int(state[0])
            for byte, to in state[1]:
                arcs.append(number << 8 | byte)
                target.append(to)
                output.append(running)
                running += counts[to]
            finals.append(state[0])
            counts.append(running)
            return number

        path: list[list] = [[False, []]]  # states of the last string: [final, arcs]; the last arc is on the path
        last = b""
        for string in strings:
            shared = 0
            for a, b in zip(last, string, strict=False):
                if a != b:
                    break
                shared += 1
            while len(path) > shared + 1:
                state = frozen(path.pop())
                path[-1][1].append((last[len(path) - 1], state))
            path.extend([False, []] for _ in range(len(string) - shared))
            path[-1][0] = True
            last = string
        while len(path) > 1:
            state = frozen(path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        register.clear()  # the root is a state of its own, and the last
        frozen(path[0])
        return Transducer(np.array(arcs, np.int64), np.array(target, np.int64), np.array(output, np.int64), np.array(finals, bool))

    def ordinals(self, strings: list[bytes]) -> np.ndarray:
        """The ordinal of each string, -1 for those the transducer doesn't accept."""
        sizes = np.array([len(s) for s in strings], np.int64)
        data = np.frombuffer(b"".join(strings), np.uint8)
        first = np.cumsum(sizes) - sizes
        state, found = np.full(len(strings), self.root), np.zeros(len(strings), np.int64)
        live, at = np.flatnonzero(sizes > 0), 0
        while len(live) and len(self.arcs):
            wanted = state[live] << 8 | data[first[live] + at]
            arc = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            there = self.arcs[arc] == wanted
            state[live[~there]] = -1
            live, arc = live[there], arc[there]
            state[live], at = self.target[arc], at + 1
            found[live] += self.output[arc]
            live = live[sizes[live] > at]
        state[live] = -1  # strings left over where there are no arcs
        return np.where((state >= 0) & self.final[state], found, -1)

    def string(self, ordinal: int) -> bytes:
        """The string of an ordinal."""
        state, result = self.root, bytearray()
        while ordinal or not self.final[state]:
            low, high = np.searchsorted(self.arcs, [state << 8, (state + 1) << 8])
            arc = low + np.searchsorted(self.output[low:high], ordinal, "right") - 1
            result.append(int(self.arcs[arc]) & 255)
            state, ordinal = int(self.target[arc]), ordinal - int(self.output[arc])
        return bytes(result)

    def to_bytes(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, arcs=self.arcs, target=self.target.astype(np.int32), output=self.output.astype(np.int32), final=np.packbits(self.final), states=len(self.final))
        return buffer.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        held = np.load(io.BytesIO(data))
        final = np.unpackbits(held["final"], count=int(held["states"])).astype(bool)
        return Transducer(held["arcs"], held["target"].astype(np.int64), held["output"].astype(np.int64), final)
