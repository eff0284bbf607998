"""A minimal acyclic transducer from words to token ids, kept in one file that is memory-mapped.

Words share prefixes and suffixes. An arc carries how many words are passed over by taking
it; their sum along a word is the word's number, and its ids lie at that number. The file is
a header of array lengths and the arrays themselves.
"""

from __future__ import annotations

import mmap

import numpy as np

_PARTS = (("first", "<u4"), ("final", "u1"), ("keys", "<u8"), ("targets", "<u4"), ("outputs", "<u4"),
          ("starts", "<u4"), ("ids", "<u4"))


def _minimal(words: list[bytes]):
    """States of the least automaton of sorted words: for each, whether final, and its arcs."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            number = register.get(key)
            if number is None:
                number = register[key] = len(states)
                states.append(key)
            label, _ = path[-1][1][-1]
            path[-1][1][-1] = (label, number)

    before = b""
    for word in words:
        common = 0
        limit = min(len(word), len(before))
        while common < limit and word[common] == before[common]:
            common += 1
        close(common)
        for label in word[common:]:
            path[-1][1].append((label, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(0)
    states.append((path[0][0], tuple(path[0][1])))
    return states


def build(entries: dict[bytes, list[int]]) -> bytes:
    """The file for words (not empty) and their ids."""
    words = sorted(entries)
    states = _minimal(words)
    reach = []
    for final, arcs in states:
        reach.append(int(final) + sum(reach[target] for _, target in arcs))
    first, final, keys, targets, outputs = [], [], [], [], []
    for number, (ends, arcs) in enumerate(states):
        first.append(len(keys))
        final.append(ends)
        passed = int(ends)
        for label, target in arcs:
            keys.append(number << 8 | label)
            targets.append(target)
            outputs.append(passed)
            passed += reach[target]
    starts = np.cumsum([0, *(len(entries[word]) for word in words), 0])
    ids = [i for word in words for i in entries[word]]
    values = {"first": first, "final": final, "keys": keys, "targets": targets, "outputs": outputs,
              "starts": starts, "ids": ids}
    arrays = [np.asarray(values[name], dtype=kind) for name, kind in _PARTS]
    header = np.array([len(array) for array in arrays], dtype="<u8")
    parts = [header.tobytes()]
    for array in arrays:
        raw = array.tobytes()
        parts.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(parts)


class Lexicon:
    """Looks words up in a memory-mapped file; processes of a machine share its pages."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            whole = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), dtype="u1")
        lengths = whole[: 8 * len(_PARTS)].view("<u8")
        at = 8 * len(_PARTS)
        for (name, kind), length in zip(_PARTS, lengths.tolist(), strict=True):
            size = int(length) * np.dtype(kind).itemsize
            setattr(self, name, whole[at:at + size].view(kind))
            at += size + -size % 8

    @property
    def n_states(self) -> int:
        return len(self.first)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that are not in it. All words take a step at a time."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        found = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys):
            return found
        text = np.frombuffer(b"".join(words), dtype="u1")
        begins = np.cumsum(lengths) - lengths
        alive = np.flatnonzero(lengths > 0)
        state = np.full(len(alive), self.n_states - 1, dtype=np.uint64)
        number = np.zeros(len(alive), dtype=np.int64)
        step = 0
        while len(alive):
            key = state << np.uint64(8) | text[begins[alive] + step].astype(np.uint64)
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[arc] == key
            alive, arc, number = alive[on], arc[on], number[on] + self.outputs[arc[on]]
            state = self.targets[arc].astype(np.uint64)
            step += 1
            done = lengths[alive] == step
            ends = done & (self.final[state] == 1)
            found[alive[ends]] = number[ends]
            alive, state, number = alive[~done], state[~done], number[~done]
        return found

    def ids_of(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian 32-bit integers, None for words that are not in it."""
        numbers = self.numbers(words)
        inside = np.maximum(numbers, 0)
        begins, ends = (4 * self.starts[inside]).tolist(), (4 * self.starts[inside + 1]).tolist()
        raw = memoryview(self.ids).cast("B")
        return [bytes(raw[a:b]) if number >= 0 else None
                for number, a, b in zip(numbers.tolist(), begins, ends, strict=True)]
