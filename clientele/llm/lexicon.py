"""Minimal acyclic transducer from words to lists of ids, in one flat file.

Words are compiled in byte order into the smallest automaton that accepts them:
equal suffixes share their states.  Every arc carries an integer, and the sum
along a word is its rank, which points at the word's ids.  The file is a header
and six int32 arrays, made to be memory-mapped; words are looked up many at a
time, one byte position after another.
"""

from __future__ import annotations

import numpy as np

_MAGIC = 0x4C455831
NOT_FOUND = -1


def compile_words(entries: dict[bytes, list[int]]) -> bytes:
    """The file's content for words and their ids."""
    ranked = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    reach: list[int] = []

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        found = register.get(key)
        if found is None:
            found = register[key] = len(states)
            states.append(key)
            reach.append(final + sum(reach[target] for _, target in arcs))
        return found

    # The path of the last word; each element is (final, finished arcs).
    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, arcs)))

    for word in ranked:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        last = word
    close(0)
    start = freeze(*path[0])

    arcs = []
    for state, (final, out) in enumerate(states):
        passed = int(final)
        for byte, target in out:
            arcs.append((state * 256 + byte, target, passed))
            passed += reach[target]
    table = np.array(sorted(arcs), dtype=np.int32).reshape(-1, 3)
    offsets = np.cumsum([0, *(len(entries[w]) for w in ranked)], dtype=np.int32)
    ids = np.array([i for w in ranked for i in entries[w]], dtype=np.int32)
    finals = np.array([final for final, _ in states], dtype=np.int32)
    parts = [table[:, 0], table[:, 1], table[:, 2], finals, offsets, ids]
    header = np.array([_MAGIC, start, *map(len, parts)], dtype=np.int32)
    return b"".join(np.ascontiguousarray(p, dtype=np.int32).tobytes() for p in [header, *parts])


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        self._open(np.memmap(path, dtype=np.int32, mode="r"))

    def _open(self, data: np.ndarray) -> None:
        if data[0] != _MAGIC:
            raise ValueError("not a lexicon file")
        self.start = int(data[1])
        ends = 8 + np.cumsum(data[2:8], dtype=np.int64)
        # Plain views of the mapped file; slicing a memmap object is slow.
        data = data.view(np.ndarray)
        parts = [data[a:b] for a, b in zip([8, *ends[:-1]], ends, strict=True)]
        self.keys, self.targets, self.outputs, self.finals, self.offsets, self.ids = parts

    @property
    def n_states(self) -> int:
        return len(self.finals)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, or NOT_FOUND."""
        if not words or not len(self.keys):
            hit = len(self.offsets) > 1  # only the empty word has no arcs
            return np.array([0 if hit and not w else NOT_FOUND for w in words], dtype=np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        begins = np.cumsum(lengths) - lengths
        state = np.full(len(words), self.start, dtype=np.int64)
        rank = np.zeros(len(words), dtype=np.int64)
        active = np.flatnonzero(lengths > 0)
        position = 0
        while len(active):
            key = state[active] * 256 + data[begins[active] + position]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            rank[active[~known]] = NOT_FOUND
            active, at = active[known], at[known]
            state[active] = self.targets[at]
            rank[active] += self.outputs[at]
            position += 1
            active = active[lengths[active] > position]
        rank[(rank >= 0) & (self.finals[state] == 0)] = NOT_FOUND
        return rank

    def ids_of(self, rank: int) -> np.ndarray:
        return self.ids[self.offsets[rank]:self.offsets[rank + 1]]
