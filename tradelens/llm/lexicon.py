"""A minimal acyclic transducer: a finite set of byte strings, each with its token ids.

Words are added in sorted order to an automaton that shares equal suffixes.
Every edge carries a number; the numbers along a word's path add up to the
word's place in the sorted list, and that place selects its ids. The compiled
arrays are one flat file that workers map into memory.
"""

from __future__ import annotations

import mmap

import numpy as np

_MAGIC = 0x1E71C0


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The file of distinct, sorted, non-empty ``words`` and their ids."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []  # of a finished state: (byte, state) pairs
    final: list[bool] = []
    counts: list[int] = []  # words from a state on

    def finish(node: list) -> int:
        key = (node[0], *node[1].items())
        state = register.get(key)
        if state is None:
            state = register[key] = len(edges)
            edges.append(tuple(node[1].items()))
            final.append(node[0])
            counts.append(node[0] + sum(counts[t] for t in node[1].values()))
        return state

    path = [[False, {}]]  # open nodes along the last word: [is final, {byte: state}]
    last = b""
    for word in words:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        while len(path) > shared + 1:
            node = path.pop()
            path[-1][1][last[len(path) - 1]] = finish(node)
        path.extend([False, {}] for _ in word[shared:])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1][last[len(path) - 1]] = finish(node)
    root = finish(path[0])

    keys, targets, outputs = [], [], []
    for state, out in enumerate(edges):
        number = int(final[state])
        for byte, target in out:  # ascending, as the words were
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(number)
            number += counts[target]
    sizes = [len(x) for x in ids]
    head = [_MAGIC, root, len(keys), len(final), len(words), sum(sizes), max(map(len, words), default=0)]
    parts = [
        np.array(head, "<i8"),
        np.array(keys, "<i8"),
        np.concatenate(([0], np.cumsum(sizes))).astype("<i8"),
        np.array(targets, "<i4"),
        np.array(outputs, "<i4"),
        np.array([i for x in ids for i in x], "<u4"),
        np.array(final, np.uint8),
    ]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon in memory-mapped form."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self._map, "<i8", 7)
        magic, self.root, edges, states, words, ids, self.longest = head.tolist()
        if magic != _MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        at = head.nbytes
        for name, kind, n in (
            ("keys", "<i8", edges),
            ("offsets", "<i8", words + 1),
            ("targets", "<i4", edges),
            ("outputs", "<i4", edges),
            ("ids", "<u4", ids),
            ("final", "u1", states),
        ):
            array = np.frombuffer(self._map, kind, n, at)
            setattr(self, name, array)
            at += array.nbytes

    def places(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The sorted place of each byte string of ``data``, or -1; all strings walk the automaton together."""
        place = np.full(len(starts), -1)
        live = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        if not len(self.keys):
            return place
        state = np.full(len(live), self.root)
        number = np.zeros(len(live), np.int64)
        depth = 0
        while len(live):
            key = state << 8 | data[starts[live] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[edge] == key
            live, edge = live[on], edge[on]
            state, number = self.targets[edge].astype(np.int64), number[on] + self.outputs[edge]
            depth += 1
            ended = lengths[live] == depth
            hit = ended & (self.final[state] == 1)
            place[live[hit]] = number[hit]
            live, state, number = live[~ended], state[~ended], number[~ended]
        return place
