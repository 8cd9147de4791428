"""A minimal acyclic transducer from words to token ids, in one file for mmap.

The automaton shares prefixes and suffixes. Each arc carries how many words of its
state come before those it leads to, so the weights along a word's path sum up to
the word's number, which finds its ids in a table.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_PARTS = (("keys", np.int64), ("targets", np.uint32), ("weights", np.uint32), ("final", np.uint8),
          ("offsets", np.uint32), ("ids", np.uint32))


class Lexicon:
    def __init__(self, **parts: np.ndarray):
        self.keys, self.targets, self.weights = parts["keys"], parts["targets"], parts["weights"]
        self.final, self.offsets, self.ids = parts["final"], parts["offsets"], parts["ids"]

    @classmethod
    def compile(cls, words: dict[bytes, Iterable[int]]) -> Lexicon:
        """From the words, added in order: whatever a new word has left behind is frozen,
        and a state equal to a frozen one is replaced by that."""
        frozen: dict[tuple, int] = {}  # (final, arcs) -> number; a state's arcs lead to lower numbers only
        order: list[tuple] = []
        path: list[list] = [[False, []]]  # the last word's states: final, [(label, target)]

        def freeze(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                state = (final, tuple(arcs))
                number = frozen.setdefault(state, len(order))
                if number == len(order):
                    order.append(state)
                path[-1][1][-1] = (path[-1][1][-1][0], number)

        last, names = b"", sorted(words)
        for word in names:
            same = next((i for i, (x, y) in enumerate(zip(last, word)) if x != y), min(len(last), len(word)))
            freeze(same)
            for label in word[same:]:
                path[-1][1].append((label, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        freeze(0)
        order.append((path[0][0], tuple(path[0][1])))  # the start is the last state

        below = []  # words that can be read from each state
        for final, arcs in order:
            below.append(final + sum(below[t] for _, t in arcs))
        keys, targets, weights = [], [], []
        for s, (final, arcs) in enumerate(order):
            before = int(final)
            for label, t in arcs:
                keys.append(s << 8 | label)
                targets.append(t)
                weights.append(before)
                before += below[t]
        ids = [list(words[w]) for w in names]
        return cls(keys=np.array(keys, np.int64), targets=np.array(targets, np.uint32),
                   weights=np.array(weights, np.uint32), final=np.array([f for f, _ in order], np.uint8),
                   offsets=np.cumsum([0, *map(len, ids)]).astype(np.uint32),
                   ids=np.array([x for w in ids for x in w], np.uint32))

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, name), kind) for name, kind in _PARTS]
        out = [np.array([len(p) for p in parts], np.int64).tobytes()]
        for p in parts:  # each part begins at a multiple of 8
            out.append(p.tobytes() + b"\0" * (-p.nbytes % 8))
        return b"".join(out)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """Mapped into memory: workers of one machine share its pages."""
        whole = np.memmap(path, np.uint8, "r")
        sizes, at, parts = whole[:8 * len(_PARTS)].view(np.int64), 8 * len(_PARTS), {}
        for (name, kind), n in zip(_PARTS, sizes):
            nbytes = int(n) * np.dtype(kind).itemsize
            parts[name] = whole[at:at + nbytes].view(kind)
            at += nbytes + -nbytes % 8
        return cls(**parts)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those it doesn't hold; all words walk a byte at a time."""
        n = len(words)
        found = np.full(n, -1, np.int64)
        if not n or not len(self.final):
            return found
        lengths = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        starts = np.cumsum(lengths) - lengths
        live, state = np.arange(n), np.full(n, len(self.final) - 1, np.int64)
        number, depth = np.zeros(n, np.int64), 0
        while len(live):
            ends = lengths[live] == depth
            done = live[ends]
            found[done] = np.where(self.final[state[ends]] > 0, number[done], -1)
            live, state = live[~ends], state[~ends]
            if not len(live) or not len(self.keys):
                break
            key = state << 8 | data[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            number[live] += self.weights[at]
            state = self.targets[at].astype(np.int64)
            depth += 1
        return found

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tobytes()
