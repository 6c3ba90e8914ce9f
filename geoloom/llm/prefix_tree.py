"""A prefix tree over ordered n-gram sets, and the search for linked sets in it.

Each set, or its known beginning, is a path of ranks of n-grams in ascending order; sets that begin
alike share the beginning of their path. A probe goes down the tree level by level, in numpy over
all branches that are still open. The overlap of the probe with a path is counted once for all sets
below it, and a branch is left as soon as what remains of the probe and of the sets below can't
bring any of them to the threshold.
"""

from __future__ import annotations

import numpy as np

#: N-grams of an edge; a longer run is cut, so that bounds are looked at in between.
EDGE = 64


class PrefixTree:
    """Sets as ascending ranks; sizes are those of whole sets, of which the ranks may be a beginning."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.order = np.array(order, np.int64)
        self.sets, self.sizes = [sets[i] for i in order], np.asarray(sizes, np.int64)[self.order]
        self.top = max((int(s[-1]) + 1 for s in self.sets if len(s)), default=0)
        alike = [0] * (len(sets) + 1)  # how far each set begins like the one in front
        for i in range(1, len(sets)):
            a, b = self.sets[i - 1], self.sets[i]
            n = min(len(a), len(b))
            differ = a[:n] != b[:n]
            alike[i] = int(differ.argmax()) if differ.any() else n
        self._grow(alike)

    def _grow(self, alike: list[int]) -> None:
        """Nodes level by level, children of a node side by side."""
        low, high, leaf, last, first_child, edges = [0], [len(self.sets)], [False], [-1], [], []
        depth, at = [0], 0
        while at < len(low):
            first_child.append(len(low))
            if not leaf[at]:
                a, d = low[at], depth[at]
                while a < high[at]:
                    b = a + 1
                    while b < high[at] and alike[b] > d:
                        b += 1
                    own = self.sets[a]
                    stop = min(alike[a + 1 : b]) if b - a > 1 else len(own)
                    end = min(stop, d + EDGE)
                    is_leaf = b - a == 1 and end == len(own)
                    # a mark that no probe holds ends each set, so no edge is without an element
                    edges.append(np.append(own[d:end], self.top) if is_leaf else own[d:end])
                    low.append(a), high.append(b), leaf.append(is_leaf), depth.append(end)
                    last.append(int(own[end - 1]) if end else -1)
                    a = b
            at += 1
        first_child.append(len(low))
        self.low, self.high, self.leaf, self.last = (np.array(x) for x in (low, high, leaf, last))
        self.children = np.array(first_child)
        lengths = np.array([0, *map(len, edges)])
        self.edge_end = np.cumsum(lengths)
        self.edge_len = lengths
        self.edges = np.concatenate(edges)
        self.least = np.array([self.sizes[a:b].min() for a, b in zip(low, high, strict=True)])
        self.most = np.array([self.sizes[a:b].max() for a, b in zip(low, high, strict=True)])

    def _reached(self, i: int, held: np.ndarray, foreign: np.ndarray, num: int, den: int) -> np.ndarray:
        """Sets behind i in the tree's order whose bound allows a link with it; for whole sets the
        bound at a leaf is the overlap itself."""
        own, size = self.sets[i], int(self.sizes[i])
        end = int(own[-1]) if len(own) else -1
        node, overlap, passed, found = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(node):
            n = self.children[node + 1] - self.children[node]
            above = np.repeat(np.arange(len(node)), n)
            kid = self.children[node][above] + np.arange(len(above)) - (np.cumsum(n) - n)[above]
            lies = (self.high[kid] > i + 1) & (foreign[self.high[kid]] > foreign[np.maximum(self.low[kid], i + 1)])
            kid, above = kid[lies], above[lies]
            if not len(kid):
                break
            length = self.edge_len[kid]
            begin = np.cumsum(length) - length
            flat = self.edges[np.repeat(self.edge_end[kid] - length - begin, length) + np.arange(int(length.sum()))]
            overlap = overlap[above] + np.add.reduceat(held[flat], begin, dtype=np.int64)
            passed = passed[above] + np.add.reduceat(flat <= end, begin, dtype=np.int64)
            left = np.minimum(size - np.searchsorted(own, self.last[kid], "right"), self.most[kid] - passed)
            may = (num + den) * (overlap + left) >= num * (size + self.least[kid])
            found.append(self.low[kid[may & self.leaf[kid]]])
            go = may & ~self.leaf[kid]
            node, overlap, passed = kid[go], overlap[go], passed[go]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def groups(self, num: int, den: int, label: np.ndarray | None = None) -> np.ndarray:
        """A label per set, in the order given: equal for sets that links join, directly or not.

        With a label from before, sets that share it are known to belong together. Branches that
        hold nothing but the probe's own group are not entered: their links would say nothing new.
        """
        group = np.arange(len(self.sets)) if label is None else np.unique(label, return_inverse=True)[1][self.order]
        held = np.zeros(self.top + 1, bool)
        for i, own in enumerate(self.sets):
            foreign = np.concatenate([[0], np.cumsum(group != group[i])])
            if foreign[-1] == foreign[i + 1]:
                continue  # all sets behind this one are of its group
            held[own] = True
            found = np.unique(group[self._reached(i, held, foreign, num, den)])
            held[own] = False
            if len(found):
                group[np.isin(group, found)] = group[i]
        out = np.empty(len(group), np.int64)
        out[self.order] = group
        return out


def ranked(sets: list[np.ndarray], class_of: np.ndarray, *, frequent_first: bool = False) -> list[np.ndarray]:
    """Sets of hashes as ascending ranks in the global order: by class, then by hash."""
    flat = np.concatenate(sets)
    grams, at = np.unique(flat, return_inverse=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.argsort(class_of[grams >> CLASS_SHIFT], kind="stable")] = np.arange(len(grams))
    ranks = (len(grams) - 1 - rank if frequent_first else rank)[at]
    ends = np.cumsum([len(s) for s in sets])
    return [np.sort(r) for r in np.split(ranks, ends[:-1])]


#: Buckets by which n-grams are counted, as a number of leading bits of their hashes: 2 MB of classes.
CLASS_BITS = 21
CLASS_SHIFT = np.uint64(64 - CLASS_BITS)


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """Half powers of two of each bucket's count; a bucket is at least as frequent as its n-grams."""
    return np.floor(2 * np.log2(np.maximum(counts, 1))).astype(np.uint8)


def prefix_lengths(size: int, num: int, den: int) -> tuple[int, int]:
    """How much of a set's beginning must be seen (probed, indexed).

    Sets whose Jaccard similarity is num / den or more share an n-gram of the first part of the
    larger and the second part of the smaller one.
    """
    return size - -(-size * num // den) + 1, size - -(-2 * size * num // (num + den)) + 1


def beginning(grams: np.ndarray, length: int, class_of: np.ndarray) -> np.ndarray:
    """The first n-grams of a sorted set in the global order."""
    return grams[np.argsort(class_of[grams >> CLASS_SHIFT], kind="stable")[:length]]
