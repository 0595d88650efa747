"""Runs of a sequence from its tandem repeats, after Gusfield and Stoye (2004).

A sequence of numbers is named by its basic factors (ranks of all stretches of 1, 2, 4, ... numbers), which give the suffix
array and exact longest common extensions to either side. Then:

1. the Lempel-Ziv blocks are cut, and the extensions round each block border give a leftmost-covering set of squares:
   for each distinct square, its leftmost occurrence is one of a listed square or follows it by rotations;
2. in the suffix tree, walks by suffix links from the listed squares' places go from rotation to rotation and stop at
   what is marked already, which completes the vocabulary of squares;
3. the occurrences below the marked places are located and neighbours of one period merged: these are the runs.

Squares whose half is a power itself are left out from the start: no run has their period as its smallest.
Memory and time follow the length n of the sequence: n log n for naming and occurrences, n for the rest.
"""

from __future__ import annotations

import numpy as np

#: Pairs of places that are compared at once.
STEP = 1 << 18


class Factors:
    """Ranks of the stretches of 2**k numbers of a sequence, and its suffix array."""

    def __init__(self, seq: np.ndarray):
        self.seq, n = seq, len(seq)
        self.levels: list[np.ndarray] = []
        rank, width = np.unique(seq, return_inverse=True)[1].astype(np.int64), 1
        while n and rank.max() + 1 < n:
            self.levels.append(rank.astype(np.int32) if n < 1 << 31 else rank)
            after = np.zeros(n, np.int64)
            after[: max(n - width, 0)] = rank[width:] + 1
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
            width *= 2
        self.rank = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of what is equal from i and from j on; i and j differ everywhere, and what they share ends before the sequence does."""
        n, out = len(self.seq), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b, level = i + out, j + out, self.levels[k]
            inside = np.maximum(a, b) < n
            out += np.where(inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)]), 1 << k, 0)
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of what is equal up to i and up to j, both included; nothing where one is negative."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b, level = i - out - (1 << k) + 1, j - out - (1 << k) + 1, self.levels[k]
            out += np.where((np.minimum(a, b) >= 0) & (level[np.maximum(a, 0)] == level[np.maximum(b, 0)]), 1 << k, 0)
        return out


def blocks(f: Factors) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks: each is the longest stretch that also starts earlier, or one new number."""
    n = len(f.seq)
    before, after = np.full(n, -1), np.full(n, -1)
    before[f.order[1:]], after[f.order[:-1]] = f.order[:-1], f.order[1:]
    prev, nxt = before.tolist(), after.tolist()
    for i in range(n - 1, -1, -1):  # later starts are unlinked first, so the neighbours of i are the nearest earlier ones
        p, q = prev[i], nxt[i]
        if p >= 0:
            nxt[p] = q
        if q >= 0:
            prev[q] = p
    here = np.arange(n)
    longest = np.zeros(n, np.int64)
    for other in (np.array(prev), np.array(nxt)):
        has = other >= 0
        longest[has] = np.maximum(longest[has], f.forward(here[has], other[has]))
    step, starts, at = np.maximum(longest, 1).tolist(), [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    return np.array(starts, np.int64)


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, 1..size) for each owner."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1


def covering_squares(f: Factors, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of a leftmost-covering set of the squares with primitive halves.

    The right half of a leftmost square lies in two blocks at most. Either its left half lies in one block and the right
    half reaches the next border, or the left half crosses a block's start, and the period is at most that block and the next.
    """
    seq, n = f.seq, len(f.seq)
    bounds = np.append(starts, n)
    sizes = np.diff(bounds)
    found = []
    first = np.arange(len(sizes) - 1)  # left half in the block before a border
    last = np.arange(1, len(sizes))  # left half across a border
    reach = sizes[last] + np.append(sizes[2:], 0)
    for border, size, side in ((bounds[first + 1], sizes[first], -1), (bounds[last], reach, 1)):
        cuts = np.searchsorted(np.cumsum(size), np.arange(STEP, size.sum() + STEP, STEP))
        for a, b in zip(np.append(0, cuts[:-1] + 1), np.minimum(cuts, len(size) - 1) + 1):
            owner, k = _ranges(size[a:b])
            x = border[a:b][owner]
            y = x + side * k
            fits = (y >= 0) & (y < n)
            x, y, k = x[fits], y[fits], k[fits]
            same = seq[x] == seq[y]
            x, y, k = x[same], y[same], k[same]
            low, ahead = np.minimum(x, y), f.forward(x, y)
            behind = f.backward(x - 1, y - 1)
            square = ahead + behind >= k
            low, behind, k = low[square], behind[square], k[square]
            found.append(np.stack([np.maximum(low - behind, low - k + 1), k]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)
    start, k = pairs[:, _primitive(f, pairs[0], pairs[1])]
    return start, k


def _primitive(f: Factors, start: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Whether the half of each square is no power: it has no period k / d for a prime d."""
    out = np.ones(len(k), bool)
    if not len(k):
        return out
    least = np.arange(k.max() + 1)
    for p in range(2, int(k.max() ** 0.5) + 1):
        if least[p] == p:
            some = least[p * p :: p]
            some[some == np.arange(p * p, len(least), p)] = p
    rest = k.copy()
    while (at := np.flatnonzero(rest > 1)).size:
        d = least[rest[at]]
        shift = k[at] // d
        out[at] &= f.forward(start[at], start[at] + shift) < 2 * k[at] - shift
        rest[at] //= d
    return out


class Tree:
    """The suffix tree of a sequence whose last number is unique: leaves are 0..n-1 in suffix order, the root is n."""

    def __init__(self, f: Factors):
        seq, order, n = f.seq, f.order, len(f.seq)
        shared = np.append(f.forward(order[:-1], order[1:]), -1).tolist()  # of each leaf with the next one
        parent = [n] * n
        depth, lo, hi = (n - order).tolist(), list(range(n)), list(range(n))
        depth.append(0), lo.append(0), hi.append(n - 1), parent.append(-1)
        stack = [n]
        for r in range(n):
            below, l = r, shared[r]
            while depth[stack[-1]] > l and len(stack) > 1:
                v = stack.pop()
                parent[below], hi[v], below = v, r, v
            if depth[stack[-1]] < l:
                depth.append(l), lo.append(lo[below]), hi.append(0), parent.append(-1)
                stack.append(len(depth) - 1)
            parent[below] = stack[-1]
        self.n, self.parent, self.depth, self.lo, self.hi = n, parent, depth, lo, hi
        d, left, up = np.array(depth), np.array(lo), np.array(parent)
        inner = np.arange(n + 1, len(depth))
        # the link of an inner node leads to the one node of a depth less by one that spans its first suffix without the first number
        wide, keep = n + 1, np.append(n, inner)
        spans = d[keep] * wide + left[keep]
        by = np.argsort(spans)
        want = (d[inner] - 1) * wide + f.rank[order[left[inner]] + 1]
        self.link = dict(zip(inner.tolist(), keep[by][np.searchsorted(spans[by], want, "right") - 1].tolist()))
        self.size = int(seq.max()) + 1
        child = np.append(np.arange(n), inner)
        self.child = dict(zip((up[child] * self.size + seq[order[left[child]] + d[up[child]]]).tolist(), child.tolist()))


def vocabulary(f: Factors, tree: Tree, start: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, length) of every place in the tree that spells a square reached from the given ones by rotation."""
    seq, order, depth, parent, lo, link, child, size, n = f.seq.tolist(), f.order.tolist(), tree.depth, tree.parent, tree.lo, tree.link, tree.child, tree.size, tree.n
    marked: set[tuple[int, int]] = set()
    for r, m in zip(f.rank[start].tolist(), (2 * k).tolist()):
        v = r
        while depth[parent[v]] >= m:
            v = parent[v]
        while (v, m) not in marked:
            marked.add((v, m))
            i = order[lo[v]]
            u = v if depth[v] == m and v > n else parent[v]
            at = link[u] if u > n else n
            while depth[at] < m - 1:
                at = child[at * size + seq[i + 1 + depth[at]]]
            if depth[at] == m - 1:
                v = child.get(at * size + seq[i], -1)
                if v < 0:
                    break
            elif seq[order[lo[at]] + m - 1] == seq[i]:
                v = at
            else:
                break
    out = np.array(list(marked), np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def runs(seq: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs of at least two periods, by start, then period.

    seq: whole numbers from 0; the last one must occur nowhere else (a mark of the end). Marks that occur once
    may also part stretches: no run holds one.
    """
    none = np.empty((0, 3), np.int64)
    if len(seq) < 3:
        return none
    f = Factors(np.asarray(seq, np.int64))
    if not f.levels:
        return none
    start, k = covering_squares(f, blocks(f))
    if not len(k):
        return none
    tree = Tree(f)
    node, length = vocabulary(f, tree, start, k)
    low, high = np.array(tree.lo)[node], np.array(tree.hi)[node]
    owner, nth = _ranges(high - low + 1)
    at, q = f.order[low[owner] + nth - 1], length[owner] // 2
    by = np.lexsort([at, q])
    at, q = at[by], q[by]
    new = np.flatnonzero(np.append(True, (np.diff(q) != 0) | (np.diff(at) != 1)))
    last = np.append(new[1:], len(at)) - 1
    out = np.stack([at[new], at[last] - at[new] + 2 * q[new], q[new]], axis=1)
    return out[np.lexsort([out[:, 2], out[:, 0]])]
