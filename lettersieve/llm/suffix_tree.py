"""Suffix trees of integer sequences: Ukkonen construction and constant-time common extensions."""

from __future__ import annotations

import numpy as np

from lettersieve.llm.common import ships_its_code

ships_its_code(__name__)


def ukkonen(text: list[int]) -> tuple[list[int], list[int], dict[int, int]]:
    """(start, end, child) of the suffix tree of ``text``, whose last symbol must occur once.

    Node 0 is the root; the edge into node v carries text[start[v]:end[v]], leaves end at the
    end of the text. ``child[v * width + symbol]`` is the node below v whose edge begins with the
    symbol, where width is one more than the largest symbol.
    """
    n = len(text)
    width = max(text) + 1
    start, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    node, edge, length, waiting = 0, 0, 0, 0
    for at in range(n):
        symbol = text[at]
        waiting += 1
        made = 0  # the inner node of this phase that still lacks its suffix link
        while waiting:
            if not length:
                edge = at
            key = node * width + text[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(at)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = node
                    made = 0
            else:
                begin = start[below]
                span = min(end[below], at + 1) - begin
                if length >= span:  # walk down
                    edge += span
                    length -= span
                    node = below
                    continue
                if text[begin + length] == symbol:
                    length += 1
                    if made:
                        link[made] = node
                    break
                split = len(start)
                start += [begin, at]
                end += [begin + length, n]
                link += [0, 0]
                child[key] = split
                child[split * width + symbol] = split + 1
                start[below] = begin + length
                child[split * width + text[begin + length]] = below
                if made:
                    link[made] = split
                made = split
            waiting -= 1
            if node == 0 and length:
                length -= 1
                edge = at - waiting + 1
            elif node:
                node = link[node]
    return start, end, child


class Extensions:
    """Longest common extensions of the suffixes of ``text``, and the ranks of its suffixes.

    ``lce(i, j)`` is the depth of the lowest common ancestor of two leaves: the least depth
    between their visits on the Euler tour, from a sparse table of minima in constant time.
    The tour holds each inner node between two of its children, which is where it can be the
    least; leaves are visited in order of rank. ``rank`` orders the suffixes by ascending,
    ``reverse_rank`` by descending symbols; in both a suffix that ends comes first.
    """

    def __init__(self, text: list[int]):
        """``text`` holds symbols >= 1; the end mark 0 is added."""
        n = len(text)
        start, end, child = ukkonen([*text, 0])
        width = max(text, default=0) + 1
        count = len(start)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        del child
        order = np.argsort(keys, kind="stable")
        keys, below = keys[order], below[order]
        first = np.searchsorted(keys, np.arange(count + 1) * width)
        sorted_children = below.tolist()
        bounds = first.tolist()
        leaves, between = [], []
        depth = [0] * count
        stack = [(0, bounds[0])]
        while stack:
            node, i = stack.pop()
            if i > bounds[node]:
                between.append(depth[node])  # the tour is back at this node
            if i + 1 < bounds[node + 1]:
                stack.append((node, i + 1))
            low = sorted_children[i]
            reach = depth[node] + end[low] - start[low]
            if bounds[low] == bounds[low + 1]:
                leaves.append(n + 1 - reach)
            else:
                depth[low] = reach
                stack.append((low, bounds[low]))
        self.n = n
        self.rank = np.empty(n + 1, np.int64)
        self.rank[np.array(leaves)] = np.arange(n + 1)
        self.reverse_rank = self._reversed(text, sorted_children, bounds, start, end, n)
        self.levels = [np.array(between, np.int32)]
        step = 1
        while 2 * step <= len(between):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    @staticmethod
    def _reversed(text, children, bounds, start, end, n) -> np.ndarray:
        """Ranks where symbols are compared the other way round, the end mark still first."""
        symbols = [*text, 0]
        rank = np.empty(n + 1, np.int64)
        stack, seen = [(0, 0)], 0
        while stack:
            node, reach = stack.pop()
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                rank[n + 1 - reach] = seen
                seen += 1
                continue
            under = children[low:high]  # ascending: the last one pushed is visited first
            if symbols[start[under[0]]] == 0:
                under = [*under[1:], under[0]]
            stack += [(v, reach + end[v] - start[v]) for v in under]
        return rank

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extensions of suffix pairs, element by element; i and j differ, n is the empty suffix."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            here = np.flatnonzero(level == k)
            table = self.levels[k]
            found[here] = np.minimum(table[low[here]], table[high[here] - (1 << k)])
        return found
