"""Links between sets of one group, by their relations.

Two ways to skip work. An index list is cut into blocks by position: how far into its set a
token stands bounds the overlap that is still possible, for a whole block at once, so
most blocks are passed over unread. And sets are taken in an order in which neighbours
are alike: the overlaps of a set with all others follow from those of the set
before it by the lists of only those tokens in which the two differ.
"""

from __future__ import annotations

import numpy as np

PERCENT = 75
# Positions that share a block of an index list.
BLOCK_POSITIONS = 16


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """Tokens that a set of ``n`` shares at least with any set it links with."""
    return -(-PERCENT * n // 100)


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    """In any common order, linked sets share one of so many first tokens of each."""
    return n - least_overlap(n) + 1


def expand_ranges(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start : start + length] of every pair, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class SetIndex:
    """Sets that others are linked with, as index lists over numbered tokens."""

    def __init__(self, tokens: np.ndarray, owner: np.ndarray, sizes: np.ndarray, n_tokens: int, rank: np.ndarray):
        """``tokens`` of the sets, set after set; ``rank`` is a token's place in the common order."""
        self.sizes, self.n = sizes, len(sizes)
        by_token = np.argsort(tokens, kind="stable")
        self.lists = owner[by_token]
        self.starts = np.searchsorted(tokens[by_token], np.arange(n_tokens + 1))
        order = np.lexsort((rank[tokens], owner))
        first = np.cumsum(sizes) - sizes
        position = np.arange(len(tokens)) - np.repeat(first, sizes)
        inside = position < np.repeat(prefix_length(sizes), sizes)
        token, who, position = tokens[order][inside], owner[order][inside], position[inside]
        block = position // BLOCK_POSITIONS
        order = np.lexsort((block, token))
        token, self.entry, position, block = token[order], who[order], position[order], block[order]
        edge = np.ones(len(token), bool)
        edge[1:] = (token[1:] != token[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(edge)
        self.block_start = at
        self.block_size = np.diff(np.append(at, len(token)))
        # The most that a set of the block has from here on, and the smallest set.
        if len(at):
            self.block_left = np.maximum.reduceat(sizes[self.entry] - position, at)
            self.block_least = np.minimum.reduceat(sizes[self.entry], at)
        self.token_blocks = np.searchsorted(token[at], np.arange(n_tokens + 1))

    def may_link(self, ordered: np.ndarray, size: int) -> np.ndarray:
        """The sets in those blocks that a set with tokens ``ordered`` may reach the overlap in."""
        prefix = ordered[: prefix_length(size)]
        begin, count = self.token_blocks[prefix], self.token_blocks[prefix + 1] - self.token_blocks[prefix]
        blocks = expand_ranges(np.arange(len(self.block_start)), begin, count)
        left = np.repeat(size - np.arange(len(prefix)), count)
        most = np.minimum(left, self.block_left[blocks]) if len(blocks) else left
        least = self.block_least[blocks]
        reach = (100 + PERCENT) * most >= PERCENT * (size + least)
        blocks = blocks[reach]
        return np.unique(expand_ranges(self.entry, self.block_start[blocks], self.block_size[blocks]))

    def counted(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each set has."""
        found = expand_ranges(self.lists, self.starts[tokens], self.starts[tokens + 1] - self.starts[tokens])
        return np.bincount(found, minlength=self.n)


class Roots:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, members: list[int]) -> None:
        roots = {self.find(i) for i in members}
        least = min(roots)
        for r in roots:
            self.parent[r] = least


def linked(sets: list[np.ndarray], weights: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The least set that links lead to and the weight of the sets linked with, for each of ``sets``.

    Sets ``left`` are compared with sets ``right``; the two are the same or have no set in common.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    n_tokens = int(ids.max()) + 1
    frequency = np.bincount(ids, minlength=n_tokens)
    rank = np.empty(n_tokens, np.int64)
    rank[np.lexsort((np.arange(n_tokens), frequency))] = np.arange(n_tokens)
    ends = np.cumsum(sizes)
    own = [np.sort(ids[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
    index = SetIndex(
        np.concatenate([own[i] for i in right]), np.repeat(np.arange(len(right)), sizes[right]), sizes[right], n_tokens, rank
    )
    same = len(left) == len(right) and bool((left == right).all())
    links = np.zeros(len(sets), np.int64)
    roots = Roots(len(sets))
    # Sets with the same least hash are likely to be alike.
    order = sorted(left.tolist(), key=lambda i: (int(sets[i][0]), len(sets[i])))
    before, counts = None, None
    for i in order:
        mine = own[i]
        derived = False
        if before is not None and 2 * min(len(mine), len(own[before])) > max(len(mine), len(own[before])):
            extra = np.setdiff1d(mine, own[before], assume_unique=True)
            missing = np.setdiff1d(own[before], mine, assume_unique=True)
            derived = 2 * (len(extra) + len(missing)) <= len(mine)
        if derived:
            counts = counts + index.counted(extra) - index.counted(missing)
        else:
            found = index.may_link(mine[np.argsort(rank[mine])], len(mine))
            if len(found) == 0 or (same and len(found) == 1):
                continue
            counts = index.counted(mine)
        before = i
        hits = right[100 * counts >= PERCENT * (len(mine) + index.sizes - counts)]
        hits = hits[hits != i]
        if len(hits):
            roots.join([i, *hits.tolist()])
            links[i] += weights[hits].sum()
            if not same:
                links[hits] += weights[i]
    return [roots.find(i) for i in range(len(sets))], links
