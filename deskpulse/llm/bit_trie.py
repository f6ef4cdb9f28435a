"""Self-join of a binary trie over 64-bit codes under a Hamming error budget.

A sorted array of distinct codes is its own trie: a node is a range of codes that
share their leading bits, and a bit splits it into two ranges. Pairs of nodes are
walked together, bit by bit; a pair carries the number of bits in which its two paths
differ and is dropped when that exceeds the budget.
"""

import numpy as np

# Node pairs with at most so many code pairs are compared code by code.
LEAF = 24
# Node pairs that are expanded at once; the rest waits on a stack.
CHUNK = 1 << 16


def popcount(codes):
    return np.bitwise_count(codes)


class Forest:
    """Which codes are linked, as the smallest position of each component."""

    def __init__(self, size):
        self.root = np.arange(size)

    def link(self, left, right):
        while True:
            a, b = self.root[left], self.root[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                upper = self.root[self.root]
                if np.array_equal(upper, self.root):
                    break
                self.root = upper


def forest_of(codes, starts, bits, budget):
    """Components of each group of codes under links of at most ``budget`` bits.

    ``codes``: distinct within a group and sorted, group after group; ``starts``: where
    the groups begin; ``bits``: positions, highest first, in which codes of a group may
    differ. Returns the position of each code's root. Pairs of nodes that are in one
    component already are not walked, so a dense group takes no quadratic walk.
    """
    size = len(codes)
    forest = Forest(size)
    ends = np.append(starts[1:], size)
    ones = {}

    def ones_before(bit):
        if bit not in ones:
            counts = np.zeros(size + 1, dtype=np.int64)
            np.cumsum((codes >> np.uint64(bit)) & np.uint64(1), out=counts[1:])
            ones[bit] = counts
        return ones[bit]

    stack = [(0, np.stack([starts, ends, starts, ends]), np.zeros(len(starts), dtype=np.int8))]
    while stack:
        depth, pair, errors = stack.pop()
        if pair.shape[1] > CHUNK:
            stack.append((depth, pair[:, CHUNK:], errors[CHUNK:]))
            pair, errors = pair[:, :CHUNK], errors[:CHUNK]
        pair, errors = _unlinked(forest.root, pair, errors)
        own = pair[0] == pair[2]
        wide, tall = pair[1] - pair[0], pair[3] - pair[2]
        small = wide * tall <= LEAF
        if small.any():
            _compare(codes, forest, pair[:, small], own[small], budget)
            pair, errors, own = pair[:, ~small], errors[~small], own[~small]
        if not pair.shape[1]:
            continue
        before = ones_before(bits[depth])
        al, ah, bl, bh = pair
        am = ah - (before[ah] - before[al])
        bm = bh - (before[bh] - before[bl])
        # Equal bits cost nothing, unequal ones cost one; a node with itself is met once.
        same = np.concatenate([np.stack([al, am, bl, bm]), np.stack([am, ah, bm, bh])], axis=1)
        across = np.stack([al, am, bm, bh])
        back = np.stack([am, ah, bl, bm])[:, ~own]
        for children, spent in (
            (np.concatenate([across, back], axis=1), np.concatenate([errors, errors[~own]]) + 1),
            (same, np.concatenate([errors, errors])),
        ):
            alive = (spent <= budget) & (children[0] < children[1]) & (children[2] < children[3])
            if alive.any():
                stack.append((depth + 1, children[:, alive], spent[alive].astype(np.int8)))
    return forest.root


def _unlinked(root, pair, errors):
    """Without the pairs whose codes all belong to one component."""
    changes = np.zeros(len(root), dtype=np.int64)
    np.cumsum(root[1:] != root[:-1], out=changes[1:])
    al, ah, bl, bh = pair
    one = (
        (changes[ah - 1] == changes[al])
        & (changes[bh - 1] == changes[bl])
        & (root[al] == root[bl])
    )
    return pair[:, ~one], errors[~one]


def _compare(codes, forest, pair, own, budget):
    al, ah, bl, bh = pair
    tall = bh - bl
    count = (ah - al) * tall
    which = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    left = al[which] + place // tall[which]
    right = bl[which] + place % tall[which]
    once = ~own[which] | (left < right)
    left, right = left[once], right[once]
    near = popcount(codes[left] ^ codes[right]) <= budget
    forest.link(left[near], right[near])
