"""A minimised acceptor of a word list, and its composition with a one-edit transducer.

The acceptor is the smallest automaton without cycles that accepts the words. Every
state knows how many words it accepts, so a path spells not only a word but its place
in the sorted list.

Composed with a transducer that changes, drops or adds one letter, and with itself
again, it accepts the pairs of words that are one edit apart. Up to the edit both
copies are in one state, so the composition is enumerated per state: the edit takes the
two copies to two states, and what both accept from there ends a pair. That does not
depend on how the state was reached, so it is found once and shifted by the place of
every way into the state.
"""

import numpy as np


class Acceptor:
    """States in the order in which they were closed: successors come before a state."""

    def __init__(self, words):
        """``words``: distinct and sorted by code points."""
        self.final, self.arcs, self.count = [], [], []
        self._known, self._shared = {}, {}
        path = [[False, []]]  # open states of the last word: is it final, its arcs
        last = ""
        for word in words:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            self._close(path, last, same)
            for _ in word[same:]:
                path.append([False, []])
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        self.start = self._state(path[0])

    def _close(self, path, last, depth):
        while len(path) > depth + 1:
            state = self._state(path.pop())
            path[-1][1].append((last[len(path) - 1], state))

    def _state(self, drafted):
        final, arcs = drafted
        key = (final, *arcs)
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.final)
            place, placed = int(final), {}
            for letter, target in arcs:
                placed[letter] = (target, place)
                place += self.count[target]
            self.final.append(final)
            self.arcs.append(placed)
            self.count.append(place)
        return state

    def shared(self, left, right):
        """Places, within each of two states, of the endings that both accept."""
        known = self._shared
        waiting = [(left, right)]
        while waiting:
            pair = waiting[-1]
            if pair in known:
                waiting.pop()
                continue
            a, b = pair
            if a == b:
                every = np.arange(self.count[a], dtype=np.int64)
                known[pair] = every, every
                continue
            both = [c for c in self.arcs[a] if c in self.arcs[b]]
            open_pairs = [p for c in both if (p := (self.arcs[a][c][0], self.arcs[b][c][0])) not in known]
            if open_pairs:
                waiting.extend(open_pairs)
                continue
            known[pair] = self._gathered(a, b, both)
        return known[left, right]

    def _gathered(self, a, b, letters, before=0):
        """Shared endings of two states, first letter by first letter; ``before`` moves b's."""
        lefts, rights = [], []
        if self.final[a] and self.final[b]:
            lefts.append(ZERO)
            rights.append(ZERO + before)
        for c in letters:
            (ta, oa), (tb, ob) = self.arcs[a][c], self.arcs[b][c]
            la, lb = self._shared[ta, tb] if (ta, tb) in self._shared else self.shared(ta, tb)
            if len(la):
                lefts.append(la + oa)
                rights.append(lb + (ob + before))
        if not lefts:
            return NONE
        return (lefts[0], rights[0]) if len(lefts) == 1 else (np.concatenate(lefts), np.concatenate(rights))

    def edits(self, state):
        """Places of the pairs whose first difference is an edit in this state.

        A changed letter pairs two arcs. An added letter pairs the state with the end of
        one of its arcs; endings that begin with that letter are left out, as the same
        pair is met one letter further on.
        """
        arcs = self.arcs[state]
        letters = list(arcs)
        lefts, rights = [], []
        for i, c in enumerate(letters):
            target, place = arcs[c]
            for d in letters[i + 1 :]:
                other, further = arcs[d]
                if target == other or self.final[target] and self.final[other] or not self.arcs[target].keys().isdisjoint(self.arcs[other]):
                    a, b = self.shared(target, other)
                    if len(a):
                        lefts.append(a + place)
                        rights.append(b + further)
            after = [x for x in letters if x != c and x in self.arcs[target]]
            if after or self.final[state] and self.final[target]:
                a, b = self._gathered(state, target, after, place)
                if len(a):
                    lefts.append(a)
                    rights.append(b)
        if not lefts:
            return NONE
        return np.concatenate(lefts), np.concatenate(rights)

    def pairs(self):
        """Places of all pairs of words that are one edit apart, in pieces, each pair once."""
        ways = {self.start: [0]}
        for state in range(self.start, -1, -1):
            reached = ways.pop(state, None)
            if reached is None:
                continue
            for target, place in self.arcs[state].values():
                ways.setdefault(target, []).extend([w + place for w in reached])
            left, right = self.edits(state)
            if len(left):
                base = np.array(reached, dtype=np.int64)[:, None]
                yield (base + left[None, :]).reshape(-1), (base + right[None, :]).reshape(-1)


ZERO = np.zeros(1, dtype=np.int64)
NONE = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
