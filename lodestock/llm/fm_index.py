"""FM-index over a delimited vocabulary, and whole-word search with one error.

The text is ``w1 $ w2 $ ... wk $``, read as a ring, with ``$`` below every
letter.  A state of the search is a rank interval of the sorted rotations; one
sorted array of (letter, rank) keys gives both ends of the next interval by
binary search, for any number of states at once.  The first ``k`` ranks begin
with ``$`` and name the word that follows, so a finished search knows its word
without a suffix array.

A search reads words from right to left.  Over the words as they are it matches
the right part exactly and extends across the left part; over the reversed words
it does the mirror of it.  The two directions together are the search scheme of
one error in two parts.
"""

from __future__ import annotations

import numpy as np

Interval = tuple[np.ndarray, np.ndarray, np.ndarray]  # query, low rank, high rank


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after the other, and where each word starts (and the end)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    return flat, np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)


def sorted_rotations(text: np.ndarray) -> np.ndarray:
    """Places of the rotations of ``text`` in order, by doubling the compared length."""
    size, step = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * size + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        steps = np.r_[0, np.diff(key[order]) > 0]
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(steps)
        step *= 2
        if rank[order[-1]] == size - 1 or step >= 2 * size:
            return order


class WordIndex:
    """Rank intervals over distinct words."""

    def __init__(self, words: list[str]):
        flat, self.starts = code_points(words)
        self.letters = np.unique(flat)
        self.flat = np.searchsorted(self.letters, flat) + 1
        lengths = np.diff(self.starts)
        self.words = len(words)
        ends = self.starts[1:] + np.arange(self.words)  # places of the delimiters
        text = np.zeros(len(flat) + self.words, np.int64)
        text[np.arange(len(flat)) + np.repeat(np.arange(self.words), lengths)] = self.flat
        order = sorted_rotations(text)
        self.size, self.symbols = len(text), len(self.letters) + 1
        before = text[order - 1]
        self.keys = np.sort(before * self.size + np.arange(self.size))
        self.before = before
        self.word_of = (np.searchsorted(ends, order[: self.words]) + 1) % self.words

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Letters as the index numbers them; one past the last for letters it does not have."""
        at = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == points
        return np.where(known, at + 1, self.symbols)

    def extend(self, states: Interval, letters: np.ndarray) -> Interval:
        """States one letter further to the left; those without a word drop."""
        query, low, high = states
        base = letters * self.size
        low, high = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        alive = low < high
        return query[alive], low[alive], high[alive]

    def branch(self, states: Interval, barred: np.ndarray | None = None) -> Interval:
        """States one letter further, for every letter (but the barred one) that follows in the index.

        Narrow intervals list their letters, wide ones try the alphabet.
        """
        query, low, high = states
        width = high - low
        narrow = width <= self.symbols
        of, letter = [], []
        rows = np.flatnonzero(narrow)
        if len(rows):
            own = np.repeat(rows, width[rows])
            within = np.arange(len(own)) - np.repeat(np.cumsum(width[rows]) - width[rows], width[rows])
            pairs = np.unique(own * self.symbols + self.before[low[own] + within])
            of.append(pairs // self.symbols)
            letter.append(pairs % self.symbols)
        rows = np.flatnonzero(~narrow)
        if len(rows):
            of.append(np.repeat(rows, self.symbols - 1))
            letter.append(np.tile(np.arange(1, self.symbols), len(rows)))
        if not of:
            return query[:0], low[:0], high[:0]
        of, letter = np.concatenate(of), np.concatenate(letter)
        wanted = letter > 0
        if barred is not None:
            wanted &= letter != barred[of]
        of, letter = of[wanted], letter[wanted]
        return self.extend((query[of], low[of], high[of]), letter)

    def one_error(self, queries: np.ndarray, exact: int, change: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word): words that differ by one error left of the last ``exact`` letters.

        ``queries`` has one row of codes per query, all of one length.  ``change``
        is the word's length less the query's: 1 for an inserted, 0 for a
        replaced, -1 for a deleted letter.  A pair comes once.
        """
        count, length = queries.shape
        free = (np.arange(count), np.zeros(count, np.int64), np.full(count, self.words, np.int64))
        for place in range(length - 1, length - 1 - exact, -1):
            free = self.extend(free, queries[free[0], place])
        spent: Interval = tuple(x[:0] for x in free)
        for place in range(length - 1 - exact, -1, -1):
            if change > 0:
                spent = _both(spent, self.branch(free))
            spent = self.extend(spent, queries[spent[0], place])
            if change == 0:
                spent = _both(spent, self.branch(free, queries[free[0], place]))
            if change < 0:
                spent = _both(spent, free)
            if len(spent[0]) > 8 * count:
                spent = tuple(np.unique(np.stack(spent), axis=1))
            free = self.extend(free, queries[free[0], place])
        if change > 0:
            spent = _both(spent, self.branch(free))
        query, low, _ = self.extend(spent, np.zeros(len(spent[0]), np.int64))
        pairs = np.unique(query * self.words + self.word_of[low])
        return pairs // self.words, pairs % self.words


def _both(a: Interval, b: Interval) -> Interval:
    return tuple(np.concatenate(x) for x in zip(a, b, strict=True))
