"""A bidirectional FM-index over a delimited vocabulary, and search schemes with one error.

The text is ``|word|word|...|``. A pattern is a pair of intervals of suffix ranks, one in the text
and one in the reversed text, kept in step: an extension to the right is a step of the reversed
index and narrows the other interval by the number of smaller letters, and the other way round.

A word is searched in two schemes: its first half is matched exactly behind a delimiter and then
extended to the right, its second half before a delimiter and then to the left, across the other
half in both cases with exactly one replaced, inserted or deleted letter, up to the delimiter at
the other end. All patterns are extended side by side; a scheme is one loop over their letters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tallygrid.llm.suffixes import Suffixes

END, DELIMITER, FIRST = 0, 1, 2  # codes: end of the text, delimiter, letters from FIRST on


class States(NamedTuple):
    """Patterns of queries: query, letters read, intervals in the stepped and in the other index."""

    query: np.ndarray
    at: np.ndarray
    own: np.ndarray
    other: np.ndarray
    size: np.ndarray

    def some(self, mask: np.ndarray) -> States:
        return States(*(x[mask] for x in self))


def _joined(parts: list[States]) -> States:
    return States(*map(np.concatenate, zip(*parts, strict=True)))


class BidirectionalIndex:
    def __init__(self, words: list[bytes]):
        """Index different words of Latin-1 letters."""
        letters = np.frombuffer(b"".join(words), np.uint8)
        code = np.zeros(256, np.int64)
        used = np.unique(letters)
        code[used] = FIRST + np.arange(len(used))
        self.letters = FIRST + len(used)
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.begins = np.cumsum(self.sizes + 1) - self.sizes
        text = np.full(len(letters) + len(words) + 2, DELIMITER, np.int64)
        is_letter = np.ones(len(text), bool)
        is_letter[np.concatenate((self.begins - 1, [len(text) - 2, len(text) - 1]))] = False
        text[is_letter] = code[letters]
        text[-1] = END
        self.text = text
        forward = Suffixes(text)
        # Words by the rank of the suffix that begins with their delimiter.
        self.word_at = np.zeros(len(text), np.int64)
        self.word_at[forward.place[self.begins - 1]] = np.arange(len(words))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.letters))[:-1]))
        backward = Suffixes(np.append(text[-2::-1], END))
        self.seen = [self._table(text, forward.order), self._table(np.append(text[-2::-1], END), backward.order)]

    def _table(self, text: np.ndarray, order: np.ndarray) -> np.ndarray:
        """How often each code stands before the suffixes up to each rank."""
        table = np.zeros((len(text) + 1, self.letters), np.int32)
        table[np.arange(1, len(text) + 1), text[order - 1]] = 1
        return np.cumsum(table, axis=0, out=table)

    def _step(self, seen: np.ndarray, states: States, letter: np.ndarray) -> States:
        """States with one more letter each, those that occur."""
        low = seen[states.own, letter].astype(np.int64)
        size = seen[states.own + states.size, letter] - low
        there = np.flatnonzero(size > 0)
        states, letter = states.some(there), letter[there]
        smaller = self._smaller(seen, states, letter)
        return States(
            states.query, states.at + 1, self.before[letter] + low[there], states.other + smaller, size[there]
        )

    def _smaller(self, seen: np.ndarray, states: States, letter: np.ndarray) -> np.ndarray:
        """How often codes below a letter stand before the suffixes of each state."""
        if not len(letter):
            return np.zeros(0, np.int64)
        counts = seen[states.own + states.size] - seen[states.own]
        return np.where(np.arange(self.letters) < letter[:, None], counts, 0).sum(1, dtype=np.int64)

    def _scheme(self, seen: np.ndarray, patterns: np.ndarray, begins, sizes, exact) -> States:
        """Whole words one error away from patterns whose first ``exact`` letters they share."""
        n = len(begins)
        zero = np.zeros(n, np.int64)
        start, count = self.before[DELIMITER], self.before[FIRST] - self.before[DELIMITER] if self.letters > FIRST else 0
        right = States(np.arange(n), zero, zero + start, zero + start, zero + count)
        for nth in range(int(exact.max(initial=0))):
            longer = exact[right.query] > nth
            more = right.some(longer)
            more = self._step(seen, more, patterns[begins[more.query] + nth])
            right = _joined([right.some(~longer), more])
        wrong, found = [], []
        while len(right.query) or wrong:
            held = _joined(wrong) if wrong else None
            wrong = []
            if held is not None:
                whole = held.at == sizes[held.query]
                over = held.some(whole)
                found.append(self._step(seen, over, np.full(len(over.query), DELIMITER)))
                rest = held.some(~whole)
                rest = self._step(seen, rest, patterns[begins[rest.query] + rest.at])
                if len(rest.query):
                    wrong.append(rest)
            if not len(right.query):
                continue
            inside = right.at < sizes[right.query]
            place = begins[right.query] + right.at
            wanted = np.where(inside, patterns[np.where(inside, place, 0)], -1)
            low = seen[right.own]
            counts = seen[right.own + right.size] - low
            counts_letters = counts.copy()
            counts_letters[:, :FIRST] = 0
            row, letter = np.nonzero(counts_letters)
            below = (np.cumsum(counts, axis=1) - counts)[row, letter]
            after = States(
                right.query[row],
                right.at[row],
                self.before[letter] + low[row, letter],
                right.other[row] + below,
                counts[row, letter].astype(np.int64),
            )
            other = letter != wanted[row]
            # A letter like the next one can as well be inserted behind it.
            inserted = after.some(other)
            replaced = after.some(other & inside[row])
            # Of equal letters in a row the first is deleted.
            first = (right.at == exact[right.query]) | (patterns[np.maximum(place - 1, 0)] != wanted)
            deleted = right.some(inside & first)
            new = [
                inserted,
                replaced._replace(at=replaced.at + 1),
                deleted._replace(at=deleted.at + 1),
            ]
            wrong.extend(s for s in new if len(s.query))
            right = after.some(~other)
            right = right._replace(at=right.at + 1)
        if not found:
            return States(*(np.zeros(0, np.int64) for _ in range(5)))
        return _joined(found)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of numbers of words: a query, which is itself indexed, and a word one error away."""
        sizes = self.sizes[queries]
        half = sizes // 2
        upto = np.cumsum(sizes)
        begins = upto - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.begins[queries] - begins, sizes)
        patterns = np.append(self.text[at], END)
        mirrored = np.append(self.text[np.repeat(self.begins[queries] + upto - 1, sizes) - np.arange(sizes.sum())], END)
        to_right = self._scheme(self.seen[1], patterns, begins, sizes, half)
        to_left = self._scheme(self.seen[0], mirrored, begins, sizes, sizes - half)
        query = np.concatenate((to_right.query, to_left.query))
        # Ranks in the text: kept beside the steps to the right, stepped on the way to the left.
        word = self.word_at[np.concatenate((to_right.other, to_left.own))]
        pairs = np.unique(queries[query] * len(self.sizes) + word)
        return pairs // len(self.sizes), pairs % len(self.sizes)
