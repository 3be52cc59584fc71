"""Merging adjacent symbols, the best pair first, in many short sequences at once.

Symbols are numbers. A table says which pairs make a symbol, and at which rank. In every sequence the pair of the lowest rank is
merged, the leftmost of equal ones, until no pair is in the table. The agendas of short sequences advance together, a merge
each per round: they are rows of one matrix with the ranks of the pairs, and the best pair of a row is its leftmost
minimum. Longer sequences have an agenda of their own, a heap. Pairs are looked up in a hash table with open addresses.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

#: Sequences of up to so many symbols are merged together, in matrices as wide as the longest.
WIDTHS = (4, 8, 16, 32)
#: Rows of a matrix.
ROWS = 8192
#: Pairs of a row of symbols that are looked up at a time.
AT_ONCE = 1 << 17
#: Slots of the table of pairs for each pair, at least; spreads keys over them.
SLOTS, MIX = 4, np.uint64(0x9E3779B97F4A7C15)
#: Rank of no pair.
NONE = np.int32(2**31 - 1)


class Merges:
    """made: the symbol of each pair (left, right) and its rank. base: above all symbols that occur in pairs."""

    def __init__(self, made: dict[tuple[int, int], tuple[int, int]], base: int):
        self.base = base
        pairs = sorted((a * base + b, *x) for (a, b), x in made.items())
        self.keys = np.array([p[0] for p in pairs] or [-1], dtype=np.int64)
        self.made = np.array([p[1] for p in pairs] or [-1], dtype=np.int32)
        self.ranks = np.append(np.array([p[2] for p in pairs] or [NONE], dtype=np.int32), NONE)
        self.bits = max(4, (SLOTS * len(self.keys)).bit_length())
        # a key's place lies in its slot, or in the next one that was free; empty slots have the place of no pair
        self.slots = np.full(1 << self.bits, len(self.keys), dtype=np.int32)
        todo, at = np.arange(len(self.keys), dtype=np.int32), self.slot(self.keys)
        while len(todo):
            free = self.slots[at] == len(self.keys)
            self.slots[at[free]] = todo[free]
            lost = self.slots[at] != todo
            todo, at = todo[lost], self.next_slot(at[lost])
        self.held = np.append(self.keys, -1)[self.slots]
        self.places: dict[int, int] = {}  # for long sequences, made when one comes

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * MIX) >> np.uint64(64 - self.bits)).view(np.int64)

    def next_slot(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place in the table of a pair; the last rank's place if it is not there. Symbols below 0 make no pair."""
        keys = left.astype(np.int64) * self.base + right
        keys[(left < 0) | (right < 0)] = -1
        at = self.slot(keys)
        out, todo = self.slots[at], np.flatnonzero((self.held[at] != keys))
        at = at[todo]
        while len(todo):
            more = out[todo] != len(self.keys)  # the slot is another key's
            todo, at = todo[more], self.next_slot(at[more])
            out[todo] = self.slots[at]
            more = self.held[at] != keys[todo]
            todo, at = todo[more], at[more]
        out[keys < 0] = len(self.keys)
        return out

    def pairs_in_row(self, symbols: np.ndarray) -> np.ndarray:
        """The place of the pair that each symbol makes with the next one."""
        out = np.full(len(symbols), len(self.keys), dtype=np.int32)
        for a in range(0, len(symbols) - 1, AT_ONCE):
            z = min(a + AT_ONCE, len(symbols) - 1)
            out[a:z] = self.pair(symbols[a:z], symbols[a + 1 : z + 1])
        return out

    def together(self, symbols: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merges in all rows of a matrix of symbols (-1 behind the last) with their pairs; gives rows that are done, and their symbols."""
        rows = np.arange(len(symbols))
        while len(rows):
            if not pairs.shape[1]:
                yield rows, symbols
                return
            ranks = self.ranks[pairs]
            best = ranks.argmin(axis=1)
            more = ranks[np.arange(len(rows)), best] != NONE
            if not more.all():
                yield rows[~more], symbols[~more]
                rows, symbols, pairs, best = rows[more], symbols[more], pairs[more], best[more]
            every, width = np.arange(len(rows)), symbols.shape[1] - 1
            columns = np.arange(width)
            made = self.made[pairs[every, best]]
            symbols = np.take_along_axis(symbols, columns + (columns > best[:, None]), axis=1)
            symbols[every, best] = made
            pairs = np.take_along_axis(pairs, columns[:-1] + (columns[:-1] >= best[:, None]), axis=1)
            left = np.flatnonzero(best > 0)
            pairs[left, best[left] - 1] = self.pair(symbols[left, best[left] - 1], made[left])
            right = np.flatnonzero(best < width - 1)
            pairs[right, best[right]] = self.pair(made[right], symbols[right, best[right] + 1])

    def alone(self, symbols: list[int]) -> list[int]:
        """Merges in one sequence of any length."""
        self.places = self.places or {key: k for k, key in enumerate(self.keys.tolist())}
        n, places, ranks, made, base = len(symbols), self.places, self.ranks, self.made, self.base
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int]] = []

        def enter(i: int, j: int) -> None:
            a, b = symbols[i], symbols[j]
            if a >= 0 and b >= 0 and (k := places.get(a * base + b)) is not None:
                heapq.heappush(agenda, (int(ranks[k]), i, a * base + b, k))

        for i in range(n - 1):
            enter(i, i + 1)
        gone = [False] * n
        while agenda:
            _, i, key, k = heapq.heappop(agenda)
            j = after[i]
            if gone[i] or j < 0 or symbols[i] * base + symbols[j] != key:
                continue  # one of the two is gone, or has grown
            symbols[i], gone[j] = int(made[k]), True
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                enter(i, after[i])
            if before[i] >= 0:
                enter(before[i], i)
        return [s for s, g in zip(symbols, gone, strict=True) if not g]

    def run(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges in all sequences, which lie in a row; what is left of them, and how many symbols each has then."""
        counts = np.ones(len(starts), dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        in_row, none = self.pairs_in_row(symbols), np.int32(len(self.keys))
        low = 1
        for width in WIDTHS:
            own = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if not len(own):
                continue
            columns = np.arange(width)
            for part in np.split(own, range(ROWS, len(own), ROWS)):
                places = np.minimum(starts[part][:, None] + columns, len(symbols) - 1)
                inside = columns < sizes[part][:, None]
                pairs = np.where(inside[:, 1:], in_row[places[:, :-1]], none)
                for rows, left in self.together(np.where(inside, symbols[places], -1), pairs):
                    # behind the last symbol a row has -1; symbols of no pair are below that
                    some = left != -1
                    counts[part[rows]] = some.sum(axis=1)
                    done.append((part[rows], left[some]))
        for k in np.flatnonzero(sizes > low).tolist():
            left = self.alone(symbols[starts[k] : starts[k] + sizes[k]].tolist())
            counts[k] = len(left)
            done.append((np.array([k]), np.array(left)))
        at = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), dtype=np.int32)
        single = np.flatnonzero(sizes == 1)
        out[at[single]] = symbols[starts[single]]
        for own, left in done:  # of each sequence in turn
            n = counts[own]
            out[np.arange(len(left)) + np.repeat(at[own] - (np.cumsum(n) - n), n)] = left
        return out, counts
