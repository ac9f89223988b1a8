"""A three-level n-gram trie in Elias-Fano sequences, kept in one memory map.

Level one has the words, level two the words that follow each of them, level three those that follow each pair. A level is
a rising sequence of (parent's place, word), and a rising sequence of pointers says where each parent's children begin.
A value is split into 16 low bits, stored as they are, and high bits in unary, packed, with a count of the ones before
every 64 bits; so nothing is unpacked to be searched. Every node has its count. From these follow the quantised logarithm of
its smoothed probability, and of what its own children leave to the shorter context: steps of 1 / ``STEPS`` of a power of ten.

The smoothing gives a context of count c the weight c / (c + m), m being fixed for its length.
"""

from __future__ import annotations

import mmap

import numpy as np

LOW = 16
STEPS = 4096
NONE = 65535
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_ONES8 = _BITS.sum(axis=1).astype(np.uint8)
# The place of the k-th one in a byte.
_PLACE = np.zeros((256, 8), dtype=np.int64)
for _byte in range(256):
    _own = np.flatnonzero(_BITS[_byte])
    _PLACE[_byte, : len(_own)] = _own

POWERS = 10.0 ** (-np.arange(NONE + 1) / STEPS)
POWERS[NONE] = 0.0


def quantised(share: np.ndarray) -> np.ndarray:
    """The step of a share above 0 and up to 1."""
    return np.minimum(np.rint(-np.log10(share) * STEPS), NONE - 1).astype(np.uint16)


def node_steps(
    count1: np.ndarray, count2: np.ndarray, count3: np.ndarray, parent2: np.ndarray, parent3: np.ndarray, weights: tuple[float, float]
) -> tuple[np.ndarray, ...]:
    """What words leave, pairs' probabilities, what pairs leave, and triples' probabilities, from the counts; a step each,
    ``NONE`` for a probability without a count. ``parent2`` and ``parent3`` say of which word, or pair, one is."""
    small, large = weights
    made = []
    for counts, own, weight in ((count2, count1[parent2], small), (count3, count2[parent3], large)):
        steps = np.full(len(counts), NONE, dtype=np.uint16)
        known = np.flatnonzero(counts > 0)
        steps[known] = quantised(counts[known] / (own[known] + weight))
        made.append(steps)
    return quantised(small / (count1 + small)), made[0], quantised(large / (count2 + large)), made[1]


class Arena:
    """Arrays one behind the other in an anonymous memory map."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        sizes = [(a.nbytes + 7) // 8 * 8 for a in arrays.values()]
        self.map, at = mmap.mmap(-1, max(8, sum(sizes))), 0
        self.arrays = {}
        for (name, a), size in zip(arrays.items(), sizes):
            self.map[at : at + a.nbytes] = a.tobytes()
            self.arrays[name] = np.frombuffer(self.map, dtype=a.dtype, count=len(a), offset=at)
            at += size


def elias_fano(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Low parts, packed high bits and the samples of rising values below ``universe``."""
    high = values >> LOW
    bits = np.zeros(-(-(len(values) + (universe >> LOW) + 2) // 64) * 64, dtype=bool)
    bits[high + np.arange(len(values))] = True
    packed = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.cumsum(np.bitwise_count(packed), dtype=np.uint32)
    return {"lows": (values & NONE).astype(np.uint16), "bits": packed, "ones": np.concatenate([np.zeros(1, np.uint32), ones])}


class Rising:
    """Reads a sequence."""

    def __init__(self, lows: np.ndarray, bits: np.ndarray, ones: np.ndarray) -> None:
        self.lows, self.bits, self.ones = lows, bits, ones
        self.zeros = np.arange(len(ones), dtype=np.uint32) * np.uint32(64) - ones

    def select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Where the k-th one, or zero, is, counted from 0."""
        sums = self.ones if ones else self.zeros
        word = np.searchsorted(sums, k.astype(np.uint32), "right") - 1
        bits = self.bits[word] if ones else ~self.bits[word]
        left = k - sums[word]
        parts = bits.view(np.uint8).reshape(-1, 8)
        # how many there are up to each byte, all eight sums in one multiplication
        total = ((_ONES8[parts].view(np.uint64).reshape(-1) * np.uint64(0x0101010101010101))).view(np.uint8).reshape(-1, 8)
        byte = (total <= left[:, None]).sum(axis=1)
        row = np.arange(len(k))
        left = left - np.where(byte > 0, total[row, byte - 1], 0)
        return word * 64 + byte * 8 + _PLACE[parts[row, byte], left]

    def at(self, places: np.ndarray) -> np.ndarray:
        return ((self.select(places, True) - places) << LOW) | self.lows[places].astype(np.int64)

    def find(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Places of rising ``values``, of which each is looked for from ``first`` up to ``last``; -1 where it is not there."""
        if not len(values):
            return np.zeros(0, dtype=np.int64)
        high, rest = values >> LOW, values & NONE
        new = np.concatenate([[True], high[1:] != high[:-1]])
        group, own = np.cumsum(new) - 1, high[new]
        # the elements with these high bits lie between two zeros
        ends = self.select(own, False) - own
        begins = np.where(own > 0, self.select(np.maximum(own - 1, 0), False) - (own - 1), 0)
        begin, end = np.maximum(begins[group], first), np.minimum(ends[group], last)
        stop, open_ = end.copy(), np.flatnonzero(begin < end)
        while len(open_):
            middle = (begin[open_] + end[open_]) // 2
            less = self.lows[middle] < rest[open_]
            begin[open_] = np.where(less, middle + 1, begin[open_])
            end[open_] = np.where(less, end[open_], middle)
            open_ = open_[begin[open_] < end[open_]]
        there = np.flatnonzero(begin < stop)
        there = there[self.lows[begin[there]] == rest[there]]
        places = np.full(len(values), -1, dtype=np.int64)
        places[there] = begin[there]
        return places


def group_starts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order (a word per line): which begin a new first word, and which a new pair of words."""
    first = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]) if rows.shape[1] else np.zeros(0, dtype=bool)
    pair = first | np.concatenate([[True], rows[1, 1:] != rows[1, :-1]]) if rows.shape[1] else first
    return first, pair


def first_pairs(rows: np.ndarray) -> np.ndarray:
    """The first two words of each row as one number."""
    return rows[0].astype(np.int64) << 32 | rows[1]


class Trie:
    """The n-grams of ``rows``: three lines of word numbers from 1 on, in order and different, 0 where a text has ended.

    ``counts`` says how often each occurs. ``totals`` gives the counts of words, and of pairs, of which other tries have
    a part, or all: they take the place of the sums found here.
    """

    def __init__(self, rows: np.ndarray, counts: np.ndarray, vocabulary: int, totals: dict[tuple[int, ...], int], weights: tuple[float, float]) -> None:
        self.wide = vocabulary + 1
        first, pair = group_starts(rows)
        one = np.flatnonzero(first)
        two = np.flatnonzero(pair & (rows[1] > 0))
        three = np.flatnonzero(rows[2] > 0)
        sums = lambda at: np.add.reduceat(counts, at) if len(at) else np.zeros(0, dtype=np.int64)
        count1 = sums(one)
        count2 = sums(np.flatnonzero(pair))[rows[1, pair] > 0] if rows.shape[1] else sums(two)
        parent2 = (np.cumsum(first) - 1)[two]
        parent3 = (np.cumsum(pair & (rows[1] > 0)) - 1)[three]
        arrays = {"count1": _narrow(count1), "count2": _narrow(count2), "count3": _narrow(counts[three])}
        # one level at a time is made, so that one is held unpacked
        levels = [
            lambda: (rows[0, one], self.wide),
            lambda: (parent2 * self.wide + rows[1, two], max(1, len(one)) * self.wide),
            lambda: (parent3 * self.wide + rows[2, three], max(1, len(two)) * self.wide),
            lambda: (np.searchsorted(parent2, np.arange(len(one) + 1)), len(two) + 1),
            lambda: (np.searchsorted(parent3, np.arange(len(two) + 1)), len(three) + 1),
        ]
        for k, level in enumerate(levels):
            values, universe = level()
            arrays |= {f"{k}{name}": a for name, a in elias_fano(values.astype(np.int64), universe).items()}
        self.weights = weights
        self.totals = [sorted((first_pairs(np.array(p)) if len(p) > 1 else p[0], n) for p, n in totals.items() if len(p) == k) for k in (1, 2)]
        self.held = Arena(arrays).arrays
        parts = [Rising(*(self.held[f"{k}{name}"] for name in ("lows", "bits", "ones"))) for k in range(5)]
        self.words, self.pairs, self.triples, self.below1, self.below2 = parts

    def counts(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """For rows like those of the trie: the count of each first word, of each pair and of each row, 0 for an n-gram that does not occur."""
        first, pair = group_starts(rows)
        one = np.flatnonzero(first)
        node = self.words.find(rows[0, one], np.zeros(len(one), dtype=np.int64), np.full(len(one), len(self.held["count1"])))
        count1 = _taken(self.held["count1"], node)
        two = np.flatnonzero(pair)
        child = self._children(self.pairs, self.below1, node[(np.cumsum(first) - 1)[two]], rows[1, two])
        count2 = _taken(self.held["count2"], child)
        leaf = self._children(self.triples, self.below2, child[np.cumsum(pair) - 1], rows[2])
        for counts, own, totals in ((count1, rows[0, one], self.totals[0]), (count2, first_pairs(rows[:, two]), self.totals[1])):
            if totals and len(own):
                wanted, total = np.array(totals, dtype=np.int64).T
                at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                there = own[at] == wanted
                counts[at[there]] = total[there]
        return count1, count2, _taken(self.held["count3"], leaf)

    def answers(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """For rows like those of the trie: per first word its count and what it leaves, per pair its probability and
        what it leaves, and per row its probability; a step each, ``NONE`` for an n-gram that does not occur."""
        first, pair = group_starts(rows)
        count1, count2, count3 = self.counts(rows)
        return count1, *node_steps(count1, count2, count3, (np.cumsum(first) - 1)[pair], np.cumsum(pair) - 1, self.weights)

    def _children(self, level: Rising, below: Rising, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The places of words among their parents' children, -1 for none; ``parent`` does not fall where it is known."""
        out = np.full(len(parent), -1, dtype=np.int64)
        known = np.flatnonzero((parent >= 0) & (word > 0))
        if len(known):
            own, word = parent[known], word[known]
            new = np.concatenate([[True], own[1:] != own[:-1]])
            group = np.cumsum(new) - 1
            first, last = below.at(own[new])[group], below.at(own[new] + 1)[group]
            out[known] = level.find(own * self.wide + word, first, last)
        return out


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32) if len(counts) == 0 or counts.max() < 1 << 32 else counts


def _taken(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    out = np.zeros(len(places), dtype=np.int64)
    known = places >= 0
    out[known] = values[places[known]]
    return out
