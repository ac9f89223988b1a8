"""Benchmark decontamination by spaced seeds.

A seed hashes the tokens at a mask's ones and ignores those at its zeros, so it still hits where an ignored token was
replaced. Test seeds are joined to training seeds; around each hit the two texts are laid over each other, and any
stretch that starts and ends with a match and is long and similar enough is a contamination. Of those the one with most
matches is reported.

An item too short for that is found where all of it occurs word for word, and a very short one where it is the whole
document.

Words that repeat make many seeds equal. Which places of a text an item is laid at is marked rather than listed pair by
pair, and all of an item's places are compared at once, so that memory grows with the text alone.

The test items are the stated query set. Their index goes to all tasks in blocks of at most ``BLOCK_BYTES`` of text, one
block at a time; a larger benchmark takes more passes over the documents, not a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import stored, text_bytes

# Fixed masks, each of six ones. Every placement of substitutions that the rule accepts in 13 to 25 tokens leaves one of
# them whole; of a longer stretch that it accepts, one half is accepted too, so no stretch is missed.
MASKS = ("1101111", "111010000011", "1101000111", "11110101")
MIN_OVERLAP = 13
MIN_SIMILARITY = 0.8
# Items with fewer tokens than this are found only as whole documents: such phrases occur by chance.
MIN_EXACT = 5
# Text of the test items in one block; the index of a block is at most 16 times as large.
BLOCK_BYTES = 2 << 20
# Pairs of places that are compared at a time.
COMPARED = 1 << 20

HITS = "array<struct<item:int,start:int,length:int,matched:int>>"
_HIT = pa.struct([(n, pa.int32()) for n in ("item", "start", "length", "matched")])
# ASCII letters in lower case; ASCII characters that are neither letters nor digits separate tokens.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_OFFSETS = [np.flatnonzero([c == "1" for c in mask]) for mask in MASKS]
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(MIN_OVERLAP)], dtype=np.uint64)


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def _seeds(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose selected tokens are all known (not 0), and their hashes."""
    n = len(ids) - int(offsets[-1])
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    known = ids > 0
    full = np.ones(n, dtype=bool)
    for k in offsets:
        full &= known[k : k + n]
    at = np.flatnonzero(full)
    hashes = np.zeros(len(at), dtype=np.uint64)
    for k, factor in zip(offsets, _FACTORS):
        hashes = (hashes ^ (hashes >> np.uint64(29))) + ids[at + k].astype(np.uint64) * factor
    return at, hashes


def _same_hashes(own: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The text's different hashes that the index has: their places (in ``order`` from ``start``, ``count`` of them) there."""
    order = np.argsort(own, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], own[order][1:] != own[order][:-1]]))
    count = np.diff(np.append(first, len(own)))
    low, high = (np.searchsorted(hashes, own[order[first]], side) for side in ("left", "right"))
    there = high > low
    return at[order], first[there], count[there], low[there], high[there]


class Index:
    """The seeds of a block of test items."""

    def __init__(self, texts: list[bytes]) -> None:
        words = [tokens_of(t) for t in texts]
        self.vocabulary: dict[bytes, int] = {}
        for w in words:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.items = [np.array([self.vocabulary[x] for x in w], dtype=np.int32) for w in words]
        self.whole: dict[bytes, list[int]] = {}
        for k, ids in enumerate(self.items):
            if 0 < len(ids) < MIN_EXACT:
                self.whole.setdefault(ids.tobytes(), []).append(k)
        long = [k for k, ids in enumerate(self.items) if len(ids) >= MIN_OVERLAP]
        self.seeds = [(offsets, *self._sorted(long, offsets)) for offsets in _OFFSETS]
        short = {n: [k for k, ids in enumerate(self.items) if len(ids) == n] for n in range(MIN_EXACT, MIN_OVERLAP)}
        self.exact = [(np.arange(n), *self._sorted(items, np.arange(n))) for n, items in short.items() if items]

    def _sorted(self, items: list[int], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(k, *_seeds(self.items[k], offsets)) for k in items]
        item = np.concatenate([np.full(len(at), k) for k, at, _ in found] or [np.zeros(0, dtype=np.int64)])
        at = np.concatenate([at for _, at, _ in found] or [np.zeros(0, dtype=np.int64)])
        hashes = np.concatenate([h for *_, h in found] or [np.zeros(0, dtype=np.uint64)])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], item[order], at[order]

    def hits(self, text: bytes) -> list[dict[str, int]]:
        """The best contamination per item of one whole text."""
        ids = np.array(list(map(self.vocabulary.get, tokens_of(text), repeat(0))), dtype=np.int32)
        best = {}
        if 0 < len(ids) < MIN_EXACT:
            best = {k: (0, len(ids), len(ids)) for k in self.whole.get(ids.tobytes(), [])}
        for item, shifts in self._laid(ids, self.exact).items():
            own = self.items[item]
            first = next((s for s in shifts.tolist() if np.array_equal(ids[s : s + len(own)], own)), None)
            if first is not None:
                best[item] = (first, len(own), len(own))
        for item, shifts in self._laid(ids, self.seeds).items():
            found = self.best_overlap(ids, item, shifts)
            if found:
                best[item] = found
        return [{"item": k, "start": a, "length": n, "matched": m} for k, (a, n, m) in sorted(best.items())]

    def _laid(self, ids: np.ndarray, seeds: list) -> dict[int, np.ndarray]:
        """Per item the rising places of the text that it is to be laid at, as some seed agrees there."""
        listed, marked = [], {}
        for offsets, hashes, items, places in seeds:
            at, own = _seeds(ids, offsets)
            if not len(at) or not len(hashes):
                continue
            at, start, count, low, high = _same_hashes(own, at, hashes)
            times = high - low
            # few pairs are listed; where both sides repeat a seed, the places it lays an item at are marked
            few = count * times <= 8 * (count + times)
            pairs = (count * times)[few]
            k = np.repeat(np.flatnonzero(few), pairs)
            nth = np.arange(len(k)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            j = low[k] + nth % times[k]
            listed.append((items[j], at[start[k] + nth // times[k]] - places[j]))
            for k in np.flatnonzero(~few):
                there = at[start[k] : start[k] + count[k]]
                for j in range(low[k], high[k]):
                    item = int(items[j])
                    if item not in marked:
                        marked[item] = np.zeros(len(ids) + len(self.items[item]), dtype=bool)
                    marked[item][there + (len(self.items[item]) - places[j])] = True
        laid = {item: np.flatnonzero(mark) - len(self.items[item]) for item, mark in marked.items()}
        if listed:
            item, shift = (np.concatenate(x) for x in zip(*listed))
            order = np.lexsort((shift, item))
            item, shift = item[order], shift[order]
            for k, shifts in zip(*_split(item, shift)):
                laid[int(k)] = np.union1d(laid[int(k)], shifts) if int(k) in laid else _different(shifts)
        return laid

    def overlap(self, ids: np.ndarray, item: int, shift: int) -> dict[str, int] | None:
        """The best stretch where the item is laid at ``shift``."""
        found = self.best_overlap(ids, item, np.array([shift]))
        return found and dict(zip(("item", "start", "length", "matched"), (item, *found)))

    def best_overlap(self, ids: np.ndarray, item: int, shifts: np.ndarray) -> tuple[int, int, int] | None:
        """Start, length and matches of the stretch with most matches, of all that are a contamination, over all shifts.

        A stretch begins and ends with a match, and counting 10 for a match less 8 for a place, it does not lose: it is
        similar enough. Of equal ones the first is taken.
        """
        own, best = self.items[item], None
        for first in range(0, len(shifts), max(1, COMPARED // len(own))):
            rows = shifts[first : first + max(1, COMPARED // len(own))]
            at = rows[:, None] + np.arange(len(own))
            inside = (at >= 0) & (at < len(ids))
            same = inside & (ids[np.where(inside, at, 0)] == own)
            count = np.concatenate([np.zeros((len(rows), 1), dtype=np.int64), np.cumsum(same, axis=1)], axis=1)
            value = 10 * count - 8 * np.arange(len(own) + 1)
            # the lowest value of the starts so far, one row after the other on a rising line
            wide = 20 * (len(own) + 2)
            lowest = np.minimum.accumulate(np.where(same, value[:, :-1], wide // 2), axis=1)
            line = (np.arange(len(rows)) * wide)[:, None] - lowest
            row, end = np.nonzero(same)
            # for each end the first start whose value is not above its own
            start = np.searchsorted(line.reshape(-1), row * wide - value[row, end + 1]) - row * len(own)
            start = np.minimum(start, end)
            matches = np.where(end + 1 - start >= MIN_OVERLAP, count[row, end + 1] - count[row, start], 0)
            if matches.any():
                k = int(np.argmax(matches))
                if best is None or matches[k] > best[2]:
                    best = (int(rows[row[k]] + start[k]), int(end[k] + 1 - start[k]), int(matches[k]))
        return best


def _different(values: np.ndarray) -> np.ndarray:
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def _split(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different keys, which are sorted, and each one's values."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.split(values, first[1:]) if len(first) else []


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, Index]]:
    items = benchmark.select("item_id", text_bytes().alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield [r["item_id"] for r in rows], Index([bytes(r["text"]) for r in rows])


def _finder(docs: DataFrame, index: Index):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(HITS)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.hits(t.as_py()) for t in texts], pa.list_(_HIT))

    return find(text_bytes())


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``start``, ``length``, ``matched``: per document and item the longest agreement.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not read. Tokens are runs of letters
    and digits, ASCII letters in lower case; ``start`` and ``length`` count the document's tokens. Null texts have none and
    are never found. An item of fewer than ``MIN_OVERLAP`` tokens is found where all of it occurs, without substitutions, and
    one of fewer than ``MIN_EXACT`` only where it is the whole document. Repeated rows are found each. Without documents or
    items the result is empty.
    """
    result = None
    for ids, index in _blocks(benchmark):
        names = docs.sparkSession.createDataFrame([(k, i) for k, i in enumerate(ids)], f"_item int, item_id {benchmark.schema['item_id'].dataType.simpleString()}")
        found = docs.select("doc_id", F.explode(_finder(docs, index)).alias("h"))
        found = stored(found.select("doc_id", "h.*"), "contaminations")
        found = found.join(names, found["item"] == names["_item"]).select("doc_id", "item_id", "start", "length", "matched")
        result = found if result is None else result.unionByName(found)
    if result is None:
        kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
        schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start int, length int, matched int"
        return docs.sparkSession.createDataFrame([], schema)
    return result


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found; treated as by ``contaminations``."""
    for k, (_, index) in enumerate(_blocks(benchmark)):
        docs = stored(docs, "clean-so-far") if k else docs
        docs = docs.where(F.size(_finder(docs, index)) == 0)
    return docs

