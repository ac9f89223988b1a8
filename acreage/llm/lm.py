"""Language-model scoring with a trigram trie that is counted over the whole corpus.

A text is a start, its words and an end. The model interpolates trigrams, bigrams and words by the counts of their
contexts: p(w | u v) = (c(u v w) + M3 p(w | v)) / (c(u v) + M3), p(w | v) = (c(v w) + M2 p(w)) / (c(v) + M2) and
p(w) = (c(w) + 1) / (N + V + 1). A context that was not seen leaves everything to the shorter one. Every context counts
by itself, however rare; nothing depends on how large the corpus is or how it is cut.

Every place of a text begins a suffix of three words. A portion of documents keeps which place has which of its different
suffixes, and sends these, with their counts, to shards: a chunk per shard. A shard has all suffixes with its first
words. It merges its chunks into a trie and answers each chunk with the trie's counts; the answers go back to the portion, where
three neighbouring suffixes make up a token's probability. Nothing is written in between but Spark's own shuffles.

A first pass counts tokens and different words. The words that most portions have are sent by a short number. A sample gives
first words (or pairs of words) so frequent that they are dealt over the shards by the next word; the first pass counts
these exactly. What the sample finds does not change any result.

Between tasks words go by their 64-bit hashes: a vocabulary of a billion words has one chance in 37 that any two of
them share one, and would then count as the same word. ``order`` is 3 or 2; a bigram model has the last two formulas alone.

A portion has a chunk per shard. Portions and shards have a least size, and where the corpus is so large that chunks
would fall below ``CHUNK_TOKENS``, they grow with the square root of the corpus, which keeps the number of chunks in
proportion to it. A task's memory is in proportion to a portion or a shard.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import stored, text_bytes
from acreage.llm.trie import POWERS, Trie, first_pairs, group_starts, node_steps

M2, M3 = 16.0, 2.0
SHARD_TOKENS = 1_500_000
PORTION_BYTES = 6 << 20
CHUNK_TOKENS = 512
# Bytes of text per shard from which frequent first words are found; a word that makes up more than this part of a
# shard in the sample is dealt over the shards.
SAMPLE_BYTES, HEAVY = 256 << 10, 0.25
# Prefixes that a task counts in the sample before it hands them on.
SAMPLE_PREFIXES = 1 << 19
# Suffixes that a trie is asked for at a time.
SLICE = 1 << 18
# Bits of a number that may hold three words.
KEY_BITS = 63
# Words that have a number for all tasks: about how many there are, and how many of them a sample may give.
COMMON, SAMPLE_COMMON = 1 << 18, 1 << 14
# About how many bytes a token has, to turn sizes of texts into numbers of tokens.
TOKEN_BYTES = 6
# Not words, as these have no white space: the start and the end of a text.
START, END = b"\r", b"\n"

ROW = (
    "dest int, portion bigint, shard int, common binary, words binary, first binary, second binary, third binary, train binary, "
    "doc_ids array<bigint>, held array<boolean>, sizes binary, places binary"
)
ANSWER = (
    "portion bigint, shard int, doc_ids array<bigint>, held array<boolean>, sizes binary, places binary, "
    "groups binary, count1 binary, count2 binary, count3 binary"
)
COUNT = "dest int, hashes binary, portions binary, tokens bigint, heavy array<int>, heavy_n array<bigint>"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<int>": pa.list_(pa.int32())}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[t]) for n, t in (c.split() for c in text.split(", "))])


_ROW, _ANSWER, _COUNT = _schema(ROW), _schema(ANSWER), _schema(COUNT)


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T if len(values) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).reshape(-1)


def _packed_counts(values: np.ndarray) -> bytes:
    """Numbers from 0 on in as many bytes each as the largest needs; the first byte says how many."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + _packed(values.astype(f"<u{width}"))


def _unpacked_counts(data: bytes) -> np.ndarray:
    return _unpacked(data[1:], f"<u{data[0]}").astype(np.int64)


def _steps(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much more each value is than the one before it, or than 0 where a group begins."""
    before = np.concatenate([np.zeros(1, values.dtype), values[:-1]])
    before[new] = 0
    return values - before


def _summed(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The values again."""
    sums, at = np.cumsum(steps, dtype=np.int64), np.flatnonzero(new)
    return sums - np.repeat(sums[at] - steps[at], np.diff(at, append=len(steps)))


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _sequence(text: bytes) -> list[bytes]:
    return [START, *text.lower().split(), END]


@dataclass
class Shared:
    """What every task has: sizes, the hashes of common words, and the frequent first words and pairs with their counts."""

    shards: int
    portion_bytes: int
    order: int
    common: np.ndarray
    heavy: list[tuple[bytes, ...]]
    totals: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.prefixes = [tuple(_hashed(list(p)).tolist()) for p in self.heavy]


def sampled(docs: DataFrame, shards: int, share: float) -> tuple[list[bytes], list[tuple[bytes, ...]]]:
    """The most frequent words of a sample, and the words and pairs that begin very many of its suffixes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def kept() -> pa.RecordBatch:
            often = [(list(p), n) for p, n in counts.items() if n > 1 or not p]
            columns = zip(*often) if often else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.list_(pa.binary()), pa.int64()))], names=["prefix", "n"])

        for batch in batches:
            for text in batch.column(0):
                own = _sequence(text.as_py())
                counts.update(zip(own))
                counts.update(zip(own, own[1:]))
                counts[()] += len(own)
            if len(counts) > SAMPLE_PREFIXES:
                yield kept()
                counts.clear()
        yield kept()

    texts = docs.select(text_bytes().alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    counts = stored(texts.mapInArrow(count, "prefix array<binary>, n bigint").groupBy("prefix").agg(F.sum("n").alias("n")), "prefixes")
    total = counts.where(F.size("prefix") == 0).agg(F.sum("n")).first()[0] or 0
    words = counts.where((F.size("prefix") == 1) & (F.octet_length(F.col("prefix")[0]) < 256))
    common = words.orderBy(F.desc("n"), "prefix").limit(SAMPLE_COMMON).select(F.col("prefix")[0].alias("w")).collect()
    # at most two prefixes per this part of all suffixes
    least = max(8.0, total * HEAVY / shards)
    rows = counts.where((F.size("prefix") > 0) & (F.col("n") >= least)).collect() if shards > 1 else []
    return [bytes(r["w"]) for r in common], sorted(tuple(bytes(w) for w in r["prefix"]) for r in rows)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (a ^ (b + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(29))


def _portions(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list, list]]:
    """Documents of a bounded number of bytes, over the batches; a longer text is a portion of its own."""
    ids, held, texts, size = [], [], [], 0
    for batch in batches:
        for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            raw = text.as_py()
            if size and size + len(raw) > limit:
                yield ids, held, texts
                ids, held, texts, size = [], [], [], 0
            ids.append(doc)
            held.append(out)
            texts.append(raw)
            size += len(raw)
    if ids:
        yield ids, held, texts


def _ranked(columns: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The different columns in order, and which of them each column is."""
    if 3 * bits <= KEY_BITS:
        key = (columns[0].astype(np.int64) << 2 * bits) | (columns[1].astype(np.int64) << bits) | columns[2]
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        order = np.lexsort(columns[::-1])
        new = np.concatenate([[True], (columns[:, order[1:]] != columns[:, order[:-1]]).any(axis=0)])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return columns[:, order[new]], place


def _shards_of(rows: np.ndarray, hashes: np.ndarray, shared: Shared) -> np.ndarray:
    """The shard of each suffix."""
    mixed = hashes[rows[0]]
    code = lambda word: int(at) if (at := np.searchsorted(hashes, np.uint64(word))) < len(hashes) and hashes[at] == word else -1
    for size in (1, 2):
        for prefix in (p for p in shared.prefixes if len(p) == size):
            # the rows of a first word, and in them of a pair, are neighbours
            low, high = 0, rows.shape[1]
            for line, word in zip(rows, map(code, prefix)):
                low, high = low + np.searchsorted(line[low:high], word), low + np.searchsorted(line[low:high], word, "right")
            mixed[low:high] = _mixed(mixed[low:high], hashes[rows[size, low:high]])
    return (_mixed(mixed, np.uint64(7)) % np.uint64(shared.shards)).astype(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch], shared: Shared) -> Iterator[pa.RecordBatch]:
    """Per portion a chunk for each shard, and one row (shard -1) with the documents."""
    portion = TaskContext.get().partitionId() << 33
    for ids, held, texts in _portions(batches, shared.portion_bytes):
        # words are numbered as they come, and then in the order of their hashes, from 1 on
        seen: defaultdict[bytes, int] = defaultdict(count().__next__)
        parts, sizes = [], []
        for text in texts:
            own = _sequence(text)
            parts.append(np.fromiter(map(seen.__getitem__, own), np.int32, len(own)))
            sizes.append(len(own))
        del texts
        hashes, number = np.unique(_hashed(list(seen)), return_inverse=True)
        hashes = np.concatenate([np.zeros(1, dtype=np.uint64), hashes])
        number = (number + 1).astype(np.int32)
        codes, end = number[np.concatenate(parts)], number[seen[END]]
        del seen, parts
        second = np.append(codes[1:], np.int32(0))
        second[codes == end] = 0
        third = np.append(second[1:], np.int32(0))
        third[(second == 0) | (second == end)] = 0
        rows, which = _ranked(np.array([codes, second, third if shared.order > 2 else np.zeros_like(third)]), len(hashes).bit_length())
        del codes, second, third
        learned = np.repeat(~np.array(held, dtype=bool), sizes)
        train = np.bincount(which[learned], minlength=rows.shape[1])
        shard = _shards_of(rows, hashes, shared)
        order = np.argsort(shard.astype(np.int16) if shared.shards < 1 << 15 else shard, kind="stable")
        moved = np.empty(len(order), dtype=np.uint32)
        moved[order] = np.arange(len(order))
        own = {"portion": portion, "shard": -1, "doc_ids": ids, "held": held, "sizes": _packed(np.array(sizes, dtype="<u4"))}
        made = [own | {"dest": xxhash.xxh32_intdigest(str(portion)) % shared.shards, "places": _packed(moved[which])}]
        rows, train, shard = rows[:, order], train[order], shard[order]
        del which, moved, order
        at = np.searchsorted(shared.common, hashes)
        listed = np.append(shared.common, np.uint64(0))[at] == hashes
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
        for a, b in zip(cuts, cuts[1:]):
            own = rows[:, a:b]
            used, local = _used(own, len(hashes))
            kind = "<u2" if len(used) < 1 << 16 else "<u4"
            mine = {"dest": int(shard[a]), "portion": portion, "shard": int(shard[a])}
            mine["common"] = _packed(np.diff(at[used[listed[used]]], prepend=0).astype("<u4"))
            mine["words"] = _packed(np.diff(hashes[used[~listed[used]]], prepend=np.uint64(0)))
            starts = np.zeros(b - a, dtype=bool), *group_starts(local)
            mine |= {n: _packed(_steps(line, new).astype(kind)) for n, line, new in zip(("first", "second", "third"), local, starts)}
            mine["train"] = _packed(train[a:b].astype("<u4"))
            made.append(mine)
        portion += 1
        yield pa.RecordBatch.from_pylist(made, schema=_ROW)


def _used(rows: np.ndarray, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """Which numbers above 0 the rows have, and the rows with these numbered from 1 on."""
    if rows.size * 8 < numbers:
        used, local = np.unique(rows, return_inverse=True)
        none = int(used[0] == 0)
        return used[none:], (local + (1 - none)).reshape(rows.shape).astype(np.int32)
    there = np.zeros(numbers, dtype=bool)
    there[rows] = True
    there[0] = False
    return np.flatnonzero(there), np.cumsum(there, dtype=np.int32)[rows]


@dataclass
class Chunk:
    """A portion's suffixes in a shard, compressed; ``number`` says which numbers its words have in the shard."""

    portion: int
    common: bytes
    words: bytes
    parts: tuple[bytes, bytes, bytes]
    train: bytes
    number: np.ndarray | None = None

    def hashes(self, shared: Shared) -> np.ndarray:
        listed = shared.common[np.cumsum(_unpacked(self.common, "<u4"))]
        return np.sort(np.concatenate([listed, np.cumsum(_unpacked(self.words, "<u8"), dtype=np.uint64)]))

    def rows(self) -> np.ndarray:
        """The suffixes in the shard's numbers, which go by the words' hashes as the chunk's own do."""
        kind = "<u2" if len(self.number) <= 1 << 16 else "<u4"
        first, second, third = (_unpacked(p, kind) for p in self.parts)
        new = np.append(True, first[1:] > 0) if len(first) else np.zeros(0, dtype=bool)
        first, second = np.cumsum(first, dtype=np.int64), _summed(second, new)
        new[1:] |= second[1:] != second[:-1]
        return self.number[np.array([first, second, _summed(third, new)])]


def _different(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class Union:
    """The different suffixes of a shard's chunks, and how often each occurs in training texts.

    A suffix is one number. Where three words do not fit into one, ``pairs`` has all first pairs in order.
    """

    def __init__(self, bits: int, pairs: np.ndarray | None = None) -> None:
        self.bits, self.pairs = bits, pairs
        self.keys, self.counts, self.new, self.weights = np.zeros(0, np.int64), np.zeros(0, np.int64), [], []

    def key(self, rows: np.ndarray) -> np.ndarray:
        if self.pairs is not None:
            return np.searchsorted(self.pairs, first_pairs(rows)) << 32 | rows[2]
        return (rows[0] << 2 * self.bits) | (rows[1] << self.bits) | rows[2]

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        self.new.append(self.key(rows))
        self.weights.append(counts)
        # merged each time as much has come as there is, so that merging stays in proportion
        if sum(map(len, self.new)) > max(500_000, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *self.new])
        order = np.argsort(keys)
        keys, counts = keys[order], np.concatenate([self.counts, *self.weights])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts, self.new, self.weights = keys[first], np.add.reduceat(counts, first) if len(first) else counts, [], []

    def rows(self) -> np.ndarray:
        mask = (1 << (32 if self.pairs is not None else self.bits)) - 1
        if self.pairs is not None:
            pair = self.pairs[self.keys >> 32]
            return np.array([pair >> 32, pair & mask, self.keys & mask])
        return np.array([self.keys >> 2 * self.bits, self.keys >> self.bits & mask, self.keys & mask])


def _shard_answers(shard: int, chunks: list[Chunk], shared: Shared) -> Iterator[pa.RecordBatch]:
    """A trie of the chunks' training suffixes, asked once for each different suffix."""
    hashes = [c.hashes(shared) for c in chunks]
    known = _different(np.concatenate(hashes))
    for c, own in zip(chunks, hashes):
        c.number = np.concatenate([[0], np.searchsorted(known, own) + 1])
    del hashes
    bits, pairs = len(known).bit_length(), None
    if 3 * bits > KEY_BITS:
        pairs = _different(np.concatenate([_different(first_pairs(c.rows())) for c in chunks]))
    union = Union(bits, pairs)
    for c in chunks:
        union.add(c.rows(), _unpacked(c.train, "<u4").astype(np.int64))
    union.merge()
    count1, count2, count3, first, pair = _union_counts(union, known, shared)
    word, couple = (np.cumsum(x, dtype=np.int32) - 1 for x in (first, pair))
    del first, pair
    for c in chunks:
        own = c.rows()
        first, pair = group_starts(own)
        at = np.searchsorted(union.keys, union.key(own))
        one, two = word[at[first]], couple[at[pair]]
        bits = zstandard.compress(np.packbits(np.concatenate([first, pair])).tobytes(), 1)
        values = {"portion": c.portion, "shard": shard, "groups": own.shape[1].to_bytes(8, "little") + bits}
        made = count1[one], count2[two], count3[at]
        values |= {n: _packed_counts(x) for n, x in zip(("count1", "count2", "count3"), made)}
        yield pa.RecordBatch.from_pylist([values], schema=_ANSWER)


def _union_counts(union: Union, known: np.ndarray, shared: Shared) -> tuple[np.ndarray, ...]:
    """Counts in training texts by a trie, of the union's different first words, pairs and suffixes, and where the first two begin."""
    rows, seen = union.rows().astype(np.int32), union.counts > 0
    # frequent first words and pairs are in several shards: their counts are those of all
    totals, most = {}, np.append(known, np.uint64(0))
    for prefix, total in zip(shared.prefixes, shared.totals):
        words = np.array(prefix, dtype=np.uint64)
        at = np.searchsorted(known, words)
        if (most[at] == words).all():
            totals[tuple((at + 1).tolist())] = total
    trie = Trie(rows[:, seen], union.counts[seen], len(known), totals, (M2, M3))
    first, pair = group_starts(rows)
    # asked in slices that cut no first word, so that the search takes little memory
    starts = np.flatnonzero(first)
    cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, rows.shape[1], SLICE)).clip(max=len(starts) - 1))]
    found = [trie.counts(rows[:, a:b]) for a, b in zip(cuts, np.append(cuts[1:], rows.shape[1]))]
    return *(np.concatenate(x) for x in zip(*found)), first, pair


def _answers(batches: Iterator[pa.RecordBatch], shared: Shared) -> Iterator[pa.RecordBatch]:
    """A task has the chunks of one shard, which make its trie and are then answered, and portions' own rows, passed on."""
    chunks: dict[int, list[Chunk]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] < 0:
                yield pa.RecordBatch.from_pylist([{n: row.get(n) for n in _ANSWER.names}], schema=_ANSWER)
            else:
                parts = row["first"], row["second"], row["third"]
                chunks.setdefault(row["shard"], []).append(Chunk(row["portion"], row["common"], row["words"], parts, row["train"]))
    for shard in sorted(chunks):
        yield from _shard_answers(shard, chunks[shard], shared)


@dataclass
class Portion:
    """A portion's documents, and for every place of their texts what its suffix was answered."""

    ids: list
    held: list
    sizes: np.ndarray
    places: np.ndarray
    found: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def add(self, groups: bytes, count1: bytes, count2: bytes, count3: bytes) -> None:
        size = int.from_bytes(groups[:8], "little")
        bits = np.unpackbits(np.frombuffer(zstandard.decompress(groups[8:]), np.uint8), count=2 * size)
        first, pair = np.cumsum(bits[:size]) - 1, np.cumsum(bits[size:]) - 1
        one, two, three = map(_unpacked_counts, (count1, count2, count3))
        steps = node_steps(one, two, three, first[bits[size:] > 0], pair, (M2, M3))
        self.found.append((one[first], steps[0][first], steps[1][pair], steps[2][pair], steps[3]))

    def scores(self, trained: int, words: int, order: int) -> pa.RecordBatch:
        count1, back1, seen2, back2, seen3 = (np.concatenate(x)[self.places] for x in zip(*self.found))
        n = len(self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        doc = np.repeat(np.arange(n), self.sizes)
        token = np.ones(len(doc), dtype=bool)
        token[starts] = False
        at = np.flatnonzero(token)
        one = (count1[at] + 1) / (trained + words + 1)
        two = POWERS[seen2[at - 1]] + POWERS[back1[at - 1]] * one
        # the first token has no pair before it
        long = token[at - 1] & (order > 2)
        three = np.where(long, POWERS[seen3[at - 2]] + POWERS[back2[at - 2]] * two, two)
        of = doc[at]
        columns = (
            pa.array(self.ids, pa.int64()),
            pa.array(self.held, pa.bool_()),
            pa.array(np.bincount(of, minlength=n)),
            pa.array(np.bincount(of[count1[at] > 0], minlength=n)),
            pa.array(np.bincount(of, np.log10(one), n)),
            pa.array(np.bincount(of, np.log10(three), n)),
        )
        return pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def _put_together(batches: Iterator[pa.RecordBatch], trained: int, words: int, order: int) -> Iterator[pa.RecordBatch]:
    """Portion by portion: its documents come first, then the answers by shard."""
    portion = None
    for batch in batches:
        for k in range(batch.num_rows):
            row = [batch.column(c)[k].as_py() for c in range(batch.num_columns)]
            if row[1] < 0:
                if portion is not None:
                    yield portion.scores(trained, words, order)
                ids, held, sizes, places = row[2:6]
                portion = Portion(ids, held, _unpacked(sizes, "<u4").astype(np.int64), _unpacked(places, "<u4"))
            else:
                portion.add(*row[6:])
    if portion is not None:
        yield portion.scores(trained, words, order)


def _counts(batches: Iterator[pa.RecordBatch], shared: Shared) -> Iterator[pa.RecordBatch]:
    """How many tokens the task's training texts have, and how often each frequent prefix; its different words, by shard."""
    words, tokens, heavy = [], 0, Counter()
    singles, pairs = {p[0] for p in shared.heavy if len(p) == 1}, {p for p in shared.heavy if len(p) == 2}

    def rows() -> list[dict]:
        different, portions = _tallied(words)
        dest = (_mixed(different, np.uint64(7)) % np.uint64(shared.shards)).astype(np.int64)
        order = np.argsort(dest, kind="stable")
        cuts = np.searchsorted(dest[order], np.arange(shared.shards + 1))
        parts = ((k, order[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b)
        return [{"dest": k, "hashes": _packed(np.diff(different[own], prepend=np.uint64(0))), "portions": _packed_counts(portions[own])} for k, own in parts]

    for _, held, texts in _portions(batches, shared.portion_bytes):
        seen: set[bytes] = set()
        for text in (t for t, out in zip(texts, held) if not out):
            own = _sequence(text)
            tokens += len(own) - 1
            seen.update(own)
            if singles:
                heavy.update(filter(singles.__contains__, own))
            if pairs:
                heavy.update(filter(pairs.__contains__, zip(own, own[1:])))
        own = _different(_hashed(list(seen - {START})))
        words.append((own, np.ones(len(own), dtype=np.int64)))
        if sum(len(own) for own, _ in words) > 1 << 20:
            words = [_tallied(words)]
            if len(words[0][0]) > 1 << 19:
                yield pa.RecordBatch.from_pylist(rows(), schema=_COUNT)
                words = []
    found = [heavy[p if len(p) > 1 else p[0]] for p in shared.heavy]
    own = {"dest": -1, "tokens": tokens, "heavy": [k for k, n in enumerate(found) if n], "heavy_n": [n for n in found if n]}
    yield pa.RecordBatch.from_pylist([own, *rows()], schema=_COUNT)


def _tallied(words: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes, and the sums of their numbers."""
    hashes, numbers = (np.concatenate(x) for x in zip(*words)) if words else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    order = np.argsort(hashes)
    hashes = hashes[order]
    new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, dtype=np.int64)
    return hashes[new], np.add.reduceat(numbers[order], new) if len(new) else numbers


def _distinct_words(batches: Iterator[pa.RecordBatch], wanted: int) -> Iterator[pa.RecordBatch]:
    """How many different words the task's shards have, and of each shard the ``wanted`` words that most portions have."""
    words: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for shard, hashes, portions in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            own = words.setdefault(shard, [])
            own.append((np.cumsum(_unpacked(hashes.as_py(), "<u8"), dtype=np.uint64), _unpacked_counts(portions.as_py())))
            if len(own) >= 64:
                words[shard] = [_tallied(own)]
    total, often = 0, [np.zeros(0, dtype=np.uint64)]
    for own in words.values():
        hashes, portions = _tallied(own)
        total += len(hashes)
        several = np.flatnonzero(portions > 1)
        often.append(hashes[several[np.argsort(-portions[several], kind="stable")[:wanted]]])
    yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([np.concatenate(often).tobytes()], pa.binary())], names=["n", "often"])


def scores(docs: DataFrame, held: Column, order: int = 3, shard_tokens: int = SHARD_TOKENS, portion_bytes: int = PORTION_BYTES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``docs`` needs doc_id and text; ``held`` says which rows are not learned from; ``order`` is the model's, 3 or 2. A text's tokens are its words, ASCII
    letters in lower case, and an end; a null text has the end alone. Scores are log10 probabilities: ``base_score`` of
    the words by themselves, ``score`` of the model, whose n-grams' probabilities are rounded to 1 / 4096 of a power of
    ten. Repeated rows count, and are scored, each. Without training rows every token has the probability of an unseen
    word. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_bytes()) + 1)).first()[0] or 0
    tokens = size // TOKEN_BYTES
    fair = int((CHUNK_TOKENS * tokens) ** 0.5)
    shards = max(1, -(-tokens // max(shard_tokens, fair)))
    common, frequent = sampled(docs, shards, min(1.0, shards * SAMPLE_BYTES / max(1, size)))
    shared = Shared(shards, max(portion_bytes, fair * TOKEN_BYTES), order, _different(_hashed(common)), [p for p in frequent if len(p) < order])
    known = spark.sparkContext.broadcast(shared)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), held.alias("held"), text_bytes().alias("text"))

    counts = stored(rows.mapInArrow(lambda batches: _counts(batches, known.value), COUNT), "token-counts")
    trained = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    # a row per frequent prefix
    pairs = counts.where("dest < 0").select(F.explode(F.arrays_zip("heavy", "heavy_n")).alias("h"))
    sums = {r["k"]: r["n"] for r in pairs.groupBy(F.col("h.heavy").alias("k")).agg(F.sum("h.heavy_n").alias("n")).collect()}
    shared.totals = [sums.get(k, 0) for k in range(len(shared.heavy))]
    found = counts.where("dest >= 0").select("dest", "hashes", "portions").repartitionById(shards, F.col("dest"))
    found = found.mapInArrow(lambda batches: _distinct_words(batches, -(-COMMON // shards)), "n bigint, often binary").collect()
    words = sum(r["n"] for r in found)
    shared.common = _different(np.concatenate([shared.common, *(np.frombuffer(r["often"], np.uint64) for r in found)]))

    counted = spark.sparkContext.broadcast(shared)
    chunks = rows.mapInArrow(lambda batches: _blocks(batches, counted.value), ROW).repartitionById(shards, F.col("dest"))
    answers = chunks.mapInArrow(lambda batches: _answers(batches, counted.value), ANSWER)
    both = answers.repartition("portion").sortWithinPartitions("portion", "shard")
    found = both.mapInArrow(
        lambda batches: _put_together(batches, trained, words, order),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    columns = "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    return found.withColumn("train_tokens", F.lit(trained).cast("bigint")).select(*columns)


