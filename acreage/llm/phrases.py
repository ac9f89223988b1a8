"""Phrase mining: a multikey three-way quicksort of suffix pointers, whose equal partitions are the counts.

A suffix begins at each word and goes on for up to ``depth`` words of its piece. Quicksort splits the pointers at a pivot
word into smaller, equal and larger ones; equal ones go on to the next word, until the maximum depth. All pointers that
agree on their first d words end up in one equal partition, and its size is how often the phrase of these words occurs. A
partition below the least count is abandoned at once.

Equal suffixes of a portion of text are one pointer with a count before anything is shuffled, and a portion's pointers for a
task travel as one compressed row. Pointers are routed to tasks by their leading words: cut points taken from a sample of the suffixes divide the order of all suffixes into ranges of
about the same number. The sample only decides the balance. A cut may fall between suffixes with the same leading words, so
that even a word with a third of all rows is dealt over several tasks; the parts of such a partition, which a range knows
by its cut points, are kept whatever their size and added up afterwards.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acreage.llm.common import UPPER, stored, text_bytes
from acreage.operators.spread import lookup_join

MAX_WORDS = 3
LEAST = 10
TOP = 2000
UNKNOWN = "und"
# A phrase goes if a longer one that holds it has at least this percentage of its count.
CONTAINED = 50
# Text whose suffixes are counted together before the shuffle, and text per range; both bound a task's memory.
PORTION_BYTES = 4 << 20
ROUTE_BYTES = 3 << 20
# Every so many words of a sampled document give a cut point to choose from, and so much text is sampled per range.
STRIDE, SAMPLE_BYTES = 64, 8 << 10
# Cut points are told apart by this many bytes of a word.
CUT_BYTES = 64
# Shares of a language that are ranked before its best are.
SHARES = 64

# Separators of pieces become line feeds and tabs become spaces; ASCII letters are in lower case.
_PLAIN = bytes(
    10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if chr(c) in UPPER else c for c in range(256)
)
SUFFIXES = "route int, lang string, phrases binary, sizes binary, counts binary"
_KINDS = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
COUNTS = "lang string, words int, phrase string, n bigint"


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words in order; a line feed stands between pieces and between texts, and an empty string means nothing."""
    return b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")


def _numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words in byte order and the texts as their places from 1 on; 0 ends a piece."""
    flat = tokens(texts)
    words = sorted(set(flat) - {b"", b"\n"})
    place = {w: k for k, w in enumerate(words, 1)}
    place[b"\n"], place[b""] = 0, -1
    codes = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
    return words, codes[codes >= 0]


def distinct_suffixes(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The different suffixes in order, a row per place in the suffix, and how often each occurs."""
    ends = np.concatenate([codes, np.zeros(depth, dtype=np.int64)])
    heads = np.flatnonzero(codes > 0)
    columns = [ends[heads]]
    for d in range(1, depth):
        columns.append(np.where(columns[-1] > 0, ends[heads + d], 0))
    bits = int(codes.max(initial=0)).bit_length()
    if bits * depth <= 63:
        key = columns[0]
        for column in columns[1:]:
            key = key << bits | column
        key, counts = np.unique(key, return_counts=True)
        mask = (1 << bits) - 1
        return np.array([key >> bits * (depth - 1 - d) & mask for d in range(depth)]).reshape(depth, len(key)), counts
    order = np.lexsort(columns[::-1])
    rows = np.array(columns)[:, order]
    first = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)]))
    return rows[:, first], np.diff(np.append(first, rows.shape[1]))


def _cut_place(words: list[bytes], rows: np.ndarray, cut: tuple[bytes, ...]) -> int:
    """How many of the ordered suffixes come before the cut point."""
    low, high = 0, rows.shape[1]
    for word, column in zip(cut, rows):
        at = bisect_left(words, word)
        own = column[low:high]
        if at == len(words) or words[at] != word:
            return low + int(np.searchsorted(own, at + 1))
        low, high = low + int(np.searchsorted(own, at + 1)), low + int(np.searchsorted(own, at + 2))
    return low


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, a bounded number of bytes at a time; a longer text is a portion of its own."""
    held, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_py()
            if size and size + len(raw) > PORTION_BYTES:
                yield held
                held, size = {}, 0
            held.setdefault(lang, []).append(raw)
            size += len(raw)
    if held:
        yield held


def _routed(batches: Iterator[pa.RecordBatch], cuts: list[tuple[str, tuple[bytes, ...]]], depth: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SUFFIXES.split(", ")]
    for portion in _portions(batches):
        for lang, texts in portion.items():
            words, codes = _numbered(texts)
            rows, counts = distinct_suffixes(codes, depth)
            if not len(counts):
                continue
            base = bisect_left(cuts, (lang, ()))
            own = [c for _, c in cuts[base : bisect_left(cuts, (lang + "\0", ()))]]
            places = [_cut_place(words, rows, c) for c in own]
            route = base + np.searchsorted(np.array(places, dtype=np.int64), np.arange(len(counts)), "right")
            written = pa.array([b"", *words], pa.binary())
            columns = [written.take(pa.array(r)) for r in rows]
            phrase = compute.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))
            offsets = np.frombuffer(phrase.buffers()[1], np.int32)[phrase.offset :]
            data, packer = memoryview(phrase.buffers()[2] or b""), zstandard.ZstdCompressor(level=1)
            sizes, counts = np.diff(offsets[: len(counts) + 1]).astype("<u4"), counts.astype("<u4")
            first = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
            made = []
            for a, b in zip(first, [*first[1:], len(route)]):
                parts = data[offsets[a] : offsets[b]], sizes[a:b].tobytes(), counts[a:b].tobytes()
                made.append((int(route[a]), lang, *(packer.compress(x) for x in parts)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _KINDS)], names=names)


def equal_partitions(keys: np.ndarray, counts: np.ndarray, least: int, level: np.ndarray, seed: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to the columns of ``keys``: depth, a pointer, and sum of ``counts``.

    Yields the equal partitions of every depth with a sum of ``least`` or more, and those with a pointer whose ``level``
    is at least the depth; all others are abandoned as soon as they are that small. All partitions of a round are split at
    the same time, each at the word that one of its pointers, taken at random, has at its depth.
    """
    depths, order = keys.shape[0], np.arange(keys.shape[1], dtype=np.int32)
    sizes, depth = np.array([len(order)]) if len(order) else np.zeros(0, np.int64), np.zeros(1, dtype=np.int64)
    random = np.random.default_rng(seed)
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        word = keys[depth[part], order]
        pivot = word[starts + (random.random(len(sizes)) * sizes).astype(np.int64)][part]
        # 0 for smaller, 1 for equal, 2 for larger
        side = (word >= pivot).astype(np.int8) + (word > pivot)
        slot = part * 3 + side
        sizes = np.bincount(slot, minlength=3 * len(sizes))
        # each pointer goes behind the earlier ones of its new partition
        to, first = np.empty(len(order), dtype=np.int32), np.cumsum(sizes) - sizes
        for s in range(3):
            at = np.flatnonzero(side == s)
            own = slot[at]
            run = np.cumsum(sizes[s::3]) - sizes[s::3]
            to[at] = first[own] + np.arange(len(at)) - run[own // 3]
        sorted_ = np.empty_like(order)
        sorted_[to] = order
        order = sorted_
        depth = np.repeat(depth, 3) + np.tile([0, 1, 0], len(depth))
        equal = np.tile([False, True, False], len(sizes) // 3)
        there = np.flatnonzero(sizes)
        total, top = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
        total[there] = np.add.reduceat(counts[order], first[there])
        top[there] = np.maximum.reduceat(level[order], first[there])
        found = equal & (sizes > 0) & ((total >= least) | (top >= depth))
        for d in np.unique(depth[found]):
            at = np.flatnonzero(found & (depth == d))
            yield int(d), order[first[at]], total[at]
        going = (sizes > 0) & (depth < depths) & ((total >= least) | (top > depth))
        order = order[np.repeat(going, sizes)]
        sizes, depth = sizes[going], depth[going]


def _places(values: pa.Array, wanted: list) -> list[int]:
    """Where each wanted value stands among the values, -1 where it does not."""
    found = compute.index_in(pa.array(wanted, values.type), value_set=values)
    return [-1 if k is None else k for k in found.to_pylist()]


def _levels(keys: np.ndarray, words: pa.Array, langs: pa.Array, cuts: list[tuple[str, tuple[bytes, ...]]]) -> np.ndarray:
    """On how many leading words, the language being the first, each suffix agrees with one of the cut points."""
    level = np.zeros(keys.shape[1], dtype=np.int8)
    for lang, cut in cuts:
        same = keys[0] == _places(langs, [lang])[0]
        level = np.maximum(level, same)
        for d, place in enumerate(_places(words, list(cut)), 1):
            same = same & (keys[d] == place)
            level = np.maximum(level, np.where(same, d + 1, 0).astype(np.int8))
    return level


def _route_counts(route: int, rows: list[tuple], cuts: list, depth: int, least: int) -> Iterator[pa.RecordBatch]:
    unpack, arrays, weights, sizes = zstandard.ZstdDecompressor().decompress, [], [], []
    for _, phrases, lengths, counts in rows:
        size = np.frombuffer(unpack(lengths), "<u4")
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        arrays.append(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(unpack(phrases))]))
        weights.append(np.frombuffer(unpack(counts), "<u4"))
        sizes.append(len(size))
    parts = compute.split_pattern(pa.concat_arrays(arrays), pattern=" ").flatten().dictionary_encode()
    langs = pa.array([r[0] for r in rows], pa.string()).take(pa.array(np.repeat(np.arange(len(rows)), sizes))).dictionary_encode()
    counts, words, names = np.concatenate(weights).astype(np.int64), parts.dictionary, langs.dictionary
    del arrays, weights
    keys = np.concatenate([np.asarray(langs.indices)[None, :], np.asarray(parts.indices).reshape(-1, depth).T])
    del parts, langs
    level = _levels(keys, words, names, cuts[max(0, route - 1) : route + 1])
    (end,) = _places(words, [b""])
    # the suffixes' languages are their first words: a language's partition has all of its words
    for d, at, total in equal_partitions(keys, counts, least, level):
        whole = keys[d - 1, at] != end if d > 1 else np.ones(len(at), dtype=bool)
        at, total = at[whole], total[whole]
        columns = [words.take(pa.array(k)) for k in keys[1:d, at]] or [pa.array([b""] * len(at), pa.binary())]
        phrase = compute.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())).cast(pa.string())
        made = names.take(pa.array(keys[0, at])), pa.array(np.full(len(at), d - 1, dtype=np.int32)), phrase, pa.array(total)
        yield pa.RecordBatch.from_arrays(list(made), names=[c.split()[0] for c in COUNTS.split(", ")])


def _counted(batches: Iterator[pa.RecordBatch], cuts: list, depth: int, least: int) -> Iterator[pa.RecordBatch]:
    """The suffixes of a task, which are those of one range."""
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        for route, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
            held.setdefault(route, []).append(tuple(row))
    for route in sorted(held):
        yield from _route_counts(route, held[route], cuts, depth, least)


def _points(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    for portion in _portions(batches):
        for lang, texts in portion.items():
            flat = [t[:CUT_BYTES] for t in tokens(texts) if t]
            heads = [k for k in range(STRIDE // 2, len(flat), STRIDE) if flat[k] != b"\n"]
            found = set()
            for k in heads:
                own = flat[k : k + depth]
                found.add(tuple(own[: own.index(b"\n")] if b"\n" in own else own))
            rows = pa.array([lang] * len(found), pa.string()), pa.array([list(p) for p in found], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(list(rows), names=["lang", "words"])


def cut_points(texts: DataFrame, depth: int, route_bytes: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """The first suffix of every range but the first, in order; there are at most as many as ranges."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = max(-(-size // route_bytes), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, routes * SAMPLE_BYTES / max(1, size))
    sampled = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    # a bounded number of points per range
    points = sampled.mapInArrow(lambda rows: _points(rows, depth), "lang string, words array<binary>").distinct().collect()
    ordered = sorted((r["lang"], tuple(bytes(w) for w in r["words"])) for r in points)
    at = [len(ordered) * k // routes for k in range(1, routes)]
    return sorted({ordered[k] for k in at if ordered})


def phrase_counts(docs: DataFrame, depth: int = MAX_WORDS, least: int = LEAST, route_bytes: int = ROUTE_BYTES) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``n``: all phrases of up to ``depth`` words that occur ``least`` times or more.

    ``docs`` needs text and lang; other columns are not read. A row with no words and an empty phrase has the number of all
    words of the language. A null language is ``und``, a null text empty. Repeated rows count each.
    """
    lang = F.coalesce(docs["lang"].cast("string"), F.lit(UNKNOWN))
    texts = docs.select(lang.alias("lang"), text_bytes().alias("text"))
    cuts = cut_points(texts, depth, route_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(cuts)
    suffixes = texts.mapInArrow(lambda rows: _routed(rows, shared.value, depth), SUFFIXES)
    ranges = suffixes.repartitionById(len(cuts) + 1, F.col("route"))
    counted = ranges.mapInArrow(lambda rows: _counted(rows, shared.value, depth, least), COUNTS)
    summed = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return stored(summed.where((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts")


def collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    least: int = LEAST,
    top: int = TOP,
    contained: int = CONTAINED,
    route_bytes: int = ROUTE_BYTES,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's ``top`` phrases.

    A phrase of two to ``max_words`` words that occurs ``a >= least`` times scores ``1000000 a a div (l r)`` where it is cut
    into a first part, found ``l`` times, and the rest, found ``r`` times; the cut with the lowest score counts, of equal ones
    the first. Phrases inside a longer one, with at least ``contained`` percent of their count, are left out. Ranks go by
    score, then count, then the phrase's bytes. Rows are treated as by ``phrase_counts``; an empty table, or one without
    frequent phrases, gives no rows.
    """
    counts = phrase_counts(docs, max_words, least, route_bytes)
    phrases = counts.where("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    known = counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    sides = []
    for k in range(1, max_words):
        for side, part in (("l", f"substring_index(phrase, ' ', {k})"), ("r", f"substring_index(phrase, ' ', {k} - words)")):
            fits = F.struct(F.lit(f"{side}{k}").alias("side"), F.expr(part).alias("part"))
            sides.append(F.when(F.col("words") > k, fits))
    cut = phrases.withColumn("cut", F.explode(F.filter(F.array(*sides), lambda c: c.isNotNull())))
    cut = cut.select("lang", "words", "phrase", "a", "cut.side", "cut.part")
    # a frequent word is a part of many phrases: its count reaches them apart from the others'
    found = lookup_join(cut, known, ["lang", "part"], "inner")
    each = [F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for k in range(1, max_words) for s in (f"l{k}", f"r{k}")]
    wide = found.groupBy("lang", "words", "phrase", "a").agg(*each)

    # 38 digits hold the products: counts are below 10**15
    square = "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
    cuts = []
    for k in range(1, max_words):
        score = F.expr(f"({square}) div (cast(l{k} as decimal(18,0)) * cast(r{k} as decimal(18,0)))")
        fields = score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")
        cuts.append(F.when(F.col("words") > k, F.struct(*fields)))
    judged = wide.select("lang", "phrase", "a", F.array_min(F.array(*cuts)).alias("cut"))

    inner = [
        F.when(F.col("words") >= max(start, 1) + size, F.expr(f"substring_index(substring_index(phrase, ' ', {start + size}), ' ', -{size})"))
        for size in range(2, max_words)
        for start in range(max_words - size + 1)
    ]
    if inner:
        longer = phrases.select("lang", "a", F.explode(F.array_distinct(F.array_compact(F.array(*inner)))).alias("_in"))
        longer = longer.groupBy(F.col("lang").alias("_lang"), "_in").agg(F.max("a").alias("_most"))
        held = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_in")) & (100 * F.col("_most") >= contained * F.col("a"))
        judged = judged.join(longer, held, "left_anti")

    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    flat = judged.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    first = flat.withColumn("_share", share).withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order)))
    first = first.where(F.col("_rank") <= top).drop("_share", "_rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    totals = counts.where("words = 0").select(F.col("lang").alias("_lang"), F.col("n"))
    ranked = ranked.where(F.col("rank") <= top).join(totals, F.col("lang") == F.col("_lang"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
