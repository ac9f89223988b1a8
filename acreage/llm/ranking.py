"""Ranked lexical search, term at a time with a limited set of accumulators.

The queries are a stated set, all items of a table. Documents are dealt to tasks; a task holds the postings of one block
of documents at a time and answers every query on it. A query's terms are taken from the rarest on. A document gets an
accumulator when a term meets it, until what all remaining terms could add together is less than the score that the
``k``-th best document has already; from then on no accumulators are made, and those there are are brought up to their
full scores. Blocks of a task share the ``k`` best, so later blocks start with a score to beat. Scores are integers, and
the ranking is exact.

What goes to all tasks are the queries, in blocks of ``BLOCK_BYTES`` of text, and the number of documents per term.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acreage.llm.common import stored, text_bytes
from acreage.llm.decontaminate import tokens_of

K = 10
BLOCK_BYTES = 16 << 20
# Postings that a task holds at a time.
BLOCK_POSTINGS = 2_000_000

# Fixed values of the score: see ``impacts``.
SCALE, HALF, SLOPE, TERM_SCALE = 1000, 8, 75, 1_000_000_000

POSTINGS = "doc_id bigint, n bigint, terms binary, times binary"
FOUND = "item int, doc_id bigint, score bigint"


def weight(documents: int, frequency: int) -> int:
    """What a term is worth by the number of documents that hold it."""
    return math.floor(SCALE * math.log((2 * documents + 2) / (2 * frequency + 1)))


def impacts(times: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term that occurs so many times in a document of that length counts, before its weight."""
    m = (100 - SLOPE) + (SLOPE * lengths * documents) // terms
    return (TERM_SCALE * times) // (SCALE * times + HALF * m)


@dataclass
class Queries:
    """A block of queries: their terms by rising document frequency, each with its weight and how often it is asked."""

    vocabulary: dict[bytes, int]
    asked: list[list[tuple[int, int]]]

    @classmethod
    def of(cls, texts: list[bytes]) -> "Queries":
        counts = [Counter(tokens_of(t)) for t in texts]
        vocabulary: dict[bytes, int] = {}
        for c in counts:
            for w in c:
                vocabulary.setdefault(w, len(vocabulary))
        return cls(vocabulary, [[(vocabulary[w], n) for w, n in c.items()] for c in counts])


@dataclass
class Statistics:
    """Documents with a term, all their terms, and per query term the documents that hold it."""

    documents: int
    terms: int
    frequencies: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([weight(self.documents, int(f)) for f in self.frequencies], dtype=np.int64)


def _postings(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[pa.RecordBatch]:
    """A row per document that has a term: its length, and which query terms it holds how often."""
    get, names = queries.vocabulary.get, [c.split()[0] for c in POSTINGS.split(", ")]
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = tokens_of(text.as_py())
            if words:
                own = np.array([t for t in map(get, words) if t is not None], dtype=np.int32)
                terms, times = np.unique(own, return_counts=True)
                rows.append((doc, len(words), terms.astype("<i4").tobytes(), times.astype("<i4").tobytes()))
        kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary()
        columns = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per query term, added up in the task."""
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        terms = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")
        seen = np.bincount(terms, minlength=len(total))
        seen[: len(total)] += total
        total = seen
    terms = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(total[terms], pa.int64())], names=["term", "n"])


@dataclass
class Block:
    """Postings of some documents by term: places of the documents and impacts, and each term's largest impact."""

    docs: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray
    largest: np.ndarray

    @classmethod
    def of(cls, docs: list, lengths: list[int], terms: list[bytes], times: list[bytes], known: Statistics) -> "Block":
        term, count = (np.frombuffer(b"".join(x), "<i4").astype(np.int64) for x in (terms, times))
        place = np.repeat(np.arange(len(docs)), [len(t) // 4 for t in terms])
        value = impacts(count, np.array(lengths, dtype=np.int64)[place], known.documents, known.terms)
        order = np.argsort(term, kind="stable")
        starts = np.searchsorted(term[order], np.arange(len(known.frequencies) + 1))
        largest = np.zeros(len(known.frequencies), dtype=np.int64)
        np.maximum.at(largest, term, value)
        # a null id sorts before all others
        ids = np.array([-(1 << 63) if d is None else d for d in docs], dtype=np.int64)
        return cls(ids, starts, place[order], value[order], largest)

    def best(self, asked: list[tuple[int, int]], weights: np.ndarray, beat: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that may be among the ``k`` best, given a score that ``k`` others have.

        ``asked`` goes from the rarest term on. Documents with a score equal to the one to beat are kept.
        """
        most = np.array([weights[t] * n * self.largest[t] for t, n in asked], dtype=np.int64)
        remaining = np.cumsum(most[::-1])[::-1]
        scores, made, open_, count = np.zeros(len(self.docs), dtype=np.int64), np.zeros(len(self.docs), dtype=bool), True, 0
        for (t, n), bound in zip(asked, remaining):
            a, b = self.starts[t], self.starts[t + 1]
            if a == b:
                continue
            if open_ and count >= k:
                # at least k documents have this much already, so the k-th best final score is no lower
                partial = scores[made]
                beat = max(beat, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            if open_ and bound < beat:
                open_ = False
            places, values = self.places[a:b], self.values[a:b]
            if not open_:
                kept = made[places]
                places, values = places[kept], values[kept]
            scores[places] += weights[t] * n * values
            if open_:
                made[places] = True
                count = int(made.sum())
        at = np.flatnonzero(made & (scores > 0) & (scores >= beat))
        return at, scores[at]


def _answers(batches: Iterator[pa.RecordBatch], queries: Queries, known: Statistics, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best documents per query among the task's documents."""
    weights = known.weights()
    asked = [sorted(q, key=lambda x: (known.frequencies[x[0]], x[0])) for q in queries.asked]
    best: list[list[tuple[int, int]]] = [[] for _ in asked]
    held, size = ([], [], [], []), 0

    def answer() -> None:
        block = Block.of(*held, known)
        for q, terms in enumerate(asked):
            beat = -best[q][-1][0] if len(best[q]) >= k else 0
            at, scores = block.best(terms, weights, beat, k)
            if len(at) > k:
                order = np.lexsort((block.docs[at], -scores))[:k]
                at, scores = at[order], scores[order]
            found = zip((-scores).tolist(), block.docs[at].tolist())
            best[q] = sorted([*best[q], *found])[:k]

    for batch in batches:
        # as many documents at a time as their postings allow
        for k_doc in range(batch.num_rows):
            row = [batch.column(c)[k_doc].as_py() for c in range(4)]
            for values, value in zip(held, row):
                values.append(value)
            size += len(row[2]) // 4
            if size >= BLOCK_POSTINGS:
                answer()
                held, size = ([], [], [], []), 0
    if held[0]:
        answer()
    rows = [(q, None if doc == -(1 << 63) else doc, -score) for q, own in enumerate(best) for score, doc in own]
    columns = zip(*rows) if rows else ((),) * 3
    kinds = pa.int32(), pa.int64(), pa.int64()
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["item", "doc_id", "score"])


def _blocks(items: DataFrame) -> Iterator[tuple[list, Queries]]:
    """Items in blocks of bounded text; items that are equal in all respects are one."""
    rows = items.select("item_id", text_bytes().alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    for b in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).orderBy("item_id", "text").collect()
        if own:
            yield [r["item_id"] for r in own], Queries.of([bytes(r["text"]) for r in own])


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``k`` best documents with a score above 0 for every item.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are not read. Terms are runs of ASCII letters,
    digits and characters outside ASCII, ASCII letters in lower case; a null text has none. Equal scores rank by doc_id,
    a null id first. Repeated documents rank each; items with one item_id and different texts are queries of their
    own. Items without a term that some document holds, and empty tables, give no rows.
    """
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    result = None
    for ids, queries in _blocks(items):
        asked = spark.sparkContext.broadcast(queries)
        texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_bytes().alias("text"))
        postings = stored(texts.mapInArrow(lambda rows, q=asked: _postings(rows, q.value), POSTINGS), "postings")
        sums = postings.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        frequencies = np.zeros(len(queries.vocabulary), dtype=np.int64)
        # a row per query term
        for r in postings.select("terms").mapInArrow(_counted, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
            frequencies[r["term"]] = r["n"]
        known = spark.sparkContext.broadcast(Statistics(sums["documents"], sums["terms"], frequencies))
        found = postings.mapInArrow(lambda rows, q=asked, s=known: _answers(rows, q.value, s.value, k), FOUND)
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))))
        names = spark.createDataFrame(list(enumerate(ids)), f"_item int, item_id {kind}")
        ranked = ranked.where(F.col("rank") <= k).join(names, F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score")
        result = ranked if result is None else result.unionByName(ranked)
    return result if result is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
