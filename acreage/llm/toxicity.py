"""A toxicity classifier: logistic regression over hashed word n-grams, learned by FTRL-proximal.

A text's features are its different words, pairs of neighbours and pairs with one or two words between them, hashed to
``1 << BITS`` coordinates. Every coordinate has its own learning rate, which falls with the gradients it has seen, and
an L1 penalty that keeps it at exactly zero until it has said enough. So few weights are left, and these go to all tasks.

Learning runs in ``SHARDS`` tasks. In each of ``ROUNDS`` rounds every task starts from the shared state, goes through its
documents in order and hands back the coordinates it changed, and the changes are averaged. The state has a fixed size,
whatever the size of the corpus, and so has what a round sends: ten bytes per coordinate and shard at most. Shards and
orders come from hashes of ids, so the weights do not depend on how the input is split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import remainder, text_bytes
from acreage.llm.decontaminate import tokens_of
from acreage.session import checkpointed

BITS = 19
# Bound of what the model is fitted on: labelled documents, those with the smallest hashes of their ids.
FIT_DOCUMENTS = 100_000
SHARDS = 4
ROUNDS = 8
# Learning rate, its damping, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.1
THRESHOLD = 0.7
# Words whose hashes a worker keeps.
CACHE_WORDS = 300_000
# Texts whose features are worked out at a time, in bytes.
PORTION_BYTES = 4 << 20

_HASHES: dict[bytes, int] = {}
_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    found = list(map(_HASHES.get, words))
    for k, (word, value) in enumerate(zip(words, found)):
        if value is None:
            found[k] = _HASHES.setdefault(word, xxhash.xxh64_intdigest(word))
    return np.array(found, dtype=np.uint64)


def _different(values: np.ndarray) -> np.ndarray:
    """The different values in order; on large arrays a sort is faster than NumPy's own way."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and coordinate of all features, repeats included."""
    words, sizes = [], []
    for text in texts:
        own = tokens_of(text)
        words += own
        sizes.append(len(own))
    h = _word_hashes(words)
    of = np.repeat(np.arange(len(texts)), sizes)
    shift = np.uint64(64 - BITS)
    docs, coordinates = [of], [(h * _ODD[0]) >> shift]
    for gap in (1, 2, 3):
        same = of[gap:] == of[:-gap]
        # the order of the two words counts, and so does the gap
        pair = (h[:-gap][same] * _ODD[gap]) ^ (h[gap:][same] >> np.uint64(gap))
        pair = (pair ^ (pair >> np.uint64(32))) * _ODD[0]
        docs.append(of[gap:][same])
        coordinates.append(pair >> shift)
    return np.concatenate(docs), np.concatenate(coordinates).astype(np.int64)


def _portions(texts: pa.Array) -> Iterator[list[bytes]]:
    portion, size = [], 0
    for text in texts:
        portion.append(text.as_py())
        size += len(portion[-1])
        if size >= PORTION_BYTES:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


@dataclass
class State:
    """What FTRL keeps for each coordinate; the last one is the constant."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def fresh(cls) -> "State":
        return cls(*(np.zeros((1 << BITS) + 1, dtype=np.float32) for _ in range(2)))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at].astype(float), self.n[at].astype(float)
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        # the constant has no penalty
        pull = np.where(at == 1 << BITS, 0.0, L1)
        return -np.sign(z) * np.maximum(np.abs(z) - pull, 0.0) / rate

    def learn(self, at: np.ndarray, toxic: int) -> None:
        """One step for a document with the features ``at``, each once, the constant among them."""
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - toxic
        n = self.n[at].astype(float)
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient * gradient


@dataclass
class Model:
    """The weights that are not zero, by rising coordinate, and the constant."""

    coordinates: np.ndarray
    weights: np.ndarray
    constant: float

    def dense(self) -> np.ndarray:
        full = np.zeros(1 << BITS, np.float32)
        full[self.coordinates] = self.weights
        return full

    def logits(self, texts: list[bytes], full: np.ndarray) -> np.ndarray:
        """``full`` is ``dense()``, made once per task."""
        docs, at = features(texts)
        used = np.flatnonzero(full[at])
        pairs = _different((docs[used] << BITS) | at[used])
        return np.bincount(pairs >> BITS, full[pairs & ((1 << BITS) - 1)], len(texts)) + self.constant


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's different features: steps from one coordinate to the next, compressed."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        first = 0
        for portion in _portions(batch.column(3)):
            docs, at = features(portion)
            pairs = _different((docs << BITS) | at)
            cuts = np.searchsorted(pairs >> BITS, np.arange(len(portion) + 1))
            own = pairs & ((1 << BITS) - 1)
            raw = [packer.compress(np.diff(own[a:b], prepend=0).astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
            rows = batch.slice(first, len(portion))
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(raw, pa.binary())], names=["shard", "place", "toxic", "features"])
            first += len(portion)


def _changes(batches: Iterator[pa.RecordBatch], start: State) -> Iterator[pa.RecordBatch]:
    """The coordinates that a round changes in the task's shard, and by how much."""
    state, unpacker = State(start.z.copy(), start.n.copy()), zstandard.ZstdDecompressor()
    for batch in batches:
        for toxic, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.cumsum(np.frombuffer(unpacker.decompress(raw), "<u4"), dtype=np.int64)
            state.learn(np.append(own, 1 << BITS), toxic)
    z, n = state.z - start.z, state.n - start.n
    at = np.flatnonzero(n)
    parts = at.astype("<u4"), z[at].astype("<f4"), n[at].astype("<f4")
    columns = [pa.array([x.tobytes()], pa.binary()) for x in parts]
    yield pa.RecordBatch.from_arrays(columns, names=["at", "z", "n"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents among ``docs``, at most ``FIT_DOCUMENTS`` labels of them.

    ``labels`` needs doc_id and toxic, 1 for toxic and 0 for not; rows with a null in either are left out, and a document
    labelled both ways counts as toxic. Without labels no feature has a weight and every text scores 0.5.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    marks = marks.agg(F.max((F.col("toxic") >= 1).cast("int")).alias("toxic")).withColumn("key", F.xxhash64("doc_id"))
    marks = marks.orderBy("key", "doc_id").limit(FIT_DOCUMENTS).select(F.col("doc_id").alias("_id"), "toxic", "key")
    # as many rows as the limit allows, of three numbers each
    texts = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))
    shard = F.pmod(F.col("key"), F.lit(SHARDS)).cast("int")
    coded = texts.select(shard.alias("shard"), F.xxhash64("key").alias("place"), "toxic", "text")
    coded = coded.mapInArrow(_coded, "shard int, place bigint, toxic int, features binary")
    # one shard to a partition, in a fixed order, for all rounds
    coded = coded.repartitionById(SHARDS, F.col("shard")).sortWithinPartitions("place", "features", "toxic")
    coded = checkpointed(coded.select("toxic", "features"))
    state = State.fresh()
    for _ in range(ROUNDS):
        shared = docs.sparkSession.sparkContext.broadcast(state)
        changed = coded.mapInArrow(lambda batches, start=shared: _changes(batches, start.value), "at binary, z binary, n binary")
        state = State(state.z.copy(), state.n.copy())
        for r in changed.collect():
            at = np.frombuffer(r["at"], "<u4")
            state.z[at] += np.frombuffer(r["z"], "<f4") / SHARDS
            state.n[at] += np.frombuffer(r["n"], "<f4") / SHARDS
        shared.unpersist()
    weights = state.weights(np.arange(len(state.z)))
    kept = np.flatnonzero(weights[:-1])
    return Model(kept.astype(np.int32), weights[kept].astype(np.float32), float(weights[-1]))


def score(docs: DataFrame, model: Model) -> Column:
    """The chance, from 0 to 1, that a text is toxic. It depends on the whole text alone; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        full = shared.value.dense()
        for texts in batches:
            logits = [shared.value.logits(portion, full) for portion in _portions(texts)]
            joined = np.clip(np.concatenate(logits) if logits else np.zeros(0), -30, 30)
            yield pa.array(1 / (1 + np.exp(-joined)), pa.float64())

    return measure(text_bytes())


def without_held_out(labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """The labels that may be learned from: those whose id's remainder is not ``held_out``."""
    return labels.where(remainder(F.col("doc_id"), folds) != held_out)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted``, 1 where the score is at least ``threshold``, of every row.

    ``docs`` needs doc_id and text; no other column is read. Repeated rows and null ids are scored each, a text without
    words by the constant alone. An empty table gives an empty result.
    """
    scored = docs.select("doc_id", score(docs, fit(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
