"""A quality classifier by compression.

Two zstandard dictionaries are built from labelled text, one from good and one from bad documents. A text that is like
the good ones gets shorter with the good dictionary than with the bad one. The difference of the two sizes, over the
text's own size, becomes a probability by a logistic curve fitted to labelled documents that the dictionaries have not
seen. The curve also has a term for shortness, as a few words say little either way.

Texts are compressed in pieces of ``PIECE`` bytes: in one long stream a text's own beginning would soon serve better
than either dictionary. All pieces of a text count.
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

from acreage.llm.common import remainder, stored, text_bytes

PIECE = 512
LEVEL = 6
# Bounds of what the model is fitted on: labelled documents per class whose lines may enter a dictionary, lines (or parts
# of long lines) and bytes in a dictionary, and labelled documents for the curve.
DICTIONARY_DOCUMENTS = 8_000
DICTIONARY_LINES = 4_000
DICTIONARY_BYTES = 448 << 10
CURVE_DOCUMENTS = 20_000
# Differences are counted in steps of 1 / STEPS for the fit.
STEPS = 2_000
THRESHOLD = 0.3


def pieces_of(text: bytes) -> list[bytes]:
    """Pieces of ``PIECE`` bytes; a short rest stays with the piece before."""
    count = max(1, (len(text) + PIECE // 2) // PIECE)
    cuts = [k * PIECE for k in range(count)] + [len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


@dataclass
class Model:
    good: bytes
    bad: bytes
    offset: float = 0.0
    slope: float = 0.0
    short: float = 0.0


class Sizes:
    """The two compressors, set up once per task."""

    def __init__(self, model: Model) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_dict_id=False)
        self.compressors = []
        for content in (model.good, model.bad):
            options = {}
            if content:
                options["dict_data"] = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                options["dict_data"].precompute_compress(compression_params=params)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=params, **options))

    def difference(self, text: bytes) -> float:
        """(size with the bad dictionary - size with the good one) / size; 0 for an empty text."""
        if not text:
            return 0.0
        pieces = pieces_of(text)
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.compressors)
        return (bad - good) / len(text)


def difference(docs: DataFrame, model: Model) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = Sizes(shared.value)
        for texts in batches:
            yield pa.array([sizes.difference(t.as_py()) for t in texts], pa.float64())

    return measure(text_bytes())


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's different lines, long ones in pieces."""
    for batch in batches:
        rows = []
        for quality, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            lines = {p for line in text.as_py().split(b"\n") for p in pieces_of(line.strip()) if p}
            rows += [(quality, p, xxhash.xxh64_intdigest(p) >> 1) for p in sorted(lines)]
        columns = zip(*rows) if rows else ((), (), ())
        kinds = pa.int32(), pa.binary(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["quality", "line", "key"])


def shortness(size: Column) -> Column:
    return 1 / (1 + size / 100)


def logistic(inputs: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of the curve, the constant first, by Newton's steps with a slight pull to zero."""
    x = np.column_stack([np.ones(len(inputs)), inputs])
    weights, pull = np.zeros(x.shape[1]), np.array([1e-3, 1e-5, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (labels - p)) - pull * weights
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        step *= min(1.0, 5.0 / max(abs(step[0]), abs(step[1]) / 40, abs(step[2]), 1e-9))
        weights = weights + step
        if np.abs(step).max() < 1e-7:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents among ``docs``, a bounded sample of them.

    ``labels`` needs doc_id and quality, 1 for good and 0 for bad; rows with a null in either are left out, and a document
    labelled both ways counts as good. Half of the documents, by a hash of the id, may give pieces to the dictionaries; the
    curve is fitted to others. Of each, the ids with the smallest hashes are taken. Without labels of both kinds
    every text scores alike.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    marks = marks.agg(F.max((F.col("quality") >= 1).cast("int")).alias("quality"))
    marks = marks.withColumn("key", F.xxhash64("doc_id")).withColumn("half", F.pmod(F.col("key"), F.lit(2)))

    def least(rows: DataFrame, count: int) -> DataFrame:
        return rows.orderBy("key", "doc_id").limit(count).select(F.col("doc_id").alias("_id"), "quality", "half")

    chosen = least(marks.where("half = 0 and quality = 1"), DICTIONARY_DOCUMENTS)
    chosen = chosen.union(least(marks.where("half = 0 and quality = 0"), DICTIONARY_DOCUMENTS))
    chosen = F.broadcast(chosen.union(least(marks.where("half = 1"), CURVE_DOCUMENTS)))
    texts = docs.select("doc_id", text_bytes().alias("text")).join(chosen, F.col("doc_id") == F.col("_id"))
    texts = stored(texts.select("quality", "half", "text"), "labelled-texts")
    lines = texts.where("half = 0").select("quality", "text").mapInArrow(_line_rows, "quality int, line binary, key bigint")
    # a line that several documents share, such as a licence or a copied passage, says nothing of its document's quality
    lines = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("quality").alias("quality"), F.first("line").alias("line"))
    lines = stored(lines.where("n = 1"), "dictionary-lines")
    contents = []
    for label in (1, 0):
        rows = lines.where(F.col("quality") == label).orderBy("key").limit(DICTIONARY_LINES).collect()
        contents.append(b"\n".join(r["line"] for r in rows)[:DICTIONARY_BYTES])
    model = Model(*contents)
    curve = texts.where("half = 1")
    step = F.round(difference(curve, model) * STEPS).cast("int")
    # one row per step of the difference, twentieth of shortness and label
    short = F.round(shortness(F.octet_length("text")) * 20).cast("int")
    counts = curve.select("quality", step.alias("step"), short.alias("short")).groupBy("quality", "step", "short").count()
    rows = np.array(counts.orderBy("quality", "step", "short").collect(), dtype=float).reshape(-1, 4)
    if len(set(rows[:, 0])) == 2:
        fitted = logistic(rows[:, 1:3] / (STEPS, 20), rows[:, 0], rows[:, 3])
        model.offset, model.slope, model.short = (float(w) for w in fitted)
    return model


def score(docs: DataFrame, model: Model) -> Column:
    """The chance, from 0 to 1, that a text is good. It depends on the text alone; a null text counts as empty."""
    short = shortness(F.octet_length(text_bytes()))
    return 1 / (1 + F.exp(-(model.slope * difference(docs, model) + model.short * short + model.offset)))


def without_held_out(labels: DataFrame, folds: int = 5) -> DataFrame:
    """The labels that may be learned from: those whose id's remainder is not 0."""
    return labels.where(remainder(F.col("doc_id"), folds) != 0)


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more; ``labels`` may name any of them.

    Repeated rows score alike; an empty text scores as one that neither dictionary helps. An empty table stays empty.
    """
    model = fit(docs, labels)
    return docs.where(score(docs, model) >= threshold)
