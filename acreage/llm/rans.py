"""Token files coded by a static range asymmetric numeral system.

One frequency table, counted over the whole corpus, serves all blocks. A block holds whole documents and is coded by
``LANES`` interleaved states: symbol k belongs to state k mod ``LANES``. Blocks do not depend on each other; within a
block there is a checkpoint (states and place in the words) every ``CHECKPOINT`` rows of symbols, from which decoding can
start, and a checksum per checkpoint. A file is a Parquet table of blocks, so it is written and read by Spark wherever
the cluster keeps its data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acreage.llm.tokens import default_tokenizer, encoded_table, id_width, tokenized

# Fixed values of the format.
LANES = 1024
CHECKPOINT = 64
SCALE_BITS = 20
LOWEST = 1 << 31
# A block is closed once it has this many tokens; it holds whole documents.
BLOCK_TOKENS = 1 << 17

BLOCKS = (
    "part int, block int, low bigint, doc_ids array<bigint>, counts array<bigint>, tokens bigint, "
    "states binary, words binary, marks binary, sums binary"
)
ARROW_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("low", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("tokens", pa.int64()),
        *((n, pa.binary()) for n in ("states", "words", "marks", "sums")),
    ]
)


@dataclass
class Code:
    """Frequencies out of ``1 << SCALE_BITS``; every id that occurs has at least one."""

    symbols: np.ndarray
    freqs: np.ndarray

    def __post_init__(self) -> None:
        self.starts = np.cumsum(self.freqs) - self.freqs
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 1
        self.index = np.full(size, -1, dtype=np.int64)
        self.index[self.symbols] = np.arange(len(self.symbols))
        self.slots = np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freqs)

    @classmethod
    def of(cls, symbols: np.ndarray, counts: np.ndarray) -> "Code":
        """Scaled counts: one each, and the rest in proportion; what rounding leaves goes to the most frequent."""
        if len(symbols) > 1 << (SCALE_BITS - 1):
            raise ValueError("too many symbols for the scale")
        room = (1 << SCALE_BITS) - len(symbols)
        total = int(counts.sum())
        freqs = np.array([1 + int(c) * room // total for c in counts], dtype=np.int64)
        if len(freqs):
            freqs[int(np.argmax(counts))] += (1 << SCALE_BITS) - int(freqs.sum())
        return cls(symbols.astype(np.int64), freqs)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
        """States, words, checkpoints and checksums of a block."""
        n = len(ids)
        at = self.index[ids]
        freqs, starts = self.freqs[at].astype(np.uint64), self.starts[at].astype(np.uint64)
        x = np.full(LANES, LOWEST, dtype=np.uint64)
        scale, half = np.uint64(SCALE_BITS), np.uint64(32)
        rows = -(-n // LANES)
        out, marks, written = [], [], 0
        for r in range(rows - 1, -1, -1):
            a, b = r * LANES, min(n, (r + 1) * LANES)
            f, s, y = freqs[a:b], starts[a:b], x[: b - a]
            full = y >= f << np.uint64(63 - SCALE_BITS)
            words = (y[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            out.append(words)
            written += len(words)
            y = np.where(full, y >> half, y)
            q = y // f
            x[: b - a] = (q << scale) + (y - q * f) + s
            if r % CHECKPOINT == 0:
                marks.append((written, x.astype("<u8").tobytes()))
        stream = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
        # marks in reading order; a mark's place is counted from the end of the stream
        places = np.array([len(stream) - w for w, _ in marks[::-1]], dtype="<i8")
        sums = [zlib.crc32(ids[a : a + CHECKPOINT * LANES].astype("<u4").tobytes()) for a in range(0, n, CHECKPOINT * LANES)]
        states = b"".join(s for _, s in marks[::-1])
        return states, stream.tobytes(), places.tobytes(), np.array(sums, dtype="<u4").tobytes()

    def decode(self, n: int, states: bytes, words: bytes, marks: bytes, sums: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids of a block, or of its checkpoints ``start`` up to ``stop``."""
        starts_at, stream = np.frombuffer(marks, "<i8"), np.frombuffer(words, "<u4")
        checks = np.frombuffer(sums, "<u4")
        stop = len(starts_at) if stop is None else stop
        mask, scale, half = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
        pieces = []
        for mark in range(start, stop):
            x = np.frombuffer(states, "<u8", LANES, mark * LANES * 8).astype(np.uint64)
            at = int(starts_at[mark])
            base, end = mark * CHECKPOINT * LANES, min(n, (mark + 1) * CHECKPOINT * LANES)
            ids = np.empty(end - base, dtype=np.int64)
            for a in range(base, end, LANES):
                b = min(end, a + LANES)
                y = x[: b - a]
                slot = y & mask
                k = self.slots[slot]
                ids[a - base : b - base] = self.symbols[k]
                y = self.freqs[k].astype(np.uint64) * (y >> scale) + slot - self.starts[k].astype(np.uint64)
                low = y < np.uint64(LOWEST)
                need = int(low.sum())
                y[low] = (y[low] << half) | stream[at : at + need].astype(np.uint64)
                at += need
                x[: b - a] = y
            if zlib.crc32(ids.astype("<u4").tobytes()) != int(checks[mark]):
                raise ValueError(f"checksum of checkpoint {mark} does not match")
            pieces.append(ids)
        return np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int64)


def frequencies(coded: DataFrame, dtype: str) -> DataFrame:
    """How often each id occurs, counted in the tasks and then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                ids = np.frombuffer(b"".join(batch.column(0)[k : k + 256].to_pylist()), dtype=dtype)
                seen = np.bincount(ids, minlength=len(total))
                seen[: len(total)] += total
                total = seen
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "count"])

    return coded.select("ids").mapInArrow(count, "id bigint, count bigint").groupBy("id").agg(F.sum("count").alias("count"))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None) -> None:
    """Write ``folder``/blocks and ``folder``/code: the ids of all documents in ascending order of doc_id.

    ``docs`` needs doc_id and text; other columns are not read. A null or empty text is the end id alone. Null doc_ids
    come first; rows with equal doc_id keep the order in which they were read. An empty table gives empty files.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    columns = ("doc_id", docs["doc_id"].cast("bigint")), ("row", F.monotonically_increasing_id())
    coded = encoded_table(tokenized(docs, path, *columns), "tokens")
    dtype = f"<u{id_width(path)}"
    frequencies(coded, dtype).write.parquet(f"{folder}/code")
    code = spark.sparkContext.broadcast(read_code(spark, folder))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, low = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, size = [], [], 0

        def close() -> pa.RecordBatch:
            counts = [len(p) for p in parts]
            row = part, block, low, doc_ids, counts, size, *code.value.encode(np.concatenate(parts))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, ARROW_BLOCKS)], schema=ARROW_BLOCKS)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc)
                parts.append(np.frombuffer(raw.as_py(), dtype=dtype))
                size += len(parts[-1])
                if size >= BLOCK_TOKENS:
                    yield close()
                    block, low = block + 1, low + size
                    doc_ids, parts, size = [], [], 0
        if parts:
            yield close()

    rows = coded.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "ids")
    rows.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_code(spark: SparkSession, folder: str) -> Code:
    """The shared table: one row per id of the vocabulary that occurs."""
    rows = sorted(spark.read.schema("id bigint, count bigint").parquet(f"{folder}/code").collect())
    return Code.of(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, decoded block by block: doc_id, start, n_tokens and ids, four bytes each."""
    code = spark.sparkContext.broadcast(read_code(spark, folder))
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    # one row per file
    sizes = blocks.groupBy("part").agg(F.sum("tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("skip"))
    placed = blocks.join(skips, F.col("part") == F.col("_part")).select(
        (F.col("skip") + F.col("low")).alias("start"), "doc_ids", "counts", "tokens", "states", "words", "marks", "sums"
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, docs, counts, n, *coded = (batch.column(c)[k].as_py() for c in range(8))
                ids, at = code.value.decode(n, *coded).astype("<u4"), np.cumsum(counts) - counts
                raw = [ids[a : a + c].tobytes() for a, c in zip(at, counts)]
                values = zip((docs, start + at, counts, raw), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in values], names=["doc_id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
