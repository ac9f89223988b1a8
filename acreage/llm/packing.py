"""Packing documents into windows that hold every source in proportion.

Each source is a queue of tokens. A deficit round-robin fills a window: every queue earns its share of the window,
takes whole tokens from what it has earned and carries the rest to the next window; a queue that runs dry leaves its
share to the others. So that this runs in parallel, every queue is cut into as many equal runs as there are lanes, and a
lane deals from one run of each. A run's ends are the rounded-down multiples of its queue's fair share, which is how
fractions of a token are carried from one lane to the next.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acreage.llm.tokens import default_tokenizer, encoded_table, id_width, tokenized

WINDOW = 2048
# Windows dealt by one lane: bounds a task's memory and the padding, which is at most one window per lane.
LANE_WINDOWS = 512

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, source string, ids binary"
)


def deal(sizes: np.ndarray, weights: np.ndarray, window: int) -> np.ndarray:
    """Tokens that each window (row) takes from each queue (column)."""
    left, deficit, rows = sizes.astype(np.int64), np.zeros(len(sizes)), []
    while (total := int(left.sum())) > 0:
        room, active = min(window, total), left > 0
        share = np.where(active, weights, 0.0)
        if share.sum() <= 0:
            share = active.astype(float)
        deficit = np.where(active, deficit + room * share / share.sum(), 0.0)
        take = np.clip(np.floor(deficit + 1e-9).astype(np.int64), 0, left)
        while (short := room - int(take.sum())) != 0:
            able = np.flatnonzero(take < left if short > 0 else take > 0)
            order = able[np.argsort((take - deficit if short > 0 else deficit - take)[able], kind="stable")]
            each = max(1, abs(short) // len(able))
            bound = (left - take if short > 0 else take)[order]
            moved = np.minimum(bound, each)[: abs(short)]
            take[order[: len(moved)]] += moved if short > 0 else -moved
        deficit -= take
        left -= take
        rows.append(take)
    return np.array(rows, dtype=np.int64).reshape(len(rows), len(sizes))


def _pieces(lane: int, rows: list[tuple], weights: Mapping | None, window: int, first: int, width: int) -> list[tuple]:
    """``rows``: (source, document, start, tokens of the document, ids), ordered by source and place in its queue."""
    sources = list(dict.fromkeys(r[0] for r in rows))
    at = {s: k for k, s in enumerate(sources)}
    sizes = np.zeros(len(sources), dtype=np.int64)
    for r in rows:
        sizes[at[r[0]]] += len(r[4]) // width
    share = sizes.astype(float) if weights is None else np.array([float(weights.get(s, 0.0)) for s in sources])
    takes = deal(sizes, share, window)
    offsets = np.cumsum(takes, axis=1) - takes
    ends = np.cumsum(takes, axis=0)
    out, source, dealt, w = [], None, 0, 0
    for name, doc, start, whole, ids in rows:
        if source is None or name != sources[source]:
            source, dealt, w = at[name], 0, 0
        done, n = 0, len(ids) // width
        while done < n:
            while ends[w, source] <= dealt:
                w += 1
            size = min(n - done, int(ends[w, source]) - dealt)
            piece = ids[done * width : (done + size) * width]
            crc = zlib.crc32(np.frombuffer(piece, dtype=f"<u{width}").astype("<u4").tobytes())
            offset = int(offsets[w, source] + dealt - (ends[w, source] - takes[w, source]))
            out.append((doc, start + done, size, crc, whole, first + w, offset, name, piece))
            done, dealt = done + size, dealt + size
    return out


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    proportions: Mapping[str, float] | None = None,
    window: int = WINDOW,
    lane_windows: int = LANE_WINDOWS,
) -> DataFrame:
    """Every token of ``docs`` in exactly one piece of a sequence of at most ``window`` tokens.

    ``docs`` needs doc_id, text and source; other columns are not read. A document is its ids and the end id; a null or
    empty text is the end id alone. ``proportions`` gives the wanted token share per source; without it the shares of
    the whole corpus hold, and all queues run dry together. A source it does not name is dealt after the others. A null
    source is a queue of its own. Rows with equal or null doc_id are separate documents. Sequence ids rise but may
    leave gaps between lanes. An empty table gives no pieces.
    """
    path = tokenizer or default_tokenizer()
    doc_id, source = docs["doc_id"].cast("bigint"), docs["source"].cast("string")
    coded = encoded_table(tokenized(docs, path, ("doc_id", doc_id), ("source", source), queue="source"), "packing")
    # a row per source and task
    parts = coded.groupBy("source", "part").agg(F.sum("n").alias("size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("skip", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    sums = parts.groupBy("source").agg(F.sum("size").alias("total"))
    whole = sums.agg(F.sum("total").alias("tokens"), F.count(F.lit(1)).alias("sources")).first()
    tokens, lanes = whole["tokens"] or 0, max(1, -(-(whole["tokens"] or 0) // (lane_windows * window)))
    # rounding adds at most a token per source to a lane
    lane_size = -(-(tokens // lanes + 1 + whole["sources"]) // window)
    parts = parts.alias("p").join(sums.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
    parts = parts.select(F.col("p.source").alias("_source"), F.col("part").alias("_part"), "skip", "total")
    match = coded["source"].eqNullSafe(parts["_source"]) & (coded["part"] == parts["_part"])
    placed = coded.join(parts, match).withColumn("place", F.col("skip") + F.col("before"))
    lane_of = lambda last: F.expr(f"((cast({last} as decimal(20,0)) + 1) * {lanes} - 1) div total")
    placed = placed.withColumn("lane", F.explode(F.sequence(lane_of("place"), lane_of("place + n - 1"))))
    edge = lambda k: F.expr(f"(cast({k} as decimal(20,0)) * total) div {lanes}")
    placed = placed.withColumn("low", F.greatest(edge("lane"), F.col("place")))
    placed = placed.withColumn("high", F.least(edge("lane + 1"), F.col("place") + F.col("n")))
    width = id_width(path)
    skipped = F.col("low") - F.col("place")
    runs = placed.select(
        "lane",
        "source",
        "low",
        "doc_id",
        skipped.alias("start"),
        "n",
        F.substring(F.col("ids"), (skipped * width + 1).cast("int"), ((F.col("high") - F.col("low")) * width).cast("int")).alias("ids"),
    ).where("high > low")
    runs = runs.repartition("lane").sortWithinPartitions("lane", "source", "low")
    weights = dict(proportions) if proportions is not None else None
    arrow = pa.schema([(n, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in PIECES.split(", "))])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, rows = None, []

        def flush() -> pa.RecordBatch:
            made = _pieces(lane, rows, weights, window, lane * lane_size, width)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for row_lane, row_source, _, doc, start, n, ids in zip(*columns):
                if row_lane != lane and rows:
                    yield flush()
                    rows = []
                lane = row_lane
                rows.append((row_source, doc, start, n, ids))
        if rows:
            yield flush()

    return runs.mapInArrow(dealt, PIECES)

