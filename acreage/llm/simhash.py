"""Near duplicates by SimHash and BK-trees.

A fingerprint has 64 bits: bit b is 1 if it is set in more than half of the hashes of a text's shingles. Fingerprints that
differ in at most ``RADIUS`` bits are linked, and a document's group is all it can reach over links.

Only different fingerprints are compared. Cut into ``RADIUS + 1`` bands of bits, two linked fingerprints agree in a band
at least, so every fingerprint goes to one shard per band, named by the band's bits. A shard has its fingerprints in
BK-trees: children hang on edges keyed by their Hamming distance to the parent, and a search follows only the edges
within the radius of its own distance. A shard of more than ``TREE_SIZE`` fingerprints is dealt into several trees of
bounded size, and each of these trees is sent to all query blocks of its shard, so no task holds a whole shard. Of a
search's links only a spanning forest leaves the task; groups of near copies do not become all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import packed_rows, stored, text_bytes
from acreage.llm.graph import components

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
TREE_SIZE = 512
# Fingerprints whose trees are grown and searched at a time.
FOREST = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """0 for a text without words; fewer words than a shingle are one shingle."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    runs = zip(*(words[k:] for k in range(shingle)))
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE):
    """The fingerprint of ``text`` as a column, a bigint with the same bits."""

    @F.arrow_udf("bigint")
    def measure(texts: pa.Array) -> pa.Array:
        made = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
        return pa.array(made.view(np.int64))

    return measure(text_bytes())


def grow(values: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees of ``values``, one per number in ``tree`` (which is sorted): the roots, and each node's child per distance.

    All values start at the root of their tree. In each round those at the same node and distance take the edge of
    that distance: the first becomes the child there, the others go on to it.
    """
    first = np.concatenate([[True], tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, dtype=bool)
    roots = np.flatnonzero(first)
    children = np.full((len(values), BITS + 1), -1, dtype=np.int32)
    moving = np.flatnonzero(~first)
    at = roots[np.cumsum(first) - 1][moving]
    while len(moving):
        edge = at.astype(np.int64) * (BITS + 1) + np.bitwise_count(values[moving] ^ values[at])
        _, lead, group = np.unique(edge, return_index=True, return_inverse=True)
        children.reshape(-1)[edge[lead]] = moving[lead]
        stay = np.ones(len(moving), dtype=bool)
        stay[lead] = False
        at, moving = moving[lead][group][stay], moving[stay]
    return roots, children


def search(values: np.ndarray, children: np.ndarray, asked: np.ndarray, at: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For ``asked`` fingerprints that start at the roots ``at``: pairs of (place in asked, node) within ``radius``."""
    query, found = np.arange(len(asked)), []
    while len(query):
        distance = np.bitwise_count(asked[query] ^ values[at]).astype(np.int64)
        near = distance <= radius
        found.append((query[near], at[near]))
        follow = []
        for step in range(-radius, radius + 1):
            edge = distance + step
            child = children[at, np.clip(edge, 0, BITS)]
            ok = (child >= 0) & (edge >= 0) & (edge <= BITS)
            follow.append((query[ok], child[ok]))
        query, at = (np.concatenate(x) for x in zip(*follow))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (query, query)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the links (a, b): every value with the smallest one of its component, unless it is that."""
    values, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(values))
    return values[other], values[label[other]]


def _searched(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of rows of (tree, asked): fingerprints of a tree, and those to look up in it."""
    names = ["a", "b"]

    def links(rows: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        trees = np.concatenate([t for t, _ in rows])
        number = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows])
        roots, children = grow(trees.view(np.uint64), number)
        asked = np.concatenate([q for _, q in rows])
        at = np.repeat(roots, [len(q) for _, q in rows])
        out = []
        for k in range(0, len(asked), 1 << 14):
            part = asked[k : k + (1 << 14)].view(np.uint64)
            query, node = search(trees.view(np.uint64), children, part, at[k : k + (1 << 14)], radius)
            a, b = part[query], trees.view(np.uint64)[node]
            out.append(forest(a[a != b], b[a != b]))
        a, b = forest(*(np.concatenate(x) for x in zip(*out)))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=names)

    for batch in batches:
        rows, size = [], 0
        for tree, asked in zip(batch.column(0), batch.column(1)):
            rows.append(tuple(x.values.to_numpy(zero_copy_only=False) for x in (tree, asked)))
            size += len(rows[-1][0]) + len(rows[-1][1])
            if size > FOREST:
                yield links(rows)
                rows, size = [], 0
        if rows:
            yield links(rows)


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a``, ``b``: links between the different values of the bigint column ``fp`` that connect all within ``radius`` bits.

    Not every pair within the radius is a row, but its two ends are connected by rows.
    """
    bands = radius + 1
    width = BITS // bands
    keys = [F.shiftrightunsigned("fp", band * width).bitwiseAND(F.lit((1 << width) - 1)) for band in range(bands)]
    shard = lambda band: (F.lit(band << width) + keys[band]).alias("shard")
    rows = prints.select("fp", F.explode(F.array(*(shard(b) for b in range(bands)))).alias("shard"))
    # at most one row per value of a band's bits
    sizes = rows.groupBy("shard").count().where("count > 1")
    sizes = stored(sizes.select("shard", F.ceil(F.col("count") / TREE_SIZE).cast("int").alias("trees")), "shards")
    dealt = rows.join(sizes, "shard").withColumn("tree", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    trees = dealt.groupBy("shard", "tree", "trees").agg(F.sort_array(F.collect_list("fp")).alias("values"))
    trees = stored(trees, "trees")
    # the tree's own block, and for a shard of several trees the blocks of the trees after it
    own = trees.select("values", F.col("values").alias("asked"))
    several = trees.where("trees > 1")
    blocks = several.select("shard", F.col("values").alias("asked"), F.explode(F.sequence(F.lit(0), F.col("tree"))).alias("tree"), F.col("tree").alias("block"))
    sent = several.join(blocks.where("block > tree"), ["shard", "tree"]).select("values", "asked")
    spread = own.union(sent).repartition(F.xxhash64("values", "asked"))
    return spread.mapInArrow(lambda batches: _searched(batches, radius), "a bigint, b bigint").distinct()


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` of every row of ``docs``, and ``first``: true for one row of each group.

    ``docs`` needs doc_id and text; other columns are not read. A null text counts as empty, and all texts without words
    are copies of each other. ``component_id`` is the group's smallest doc_id, null if it has none. ``first`` is the row
    with that id; of several, or where all are null, the one that was read first. An empty table gives an empty result.
    """
    rows = packed_rows(docs, doc_id=docs["doc_id"], text=docs["text"])
    return _grouped(rows.drop("row"), shingle, radius).drop("_row")


def _grouped(rows: DataFrame, shingle: int, radius: int, *more: str) -> DataFrame:
    made = rows.select(*more, "doc_id", fingerprints(rows, shingle).alias("fp"))
    made = stored(made.withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    prints = stored(made.groupBy("fp").agg(F.min(least).alias("least")), "prints")
    labels = components(near_links(prints.select("fp"), radius))
    # groups of one fingerprint have no label
    linked = prints.join(labels, prints["fp"] == labels["node"])
    best = linked.groupBy("label").agg(F.min("least").alias("best"))
    best = linked.select("fp", "label").join(best, "label").select(F.col("fp").alias("_fp"), "best")
    firsts = prints.join(best, prints["fp"] == best["_fp"], "left").select(
        F.col("fp").alias("_fp"), F.coalesce("best", "least").alias("best")
    )
    firsts = stored(firsts, "group-firsts")
    # copies share a fingerprint; the adaptive join splits the rows of a large group
    return made.join(firsts, made["fp"] == firsts["_fp"]).select(
        *more,
        "doc_id",
        "fp",
        F.col("best.id").alias("component_id"),
        (F.col("best.row") == F.col("_row")).alias("first"),
        "_row",
    )


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group, all columns of ``docs``; which one as said in ``grouped``."""
    rows = packed_rows(docs, doc_id=docs["doc_id"], text=docs["text"])
    return _grouped(rows, shingle, radius, "row").where("first").select("row.*")
