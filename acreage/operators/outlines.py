"""The union of parcels: its outline's edges, and the edges linked to rings.

Parcels' edges run with the parcel on their left. Where one parcel's corner lies on another's side, the side is cut
there, so that neighbours' pieces compare equal even if only one of the two has a corner. A piece is part of the outline
when a parcel lies on exactly one side of it. So a side that two neighbours share goes, and a parcel that is
listed twice under two ids is still outlined once.

Rings come out of the pieces by list ranking: each piece points to the one after it, and pointers double until every
piece knows its ring and its place there. All joins of that part are on the numbers of pieces, which are unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructType

from acreage.operators.spread import fits_broadcast, linked_rows, lookup_join, matching, numbered, salted_join
from acreage.session import BLOCK_ROWS, setting, stored

# How far from a side, in units of the grid, a corner may be and still cut it.
TOLERANCE = 1e-6
ENDS = ["x0", "y0", "x1", "y1"]
# Keys with more pieces than this are not put together in one row but by joins.
ROW_PIECES = 1024


def directed_edges(vertices: DataFrame) -> DataFrame:
    """Edges in grid coordinates with the parcel on the left, whichever way its rings wind; none has length zero."""
    block = F.floor(F.col("seq") / setting(vertices.sparkSession, BLOCK_ROWS))
    rows = linked_rows(vertices, ["PID", "ring"], block, ["seq"], ["x", "y"], wrap=True)
    # a closed ring's sum is the same from any origin, so each ring has its own
    ax, ay = F.col("x") - F.col("first.x"), F.col("y") - F.col("first.y")
    bx, by = F.col("next.x") - F.col("first.x"), F.col("next.y") - F.col("first.y")
    rows = stored(
        rows.select(
            "PID", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("next.x").alias("x1"), F.col("next.y").alias("y1"), (ax * by - bx * ay).alias("cross")
        ).where("x0 <> x1 OR y0 <> y1"),
        "parcel-edges",
    )
    sides = stored(rows.groupBy("PID").agg((F.sum("cross") < 0).alias("clockwise"), F.count(F.lit(1)).alias("count")), "windings")
    turned = lookup_join(rows, sides.drop("count"), ["PID"], "inner", counts=sides.select("PID", "count"), probe=True)
    swap = {"x0": "x1", "y0": "y1", "x1": "x0", "y1": "y0"}
    return turned.select("PID", *(F.when(F.col("clockwise"), F.col(b)).otherwise(F.col(a)).alias(a) for a, b in swap.items()))


def _cells(low_x: Column, low_y: Column, high_x: Column, high_y: Column, size: Column) -> Column:
    """The grid cells of a size that a box touches."""
    line = lambda low, high: F.sequence(F.floor(low / size), F.floor(high / size))
    return F.flatten(F.transform(line(low_x, high_x), lambda i: F.transform(line(low_y, high_y), lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def corners_on_sides(edges: DataFrame) -> DataFrame:
    """Sides that a corner of another parcel lies on: ``PID``, the side, ``other`` and the corner ``px``, ``py``.

    Sides are put into the cells of a grid that is as wide as they are long, to the next power of two, so each is in a few
    cells, and a corner meets the sides of one cell for each length class that occurs.
    """
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    sides = edges.withColumn("class", F.ceil(F.log2(length + 2 * TOLERANCE)).cast("int"))
    margin, size = F.lit(TOLERANCE), F.pow(F.lit(2.0), F.col("class"))
    box = _cells(
        F.least("x0", "x1") - margin, F.least("y0", "y1") - margin, F.greatest("x0", "x1") + margin, F.greatest("y0", "y1") + margin, size
    )
    sides = sides.withColumn("length", length).withColumn("cell", F.explode(box)).select("*", "cell.cx", "cell.cy").drop("cell")
    # one row per length class: the binary logarithms of lengths
    classes = [r["class"] for r in sides.select("class").distinct().collect()]
    corners = edges.select(F.col("PID").alias("other"), F.col("x0").alias("px"), F.col("y0").alias("py")).distinct()
    corners = corners.withColumn("class", F.explode(F.array(*map(F.lit, sorted(classes)))) if classes else F.lit(None).cast("int"))
    corners = corners.withColumns({"cx": F.floor(F.col("px") / size), "cy": F.floor(F.col("py") / size)})
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    qx, qy = F.col("px") - F.col("x0"), F.col("py") - F.col("y0")
    along = (qx * dx + qy * dy) / F.col("length")
    near = F.abs(dx * qy - dy * qx) <= TOLERANCE * F.col("length")
    inside = (along > TOLERANCE) & (along < F.col("length") - TOLERANCE)
    met = salted_join(corners, sides, on=["class", "cx", "cy"], by=["other", "px", "py"], small=fits_broadcast(sides))
    return met.where(near & inside & (F.col("other") != F.col("PID"))).select("PID", *ENDS, "other", "px", "py", along.alias("along"))


def _pieces(listed: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Each listed parcel's edges, cut at the corners of the other parcels of its list, and ``times``, how often each counts.

    A list with few pieces is gathered in a row, beside which the parcels' sides are cut without another shuffle.
    """
    corners = stored(corners_on_sides(edges), "corners-on-sides")
    sizes = edges.select("PID").unionByName(corners.select("PID")).groupBy("PID").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes, "parcel-sizes")
    few = fits_broadcast(sizes)
    weighed = salted_join(listed, sizes, on=["PID"], by=[key], small=few).groupBy(key).agg(F.sum("n").alias("n"))
    large = stored(weighed.where((F.col("n") > ROW_PIECES) | F.col(key).isNull()).select(F.col(key).alias(f"_on_{key}")), "large-lists")
    cut = ["PID", *ENDS, "corners"]
    crossed = corners.groupBy("PID", *ENDS).agg(F.collect_set(F.struct("along", "px", "py", "other")).alias("corners"))
    sides = edges.groupBy("PID", *ENDS).agg(F.count(F.lit(1)).alias("times")).join(crossed, ["PID", *ENDS], "left").select(*cut, "times")
    none = large.isEmpty()
    small = listed if none else listed.join(large, matching(listed, large, [key], null_safe=True), "left_anti")
    near = _cut_sides(small, stored(sides, "cut-sides"), key, few)
    if none:
        return near
    rest = listed.join(large, matching(listed, large, [key], null_safe=True), "left_semi")
    return near.unionByName(_joined_pieces(stored(rest, "large-lists"), edges, corners, key).withColumn("times", F.lit(1).cast("bigint")))


def _cut_sides(listed: DataFrame, sides: DataFrame, key: str, few: bool) -> DataFrame:
    """``_pieces`` of lists that fit a row; ``few`` says that there are few parcels."""
    if few and fits_broadcast(sides):
        lists = listed.groupBy(key).agg(F.collect_list("PID").alias("_pids"))
        rows = lists.select(key, "_pids", F.explode(F.array_distinct("_pids")).alias("PID")).join(F.broadcast(sides), "PID")
    else:
        parts = F.struct("PID", *ENDS, "corners", "times")
        whole = sides.groupBy("PID").agg(F.collect_list(parts).alias("_sides"))
        lists = salted_join(listed, whole, on=["PID"], by=[key]).groupBy(key).agg(F.collect_list("PID").alias("_pids"), F.collect_list("_sides").alias("_sides"))
        rows = lists.select(key, "_pids", F.inline(F.array_distinct(F.flatten("_sides"))))
    held = F.filter("corners", lambda c: F.array_contains(F.col("_pids"), c["other"]))
    cuts = F.array_sort(F.array_distinct(F.transform(held, lambda c: F.struct(c["along"], c["px"], c["py"]))))
    rows = rows.withColumn("_cuts", F.coalesce(cuts, F.array().cast("array<struct<along:double,px:double,py:double>>")))
    point = lambda x, y: F.struct(x.alias("px"), y.alias("py"))
    inner = F.transform("_cuts", lambda c: point(c["px"], c["py"]))
    rows = rows.withColumn("_ends", F.concat(F.array(point(F.col("x0"), F.col("y0"))), inner, F.array(point(F.col("x1"), F.col("y1")))))
    # a side that is not cut counts as often as it is listed, one that is cut counts once
    again = F.col("times") * (F.size("_pids") - F.size(F.array_remove("_pids", F.col("PID"))))
    rows = rows.withColumn("times", F.when(F.size("_cuts") == 0, again).otherwise(1).cast("bigint"))
    steps = F.transform(F.sequence(F.lit(1), F.size("_ends") - 1), lambda k: F.struct(F.get("_ends", k - 1).alias("a"), F.get("_ends", k).alias("b")))
    split = rows.select(key, "PID", "times", F.explode(steps).alias("_s"))
    ends = {"x0": "_s.a.px", "y0": "_s.a.py", "x1": "_s.b.px", "y1": "_s.b.py"}
    return split.select(key, "PID", *(F.col(c).alias(n) for n, c in ends.items()), "times").where("x0 <> x1 OR y0 <> y1")


def _joined_pieces(listed: DataFrame, edges: DataFrame, corners: DataFrame, key: str) -> DataFrame:
    """``_pieces`` by joins that hold no list whole."""
    rows = salted_join(listed, edges, on=["PID"], by=[key], small=fits_broadcast(edges))
    if corners.isEmpty():
        return rows
    there = salted_join(listed, corners, on=["PID"], by=[key], small=fits_broadcast(corners))
    pairs = listed.select(F.col(key).alias("_key"), F.col("PID").alias("_other"))
    both = there.join(pairs, (F.col(key) == F.col("_key")) & (F.col("other") == F.col("_other")), "left_semi")
    cuts = stored(both.select(key, "PID", *ENDS, "px", "py", "along").distinct(), "cuts")
    side = [key, "PID", *ENDS]
    whole = rows.join(cuts.select(*side).distinct(), side, "left_anti")
    # the pieces of a side begin at its own start and at each cut
    begins = cuts.unionByName(cuts.select(*side).distinct().select("*", F.col("x0").alias("px"), F.col("y0").alias("py"), F.lit(0.0).alias("along")))
    after = F.lead(F.struct("px", "py")).over(Window.partitionBy(*side).orderBy("along", "px", "py"))
    ends = F.coalesce(after, F.struct(F.col("x1").alias("px"), F.col("y1").alias("py")))
    split = begins.select(key, "PID", F.col("px").alias("x0"), F.col("py").alias("y0"), ends["px"].alias("x1"), ends["py"].alias("y1"))
    return whole.unionByName(split.where("x0 <> x1 OR y0 <> y1"))


def union_pieces(listed: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Pieces with their lesser end first, and how many of the list's parcels lie ``left`` and ``right`` of them.

    ``listed`` has a row per key and parcel id, ``edges`` are directed.
    """
    forward = F.struct("x0", "y0") <= F.struct("x1", "y1")
    rows = _pieces(listed, edges, key).withColumn("forward", forward)
    swap = {"x0": "x1", "y0": "y1", "x1": "x0", "y1": "y0"}
    rows = rows.select(key, "forward", "times", *(F.when(F.col("forward"), F.col(a)).otherwise(F.col(b)).alias(a) for a, b in swap.items()))
    return rows.groupBy(key, *ENDS).agg(
        F.sum(F.when(F.col("forward"), F.col("times")).otherwise(0)).alias("left"),
        F.sum(F.when(F.col("forward"), 0).otherwise(F.col("times"))).alias("right"),
    )


def on_outline() -> Column:
    """Whether a piece has parcels on one of its sides only."""
    return (F.col("left") > 0) != (F.col("right") > 0)


def _doubled(pointers: DataFrame, value: str, merge) -> DataFrame:
    """One round: every row's ``jump`` and ``value`` with those of the row it points to."""
    far = pointers.select(F.col("id").alias("_id"), F.col("jump").alias("_jump"), F.col(value).alias("_value"))
    met = pointers.join(far, F.col("jump") == F.col("_id"), "left")
    return met.select("id", F.col("_jump").alias("jump"), merge(F.col(value), F.col("_value")).alias(value), F.col(value).alias("was"))


def _ring_of(after: DataFrame) -> DataFrame:
    """``id`` and ``ring``, the least id of the cycle, from ``id`` and ``next``; rounds grow with a ring's logarithm."""
    rows = stored(after.select("id", F.col("next").alias("jump"), F.least("id", "next").alias("low")), "rings")
    while True:
        rows = stored(_doubled(rows, "low", F.least), "rings")
        if rows.where("low <> was").isEmpty():
            return rows.select("id", F.col("low").alias("ring"))


def _place_of(after: DataFrame, starts: DataFrame) -> DataFrame:
    """``id`` and ``seq`` from 1 at each of ``starts``: the number of steps back to the start."""
    back = after.select(F.col("next").alias("id"), F.col("id").alias("jump"))
    first = starts.select(F.col("id").alias("_start"))
    rows = back.join(first, F.col("id") == F.col("_start"), "left")
    rows = rows.select("id", F.when(F.col("_start").isNull(), F.col("jump")).alias("jump"))
    rows = stored(rows.withColumn("steps", F.when(F.col("jump").isNull(), 0).otherwise(1).cast("bigint")), "ring-places")
    while not rows.where("jump IS NOT NULL").isEmpty():
        rows = stored(_doubled(rows, "steps", lambda a, b: a + F.coalesce(b, F.lit(0))).drop("was"), "ring-places")
    return rows.select("id", (F.col("steps") + 1).alias("seq"))


def _following(outline: DataFrame, key: str) -> DataFrame:
    """``id`` and ``next`` of every piece, and ``even``, false where the pieces at a corner do not pair up.

    Around a corner, pieces that come in and go out take turns. One that comes in goes on with the next one clockwise:
    the two bound the same parcel ground, so that rings that touch in a corner stay apart.
    """
    heading = lambda x, y: F.atan2(y, x)
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    none = F.lit(None).cast("bigint")
    into = outline.select(key, F.col("x1").alias("vx"), F.col("y1").alias("vy"), heading(-dx, -dy).alias("angle"), F.col("id").alias("into"), none.alias("out"))
    out = outline.select(key, F.col("x0").alias("vx"), F.col("y0").alias("vy"), heading(dx, dy).alias("angle"), none.alias("into"), F.col("id").alias("out"))
    around = Window.partitionBy(key, "vx", "vy").orderBy("angle", "into")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.struct("into", "out")
    before = F.coalesce(F.lag(turn).over(around), F.last(turn).over(whole))
    turns = into.unionByName(out).withColumn("before", before)
    even = F.col("into").isNull() != F.col("before.into").isNull()
    return turns.select(key, F.col("into").alias("id"), F.col("before.out").alias("next"), even.alias("even"))


def _linked(key: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pieces of whole keys that have rings: which pieces, and each one's ring number within its key, place and ``hole``.

    The same steps as by joins: pieces at a corner take turns, and pointers double along the rings.
    """
    n, (x0, y0, x1, y1) = len(key), ends
    ids = np.arange(n)
    dx, dy = x1 - x0, y1 - y0
    whose, vx, vy = np.tile(key, 2), np.concatenate([x1, x0]), np.concatenate([y1, y0])
    angle = np.concatenate([np.arctan2(-dy, -dx), np.arctan2(dy, dx)])
    into, piece = np.repeat([1, 0], n), np.tile(ids, 2)
    order = np.lexsort((piece, into, angle, vy, vx, whose))
    whose, vx, vy, into, piece = (v[order] for v in (whose, vx, vy, into, piece))
    new = np.concatenate([[True], (whose[1:] != whose[:-1]) | (vx[1:] != vx[:-1]) | (vy[1:] != vy[:-1])])
    starts = np.flatnonzero(new)
    before = np.arange(2 * n) - 1
    before[starts] = np.append(starts[1:], 2 * n) - 1
    torn = np.unique(whose[into == into[before]])
    following = np.zeros(n, dtype=np.int64)
    following[piece[into == 1]] = piece[before[into == 1]]
    kept = np.flatnonzero(~np.isin(key, torn))
    place = np.cumsum(~np.isin(key, torn)) - 1
    after, key, ends = place[following[kept]], key[kept], ends[:, kept]
    x0, y0, x1, y1 = ends
    ids = np.arange(len(kept))
    jump, low = after, np.minimum(ids, after)
    while True:
        was, low, jump = low, np.minimum(low, low[jump]), jump[jump]
        if (low == was).all():
            break
    # rings by key and least corner, so that the first piece of each ring is its start
    order = np.lexsort((ids, y1, x1, y0, x0, low))
    first = order[np.concatenate([[True], low[order][1:] != low[order][:-1]])] if len(ids) else order
    rings = first[np.lexsort((low[first], y1[first], x1[first], y0[first], x0[first], key[first]))]
    begun = np.concatenate([[True], key[rings][1:] != key[rings][:-1]]) if len(rings) else np.zeros(0, dtype=bool)
    number = np.zeros(len(ids), dtype=np.int64)
    number[low[rings]] = np.arange(len(rings)) - np.maximum.accumulate(np.where(begun, np.arange(len(rings)), 0)) + 1
    back, steps = np.empty_like(after), np.ones(len(ids), dtype=np.int64)
    back[after] = ids
    back[first], steps[first] = first, 0
    while (steps[back] > 0).any():
        steps, back = steps + steps[back], back[back]
    turning = np.bincount(low, x0 * (y1 - y0) - y0 * (x1 - x0), len(ids))
    return kept, number[low], steps + 1, turning[low] < 0


def _gathered_rings(outline: DataFrame, key: str) -> DataFrame:
    """The rings of keys whose pieces fit a row each, linked in one task."""
    kind = outline.schema[key].dataType
    schema = StructType().add(key, kind).add("ring", LongType()).add("seq", LongType()).add("x", DoubleType()).add("y", DoubleType()).add("hole", BooleanType())

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, at = lists.flatten(), np.diff(lists.offsets.to_numpy())
            ends = np.array([c.to_numpy(zero_copy_only=False) for c in flat.flatten()])
            owner = np.repeat(np.arange(len(at)), at)
            if len(owner):
                kept, ring, seq, hole = _linked(owner, ends)
                columns = batch.column(0).take(pa.array(owner[kept])), ring, seq, ends[0][kept], ends[1][kept], hole
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=schema.names)

    return outline.groupBy(key).agg(F.collect_list(F.struct(*ENDS)).alias("pieces")).mapInArrow(link, schema)


def outline_rings(pieces: DataFrame, key: str) -> DataFrame:
    """``key``, ``ring``, ``seq``, ``x``, ``y`` and ``hole``: the corners of the outline's rings in order.

    ``pieces`` comes from ``union_pieces``. Rings run with the ground on their left and begin at their least corner, by x and
    then y; the rings of a key are numbered from 1 by that corner. A hole is a ring that runs clockwise. A hole that
    touches the ring around it in one corner is linked with it. Where parcels overlap in part, their outlines do not
    pair up at some corner, and the key has no rings; ``dissolve_area`` marks such keys.
    """
    ahead = F.col("left") > 0
    swap = {"x0": "x1", "y0": "y1", "x1": "x0", "y1": "y0"}
    outline = pieces.where(on_outline())
    outline = outline.select(key, *(F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in swap.items()))
    outline = stored(outline, "outline")
    odd = F.col(key).isNull()
    for end in ENDS:
        odd = odd | F.col(end).isNull() | F.isnan(end)
    large = outline.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.bool_or(odd).alias("odd")).where((F.col("n") > ROW_PIECES) | F.col("odd"))
    large = stored(large.select(F.col(key).alias(f"_on_{key}")), "large-outlines")
    if large.isEmpty():
        return _gathered_rings(outline, key)
    same = matching(outline, large, [key], null_safe=True)
    rest = _joined_rings(outline.join(large, same, "left_semi"), key)
    return _gathered_rings(outline.join(large, same, "left_anti"), key).unionByName(rest)


def _joined_rings(outline: DataFrame, key: str) -> DataFrame:
    """The rings of keys with very many pieces, by joins on the pieces' numbers."""
    outline = stored(outline.withColumn("id", F.monotonically_increasing_id()), "outline")
    turns = stored(_following(outline, key), "turns")
    torn = turns.where(~F.col("even")).select(F.col(key).alias("_key")).distinct()
    after = turns.where("id IS NOT NULL").join(torn, F.col(key).eqNullSafe(F.col("_key")), "left_anti").select("id", "next")
    after = stored(after, "after")
    named = after.select("id").join(_ring_of(after), "id").join(outline, "id")
    twice = F.col("x0") * (F.col("y1") - F.col("y0")) - F.col("y0") * (F.col("x1") - F.col("x0"))
    corner = F.struct("x0", "y0", "x1", "y1", "id")
    rings = named.groupBy("ring", key).agg(F.min(corner).alias("start"), (F.sum(twice) < 0).alias("hole"))
    rings = stored(rings.select("ring", key, "hole", "start.*"), "ring-starts")
    order = numbered(rings.select("ring", key, *ENDS), ENDS, within=[key], name="number").select("ring", "number")
    rings = rings.select("ring", "hole", "id").join(order, "ring")
    places = _place_of(after, rings)
    found = named.join(places, "id").select(key, "ring", "seq", F.col("x0").alias("x"), F.col("y0").alias("y"))
    counts = found.groupBy("ring").count()
    found = lookup_join(found, rings.select("ring", "number", "hole"), ["ring"], "inner", counts=counts)
    return found.select(key, F.col("number").alias("ring"), "seq", "x", "y", "hole")

