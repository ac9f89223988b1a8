"""Parcel geometry from a table of vertices ``(PID, ring, seq, x, y)``.

Every measure is a sum over edges. Coordinates are taken relative to the parcel's first vertex, because products
of full grid coordinates lose digits. Rings need not be closed; holes wind against the outer ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.operators.spread import linked_rows, lookup_join
from acreage.session import BLOCK_ROWS, setting, stored


def first_parcels(vertices: DataFrame, object_id: str) -> DataFrame:
    """The vertices of one parcel row per id, the row with the lowest object id."""
    lowest = vertices.groupBy("PID").agg(F.min(object_id).alias("_lowest"))
    kept = lookup_join(vertices, lowest, ["PID"], "inner")
    return kept.where(F.col(object_id) == F.col("_lowest")).drop("_lowest", object_id)


def wanted_parcels(vertices: DataFrame, pids: DataFrame) -> DataFrame:
    """The vertices of the parcels named in ``pids``: no others need geometry."""
    return vertices.join(pids.select("PID").where("PID IS NOT NULL").distinct(), "PID", "left_semi").select(*vertices.columns)


def edges(vertices: DataFrame) -> DataFrame:
    """Edges in the parcel's own frame, with the frame's origin."""
    block = F.floor(F.col("seq") / setting(vertices.sparkSession, BLOCK_ROWS))
    rows = linked_rows(vertices, ["PID", "ring"], block, ["seq"], ["x", "y"], wrap=True, anchor=["PID"])
    ox, oy = F.col("first.x"), F.col("first.y")
    return rows.select(
        "PID",
        "ring",
        "seq",
        ox.alias("ox"),
        oy.alias("oy"),
        (F.col("x") - ox).alias("x0"),
        (F.col("y") - oy).alias("y0"),
        (F.col("next.x") - ox).alias("x1"),
        (F.col("next.y") - oy).alias("y1"),
    )


def measures_of(edge_rows: DataFrame) -> DataFrame:
    """Area, perimeter, centroid and extent per parcel, in one partial aggregate."""
    cross = F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")
    sums = edge_rows.groupBy("PID").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("ox").alias("ox"),
        F.min("oy").alias("oy"),
        F.sum(cross).alias("twice"),
        F.sum((F.col("x0") + F.col("x1")) * cross).alias("mx"),
        F.sum((F.col("y0") + F.col("y1")) * cross).alias("my"),
        F.sum(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))).alias("perimeter"),
        F.min("y0").alias("y_low"),
        F.max("y0").alias("y_high"),
        F.min("x0").alias("x_low"),
        F.max("x0").alias("x_high"),
    )
    twice = F.nullif(F.col("twice"), F.lit(0.0))
    return sums.withColumns(
        {"area": F.abs("twice") / 2, "cx": F.col("mx") / (3 * twice), "cy": F.col("my") / (3 * twice)}
    ).drop("twice", "mx", "my")


def parcel_measures(vertices: DataFrame) -> DataFrame:
    return measures_of(edges(vertices)).select("PID", "area", "perimeter")


def parcel_centroid(vertices: DataFrame) -> DataFrame:
    found = measures_of(edges(vertices))
    return found.select("PID", (F.col("ox") + F.col("cx")).alias("x"), (F.col("oy") + F.col("cy")).alias("y"))


def _crossing(height: str) -> tuple[Column, Column]:
    """Whether an edge crosses a height, and where; null when it does not."""
    y0, y1, h = F.col("y0"), F.col("y1"), F.col(height)
    crosses = (y0 > h) != (y1 > h)
    return crosses, F.when(crosses, F.col("x0") + (h - y0) * (F.col("x1") - F.col("x0")) / (y1 - y0))


def _tested(edge_rows: DataFrame) -> DataFrame:
    """Per parcel the centroid test and the scan height, with the measures they need.

    The scan height lies between the two vertex heights around the middle, so no vertex lies on it.
    """
    found = stored(measures_of(edge_rows))
    counts = found.select("PID", "count")
    joined = lookup_join(edge_rows.drop("ox", "oy"), found, ["PID"], "inner", counts=counts, probe=True)
    middle = (F.col("y_low") + F.col("y_high")) / 2
    crosses, at = _crossing("cy")
    tests = joined.groupBy("PID").agg(
        F.coalesce(F.sum((crosses & (F.col("cx") < at)).cast("int")) % 2 == 1, F.lit(False)).alias("inside"),
        F.max(F.when(F.col("y0") <= middle, F.col("y0"))).alias("below"),
        F.min(F.when(F.col("y0") > middle, F.col("y0"))).alias("above"),
        *(F.min(c).alias(c) for c in ("ox", "oy", "cx", "cy", "x_low", "x_high", "count")),
    )
    return tests.withColumn("scan", (F.col("below") + F.col("above")) / 2).drop("below", "above")


def centroid_inside(vertices: DataFrame) -> DataFrame:
    return _tested(stored(edges(vertices))).select("PID", "inside")


def _label_points(edge_rows: DataFrame, tests: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Middle of the widest inside span of each parcel's scan line, in the parcel's frame; the leftmost of equals."""
    scans = (tests if wanted is None else tests.where(wanted)).select("PID", "scan", "x_low", "x_high")
    counts = tests.select("PID", "count")
    # as many blocks as a parcel's edges ask for
    size = setting(edge_rows.sparkSession, BLOCK_ROWS)
    scans = scans.join(counts.select("PID", F.ceil(F.col("count") / size).alias("blocks")), "PID")
    lines = lookup_join(edge_rows, scans, ["PID"], "inner", counts=counts, probe=True)
    crosses, at = _crossing("scan")
    cuts = lines.where(crosses).select("PID", "scan", at.alias("cut"), "x_low", "x_high", "blocks", "ring", "seq")
    width = F.greatest(F.col("x_high") - F.col("x_low"), F.lit(1e-9))
    block = F.floor((F.col("cut") - F.col("x_low")) / width * F.col("blocks"))
    spans = linked_rows(cuts, ["PID"], block, ["cut", "ring", "seq"], ["scan"]).where("rank % 2 = 1")
    best = spans.groupBy("PID").agg(
        F.max(F.struct((F.col("next.cut") - F.col("cut")).alias("width"), (-F.col("cut")).alias("left"))).alias("best"),
        F.min("scan").alias("ly"),
    )
    return best.select("PID", (F.col("best.width") / 2 - F.col("best.left")).alias("lx"), "ly")


def parcel_label_point(vertices: DataFrame) -> DataFrame:
    """A point inside each parcel."""
    rows = stored(edges(vertices))
    tests = stored(_tested(rows))
    labels = _label_points(rows.drop("ox", "oy"), tests)
    origin = tests.select("PID", "ox", "oy")
    return labels.join(origin, "PID").select(
        "PID", (F.col("ox") + F.col("lx")).alias("x"), (F.col("oy") + F.col("ly")).alias("y")
    )


def parcel_point(vertices: DataFrame) -> DataFrame:
    """Where a parcel is placed as a point: its centroid when that is inside, else its label point."""
    rows = stored(edges(vertices))
    tests = stored(_tested(rows))
    labels = _label_points(rows.drop("ox", "oy"), tests, ~F.col("inside"))
    placed = tests.join(labels, "PID", "left")
    return placed.select(
        "PID",
        (F.col("ox") + F.when(F.col("inside"), F.col("cx")).otherwise(F.col("lx"))).alias("x"),
        (F.col("oy") + F.when(F.col("inside"), F.col("cy")).otherwise(F.col("ly"))).alias("y"),
        F.when(F.col("inside"), "centroid").otherwise("label").alias("kind"),
    )


def street_points(segments: DataFrame) -> DataFrame:
    """Centroid of each street line, its pieces' middles weighted by length."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    sums = segments.groupBy("FDMID").agg(
        F.sum(length).alias("n"),
        F.sum(length * mx).alias("mx"),
        F.sum(length * my).alias("my"),
        F.avg(mx).alias("ax"),
        F.avg(my).alias("ay"),
    )
    return sums.select(
        "FDMID",
        F.when(F.col("n") > 0, F.col("mx") / F.col("n")).otherwise(F.col("ax")).alias("x"),
        F.when(F.col("n") > 0, F.col("my") / F.col("n")).otherwise(F.col("ay")).alias("y"),
    )

