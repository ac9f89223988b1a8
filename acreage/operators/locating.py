"""Permits placed on the map: by civic id, by address, by parcel, or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import padded
from acreage.operators.addresses import ADDRESS, SCORE_MINIMUM, address_key, match_addresses
from acreage.operators.cleaning import route
from acreage.operators.parcels import parcel_point, street_points, wanted_parcels
from acreage.operators.spread import first_per_key, fits_broadcast, lookup_join, salted_join
from acreage.session import stored


def civic_join(permits: DataFrame, civics: DataFrame, id_field: str = "Civic_ID") -> DataFrame:
    """Permits with the point of each civic that has their id; one row per pair, as civic ids may repeat.

    A small civic table is broadcast. Otherwise only the permits that name a repeated id, found by an aggregate of the
    civics, go into the join of many to many, whose heavy keys are cut into shares on both sides; the others take the
    balanced lookup. The output is as large as its pairs.
    """
    points = civics.select(F.col("CIV_ID").alias(id_field), "X", "Y")
    if fits_broadcast(civics):
        return permits.join(F.broadcast(points), id_field).select(*permits.columns, "X", "Y")
    per_id = points.groupBy(id_field).agg(
        F.count(F.lit(1)).alias("n"), F.min("X").alias("X"), F.min("Y").alias("Y")
    )
    single = lookup_join(permits, per_id.where("n = 1").select(id_field, "X", "Y"), [id_field], "inner")
    repeated = stored(per_id.where("n > 1").select(id_field), "repeated-ids")
    many = points.join(repeated, id_field, "left_semi")
    pairs = salted_join(permits.join(repeated, id_field, "left_semi"), many, on=[id_field], by=permits.columns)
    return single.unionByName(pairs.select(*single.columns))


def civic_unjoined(permits: DataFrame, civics: DataFrame, id_field: str = "Civic_ID") -> DataFrame:
    """Permits with an id that no civic has."""
    ids = stored(civics.select(F.col("CIV_ID").alias(id_field)).distinct(), "civic-ids")
    return lookup_join(permits.where(F.col(id_field).isNotNull()), ids, [id_field], "left_anti", probe=True)


def retired_civic_join(
    permits: DataFrame, civics: DataFrame, retired: DataFrame, id_field: str = "Civic_ID"
) -> DataFrame:
    """Permits without a civic, with the point of the retired civic of that id, null when there is none."""
    points = retired.select(F.col("CIV_ID").alias(id_field), "X", "Y")
    one_each = stored(first_per_key(points, [id_field], [F.col("X"), F.col("Y")]), "retired-civics")
    return lookup_join(civic_unjoined(permits, civics, id_field), one_each, [id_field], probe=True)


def pid_points(permits: DataFrame, points: DataFrame) -> DataFrame:
    """Permits with the point of their parcel, and whether they are located, unlocated or without a parcel id.

    ``points`` is a stored table.
    """
    keyed = permits.withColumn("PID", padded(F.col("PID")))
    placed = lookup_join(keyed, points.select("PID", "x", "y"), ["PID"], probe=True)
    return placed.withColumn(
        "status",
        F.when(F.col("PID").isNull(), "no_pid").when(F.col("x").isNull(), "pid_not_found").otherwise("located"),
    )


def street_segment_points(permits: DataFrame, segments: DataFrame, id_field: str = "HRM_ID") -> DataFrame:
    """Permits with the centroid of the street segment that has their id."""
    points = stored(street_points(segments).withColumnRenamed("FDMID", id_field), "street-points")
    placed = lookup_join(permits, points, [id_field], probe=True)
    return placed.withColumn(
        "status",
        F.when(F.col(id_field).isNull(), "no_id").when(F.col("x").isNull(), "unlocated").otherwise("located"),
    )


def civic_points(active: DataFrame, retired: DataFrame) -> DataFrame:
    """One point per civic id, an active civic going before a retired one."""
    both = active.select("CIV_ID", "X", "Y", F.lit("1_civic").alias("source")).unionByName(
        retired.select("CIV_ID", "X", "Y", F.lit("2_retired_civic").alias("source"))
    )
    return first_per_key(both, ["CIV_ID"], [F.col("source"), F.col("X"), F.col("Y")])


def locate_permits(
    unique: DataFrame,
    active: DataFrame,
    retired: DataFrame,
    vertices: DataFrame,
    id_field: str = "Civic_ID",
    score_minimum: int = SCORE_MINIMUM,
) -> DataFrame:
    """One row per unique permit: route, method, point, and the reason when there is no point.

    Each stage is one lookup over all rows; rows that do not need it have no key there and are spread out.
    A permit whose civic id is unknown is not tried in other ways. A permit whose address has no match falls
    through to its parcel. A permit with part of an address is reported, not dropped.
    """
    columns = unique.columns
    by_address = F.col("route") == "2_address"
    keys = dict(zip(ADDRESS, address_key("Civic_Number", "Street_Name", "Community"), strict=True))
    routed = unique.withColumn("route", route(id_field)).withColumn("PID", padded(F.col("PID")))
    rows = unique = stored(routed.withColumns({name: F.when(by_address, key) for name, key in keys.items()}))

    by_id = civic_points(active, retired).select(
        F.col("CIV_ID").alias(id_field), F.col("X").alias("civic_x"), F.col("Y").alias("civic_y"), "source"
    )
    by_id = stored(by_id, "civic-points")
    rows = lookup_join(rows, by_id, [id_field], probe=True)

    civics = active.select("CIV_ID", *address_key("FULL_CIVIC", "STR_NAME", "GSA_NAME"), "X", "Y")
    wanted = unique.where(by_address).select(*ADDRESS)
    matches = stored(match_addresses(wanted, civics, score_minimum))
    rows = lookup_join(rows, matches, ADDRESS, probe=True, keyed_like=wanted)

    placeable = unique.where(F.col("route").isin("2_address", "3_pid"))
    vertices = wanted_parcels(vertices, placeable)
    by_parcel = (F.col("route") == "3_pid") | (by_address & F.col("match_x").isNull())
    rows = rows.withColumn("parcel_key", F.when(by_parcel, F.col("PID")))
    points = stored(parcel_point(vertices)).select(F.col("PID").alias("parcel_key"), "x", "y")
    named = placeable.select(F.col("PID").alias("parcel_key"))
    rows = lookup_join(rows, points, ["parcel_key"], probe=True, keyed_like=named)

    method = (
        F.when(F.col("source").isNotNull(), F.substring("source", 3, 20))
        .when(F.col("match_x").isNotNull(), "address")
        .when(F.col("x").isNotNull(), "parcel")
    )
    reason = (
        F.when(F.col("route") == "1_civic_id", "civic_id_not_found")
        .when(F.col("route") == "4_none", "no_location_info")
        .when(F.col("route") == "5_partial", "partial_address")
        .when(F.col("PID").isNull(), "no_pid")
        .otherwise("pid_not_found")
    )
    return rows.withColumn("method", method).select(
        *columns,
        "route",
        "method",
        F.when(F.col("method").isNull(), reason).alias("reason"),
        F.when(F.col("method") == "address", F.col("score")).alias("score"),
        F.coalesce("civic_x", "match_x", "x").alias("X"),
        F.coalesce("civic_y", "match_y", "y").alias("Y"),
    )


def uncategorised(located: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Placed permits that no category's table takes, as rows of the report."""
    known = F.coalesce(F.col("Permit_Category").isin(*categories), F.lit(False))
    return located.where(F.col("method").isNotNull() & ~known).select(
        F.lit("Unknown_Category").alias("section"), "Permit_Category", "Permit_Number", "PID", F.lit("unknown_category").alias("reason")
    )


def failures(located: DataFrame) -> DataFrame:
    """The report of permits without a point, one section per category and a reason per row."""
    table = F.concat(F.lit("LND_PPLC_"), F.col("Permit_Category"), F.lit("_Permits_failed_locates"))
    section = F.replace(
        F.replace(table, F.lit("LND_PPLC_"), F.lit("")), F.lit("_failed_locates"), F.lit("_fails")
    )
    return located.where(F.col("method").isNull()).select(
        section.alias("section"), "Permit_Category", "Permit_Number", "PID", "reason"
    )
