"""Applications placed on the parcels their id list names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import known, pid_list, primary_pid
from acreage.operators.outlines import ENDS, directed_edges, on_outline, outline_rings, union_pieces
from acreage.operators.parcels import parcel_point, wanted_parcels
from acreage.operators.spread import lookup_join
from acreage.session import stored

KEY = "Planning_App_Num"


def split_pid(applications: DataFrame, pid_field: str = "PIDs") -> DataFrame:
    """Applications with their clean id list and whether there is one."""
    clean = known(F.col(pid_field).cast("string"))
    return applications.withColumn(pid_field, clean).withColumn(
        "pid_status", F.when(F.col(pid_field).isNull(), "no_pid").otherwise("has_pid")
    )


def listed_parcels(applications: DataFrame, pid_field: str = "PIDs", key: str = KEY) -> DataFrame:
    """One row per application and distinct parcel id."""
    pids = F.array_distinct(pid_list(known(F.col(pid_field).cast("string"))))
    return applications.select(key, F.explode(pids).alias("PID"))


def union_of_parcels(
    applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs", key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    """How many of each application's listed parcels exist, and the pieces of their sides."""
    listed = stored(listed_parcels(applications, pid_field, key), "listed-parcels")
    edges = stored(directed_edges(wanted_parcels(vertices, listed)), "directed-edges")
    there = lookup_join(listed, edges.select("PID").distinct(), ["PID"], "left_semi", probe=True)
    return there.groupBy(key).agg(F.count(F.lit(1)).alias("pids_found")), union_pieces(listed, edges, key)


def dissolve_outline(
    applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs", key: str = KEY
) -> DataFrame:
    """Pieces of the outline of the union of an application's parcels, each with its lesser end first."""
    _, pieces = union_of_parcels(applications, vertices, pid_field, key)
    return pieces.where(on_outline()).select(key, *ENDS)


def _areas(found: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    twice = F.col("x0") * (F.col("y1") - F.col("y0")) - F.col("y0") * (F.col("x1") - F.col("x0"))
    only = lambda value: F.sum(F.when(on_outline(), value).otherwise(0.0))
    sums = pieces.groupBy(key).agg(
        (only(F.when(F.col("left") > 0, twice).otherwise(-twice)) / 2).alias("area"),
        only(length).alias("perimeter"),
        F.count_if(on_outline()).alias("n_edges"),
        (F.max(F.greatest("left", "right")) <= 1).alias("dissolve_check"),
    )
    return found.join(sums, key).select(key, "area", "pids_found", "perimeter", "n_edges", "dissolve_check")


def dissolve_area(applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs", key: str = KEY) -> DataFrame:
    """Area and perimeter of the union; ``dissolve_check`` is false when two parcels lie on one side of an edge.

    Parcels that are equal count once. Where parcels overlap in part, sides inside another parcel are not taken away.
    """
    return _areas(*union_of_parcels(applications, vertices, pid_field, key), key)


def app_outline_rings(
    applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs", key: str = KEY
) -> DataFrame:
    """The polygons of applications: corners of the rings around the union of their parcels."""
    return outline_rings(union_of_parcels(applications, vertices, pid_field, key)[1], key)


def locate_apps_polygon(
    applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs", key: str = KEY
) -> DataFrame:
    """Applications with the union of their parcels; any parcel found locates the application."""
    return _with_areas(applications, dissolve_area(applications, vertices, pid_field, key), pid_field, key)


def locate_apps_with_rings(
    applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs", key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    """``locate_apps_polygon`` and ``app_outline_rings`` from one pass over the parcels."""
    found, pieces = union_of_parcels(applications, vertices, pid_field, key)
    pieces = stored(pieces, "union-pieces")
    return _with_areas(applications, _areas(found, pieces, key), pid_field, key), outline_rings(pieces, key)


def _with_areas(applications: DataFrame, areas: DataFrame, pid_field: str, key: str) -> DataFrame:
    located = split_pid(applications, pid_field).join(areas, key, "left")
    return located.select(
        *applications.columns,
        F.when(F.col("pid_status") == "no_pid", "no_pid")
        .when(F.col("pids_found").isNull(), "unlocated")
        .otherwise("located")
        .alias("status"),
        F.size(F.array_distinct(pid_list(F.col(pid_field)))).alias("pids_total"),
        F.coalesce("pids_found", F.lit(0)).alias("pids_found"),
        "area",
        "perimeter",
        "n_edges",
        "dissolve_check",
    )


def locate_apps_point(applications: DataFrame, vertices: DataFrame, pid_field: str = "PIDs") -> DataFrame:
    """Applications with the point of their first parcel."""
    rows = split_pid(applications, pid_field).withColumn("primary_pid", primary_pid(F.col(pid_field)))
    wanted = wanted_parcels(vertices, rows.select(F.col("primary_pid").alias("PID")))
    points = stored(parcel_point(wanted)).select(F.col("PID").alias("primary_pid"), "x", "y")
    placed = lookup_join(rows, points, ["primary_pid"], probe=True)
    return placed.select(
        *applications.columns,
        "primary_pid",
        F.when(F.col("pid_status") == "no_pid", "no_pid")
        .when(F.col("x").isNull(), "unlocated")
        .otherwise("located")
        .alias("status"),
        "x",
        "y",
    )


def locate_applications(applications: DataFrame, vertices: DataFrame, mode: str, pid_field: str = "PIDs") -> DataFrame:
    """Applications located as ``POLYGON`` or as ``POINT``."""
    if mode == "POLYGON":
        return locate_apps_polygon(applications, vertices, pid_field)
    return locate_apps_point(applications, vertices, pid_field)


def pid_coverage(applications: DataFrame, parcels: DataFrame, pid_field: str = "PIDs", key: str = KEY) -> DataFrame:
    """How many distinct parcel ids are listed, and how many of them exist."""
    listed = listed_parcels(applications, pid_field, key).select("PID").distinct()
    there = parcels.select("PID").distinct().withColumn("found", F.lit(True))
    return listed.join(there, "PID", "left").agg(
        F.count(F.lit(1)).alias("n_pids"),
        F.count_if(F.col("found").isNotNull()).alias("n_found"),
        F.round(F.count_if(F.col("found").isNotNull()) / F.count(F.lit(1)), 6).alias("ratio"),
    )


def application_failures(located: DataFrame, pid_field: str = "PIDs") -> DataFrame:
    """The report of applications without a place, one section per reason."""
    return located.where(F.col("status") != "located").select(
        F.when(F.col("status") == "no_pid", "No_PID").otherwise("Unlocated_PID").alias("section"), KEY, pid_field
    )
