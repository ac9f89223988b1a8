"""The two jobs end to end: permits and applications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import SHORT_NAMES
from acreage.operators import applications as apps
from acreage.operators import cleaning, duplicates, locating, syncing
from acreage.operators.parcels import first_parcels
from acreage.session import stored
from acreage.sources import sinks


class PermitTables(NamedTuple):
    """Where the permit job's inputs come from."""

    permits: DataFrame
    active_civics: DataFrame
    retired_civics: DataFrame
    parcel_vertices: DataFrame


class PermitResult(NamedTuple):
    located: DataFrame
    related: DataFrame


class ApplicationSource(NamedTuple):
    """One source of applications: its published name, rows, field map and the column that lists parcel ids."""

    name: str
    rows: DataFrame
    fields: Mapping[str, str]
    pid_field: str = "PIDs"


def split_and_locate(tables: PermitTables, ties: Sequence[str]) -> PermitResult:
    """Clean permits, split off the related table, and place one row per permit by the id its category goes by."""
    clean = cleaning.clean_permits(cleaning.located_by(tables.permits), "locator_id")
    unique = duplicates.permits_unique(clean, ties)
    related = duplicates.related_table(unique, duplicates.related_rows(clean, ties))
    located = locating.locate_permits(
        unique.drop("Occupancy_Type"), tables.active_civics, tables.retired_civics, tables.parcel_vertices, "locator_id"
    )
    return PermitResult(located, related)


def permit_table(category: str) -> str:
    """The published name of a category's permits."""
    name = f"LND_PPLC_{category}_Permits"
    return SHORT_NAMES.get(name, name)


def published_permits(located: DataFrame, category: str) -> DataFrame:
    """A category's placed permits with the columns it publishes, its own name for the id, and global ids."""
    own_id = cleaning.SEGMENT_ID if category in cleaning.SEGMENT_CATEGORIES else cleaning.CIVIC_ID
    rows = located.where((F.col("Permit_Category") == category) & F.col("method").isNotNull())
    rows = cleaning.pruned(rows, category).withColumnRenamed("locator_id", own_id)
    rows = rows.drop("id_kind", "FORMATTEDADDRESS", "reason")
    return syncing.with_global_ids(rows, permit_table(category), duplicates.KEYS)


def run_permits(tables: PermitTables, ties: Sequence[str], folder: str, publish: str) -> None:
    """The whole permit job: load the edited tables, write the failure report, publish strict copies.

    A placed permit of no known category is in none of the tables and therefore in the report.

    The tables are loaded even when a run places nothing, so that no permit of an earlier run stays behind.
    """
    result = split_and_locate(tables, ties)
    spark = tables.permits.sparkSession
    # the placed permits feed several outputs, so they are written once and read back
    placed = f"{folder}/placed"
    result.located.write.mode("overwrite").parquet(placed)
    located = spark.read.parquet(placed)
    names = [permit_table(category) for category in cleaning.UNPUBLISHED]
    for category, name in zip(cleaning.UNPUBLISHED, names):
        sinks.load(published_permits(located, category), f"{folder}/{name}")
    sinks.load(result.related, f"{folder}/permit_info")
    lost = locating.failures(located).unionByName(locating.uncategorised(located, list(cleaning.UNPUBLISHED)))
    sinks.write_report(lost, f"{folder}/failed_locates")
    sinks.replicate({name: sinks.stored(spark, f"{folder}/{name}") for name in (*names, "permit_info")}, publish, strict=True)


def run_applications(
    sources: Sequence[ApplicationSource], vertices: DataFrame, folder: str, publish: str, mode: str = "POLYGON"
) -> None:
    """The whole application job: place each source, load what was placed under its target names, report the rest.

    Of several parcel rows with one id the one with the lowest ``OBJECTID``, where ``vertices`` has that column, is
    taken. A source of which nothing is placed keeps its earlier load. Published copies are lenient. With ``POLYGON`` the
    polygons' corners are loaded beside the applications, as ``<name>_rings``.
    """
    if "OBJECTID" in vertices.columns:
        vertices = stored(first_parcels(vertices, "OBJECTID"))
    for name, rows, fields, pid_field in sources:
        spark, placed = rows.sparkSession, f"{folder}/{name}_placed"
        if mode == "POLYGON":
            whole, rings = apps.locate_apps_with_rings(rows, vertices, pid_field)
            sinks.load_guarded(rings, f"{folder}/{name}_rings")
        else:
            whole = apps.locate_applications(rows, vertices, mode, pid_field)
        whole.write.mode("overwrite").parquet(placed)
        found = spark.read.parquet(placed)
        located = found.where("status = 'located'")
        places = [c for c in located.columns if c not in rows.columns and c != "status"]
        mapped = {target: F.col(origin) for target, origin in fields.items() if origin in rows.columns}
        sinks.load_guarded(located.select(*(c.alias(t) for t, c in mapped.items()), *places), f"{folder}/{name}")
        sinks.write_report(apps.application_failures(found, pid_field), f"{folder}/{name}_failed_locates")
    names = [n for s in sources for n in (s.name, f"{s.name}_rings")]
    loaded = {name: sinks.stored(vertices.sparkSession, f"{folder}/{name}") for name in names}
    sinks.replicate({name: rows for name, rows in loaded.items() if rows is not None}, publish)
