"""Writing tables: guarded loads, copies for publication, reports.

A table is a folder of versions. A load writes a new version beside the others and then renames a manifest into place,
which names the parts that make up the table now. Readers go by the latest manifest, so they see the old table until the
rename and the new one after it; a load that ends midway leaves a part that no manifest names. A folder without a
manifest is a plain Parquet table, and the first load leaves its files as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acreage.sources.tables import appended, empty_like

# Fixed value: where versions and manifests are kept; other readers of the folder pass over the name.
VERSIONS = "_versions"


class Manifest(NamedTuple):
    """What a table consists of: its number, part folders, rows and schema."""

    number: int
    parts: list[str]
    rows: int
    schema: str


def _file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and a way to name paths in it."""
    jvm = spark.sparkContext._jvm
    at = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join([path, VERSIONS, *names]))
    return at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def manifests(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the table's manifests, rising."""
    files, at = _file_system(spark, path)
    if not files.exists(at()):
        return []
    names = [f.getPath().getName() for f in files.listStatus(at())]
    return sorted(int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-"))


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """The latest manifest of a table, or the one with a number; None when there is none."""
    numbers = manifests(spark, path)
    if not numbers:
        return None
    number = numbers[-1] if number is None else number
    text = spark.read.text(f"{path}/{VERSIONS}/manifest-{number:010d}", wholetext=True).first()[0]
    return Manifest(number, **json.loads(text))


def stored(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The table at ``path`` by its latest manifest, or by an earlier one; None when there is none."""
    known = manifest(spark, path, number)
    if known is not None:
        schema = StructType.fromJson(json.loads(known.schema))
        folders = [f"{path}/{VERSIONS}/{p}" for p in known.parts]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a table: its manifest has them, and for a plain table Spark takes them from the file footers."""
    known = manifest(spark, path)
    if known is not None:
        return known.rows
    plain = stored(spark, path)
    return 0 if plain is None else plain.count()


def publish(rows: DataFrame, path: str, append: bool = False, empty: bool = True) -> tuple[int, int]:
    """Write ``rows`` as the table's new version, or as one more part of it; returns the row counts before and after.

    Rows are counted while they are written. With ``empty`` false, a table is not replaced by no rows.
    """
    spark = rows.sparkSession
    files, at = _file_system(spark, path)
    old, before = manifest(spark, path), row_count(spark, path)
    part, seen = uuid.uuid4().hex, Observation()
    if append and old is None and before:
        # the first part is a plain table's rows
        rows = stored(spark, path).unionByName(rows)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{VERSIONS}/{part}")
    written = seen.get["n"]
    if append and old is None:
        written -= before
    if not written and (append or not empty):
        files.delete(at(part), True)
        return before, before
    kept = append and old is not None
    entry = {"parts": [*old.parts, part] if kept else [part], "rows": written + (before if append else 0), "schema": rows.schema.json()}
    number = 1 + (old.number if old else 0)
    draft, final = at(f"draft-{part}"), at(f"manifest-{number:010d}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(entry), "utf-8"))
    stream.close()
    # another load in the meantime has taken the number
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"{path} was loaded by another run at the same time")
    return before, entry["rows"]


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete what the last ``keep`` manifests do not name: older manifests, their parts, and parts of failed loads."""
    numbers = manifests(spark, path)[-max(1, keep) :]
    files, at = _file_system(spark, path)
    kept = {f"manifest-{n:010d}" for n in numbers}
    kept |= {part for n in numbers for part in manifest(spark, path, n).parts}
    gone = [f.getPath().getName() for f in files.listStatus(at())] if numbers else []
    gone = sorted(n for n in gone if n.strip(".").removesuffix(".crc") not in kept)
    for name in gone:
        files.delete(at(name), True)
    return gone


def load(rows: DataFrame, path: str) -> tuple[int, int]:
    """Replace a table's rows, by none if there are none; returns the row counts before and after."""
    target = stored(rows.sparkSession, path)
    return publish(rows if target is None else appended(empty_like(target), rows), path)


def load_guarded(rows: DataFrame, path: str, truncate: bool = True) -> tuple[int, int]:
    """Load a table if there is anything to load; returns the row counts before and after."""
    target = stored(rows.sparkSession, path)
    rows = rows if target is None else appended(empty_like(target), rows)
    return publish(rows, path, append=not truncate, empty=False)


def replicate(tables: Mapping[str, DataFrame], folder: str, strict: bool = False) -> list[tuple[str, int, int]]:
    """Reload the published copy of each table; returns name and row counts before and after.

    A lenient copy skips tables that are not published yet and matches columns by name. A strict copy publishes
    them all and needs equal schemas where there is a table already.
    """
    counts = []
    for name, rows in tables.items():
        path = f"{folder}/{name}"
        target = stored(rows.sparkSession, path)
        if target is None and not strict:
            continue
        if target is not None:
            rows = appended(empty_like(target), rows, strict=strict)
        counts.append((name, *publish(rows, path)))
    return counts


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(failed: DataFrame, path: str) -> bool:
    """One folder of CSV files per section; sections without rows do not appear.

    With nothing to report, False, an empty report takes the place of an earlier one.
    """
    failed.write.mode("overwrite").partitionBy("section").option("header", True).csv(path)
    return not failed.isEmpty()
