"""Keeping a published copy in line with the edited one, and the ids of new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import guid, padded
from acreage.operators.spread import numbered
from acreage.session import stored
from acreage.sources import sinks

# Fixed value: digits of a padded sequence number.
SEQUENCE_DIGITS = 3
# Fixed value: width of the columns for user names.
USER_LENGTH = 32
# Ranges of key hashes whose digests are compared before any rows are.
RANGES = 4096


def _keyed(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    return df.select(*keys, F.struct(*values).alias(name))


def differing_ranges(rw: DataFrame, ro: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """The ranges of key hashes in which two copies differ, as a stored table of ``_range``.

    A range's digest is the count and the sums of two hashes of its rows; only digests are compared, at most
    ``ranges`` rows from each copy. Equal rows have equal digests. Different ranges with equal digests would need two
    sums of 64-bit hashes to agree by chance.
    """
    def digests(df: DataFrame, name: str) -> DataFrame:
        row = [F.col(c) for c in rw.columns]
        total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)"))
        made = df.groupBy(_range_of(keys, ranges).alias("_range"))
        return made.agg(F.struct(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")).alias(name))

    both = digests(rw, "_new").join(digests(ro, "_old"), "_range", "full_outer")
    return stored(both.where(~F.col("_new").eqNullSafe(F.col("_old"))).select("_range"), "differing-ranges")


def _range_of(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def sync_changes(rw: DataFrame, ro: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """The inserts, updates and deletes that turn ``ro`` into ``rw``; keys are unique in each copy.

    Both copies are cut into ranges by a hash of the key, and only rows of ranges with different digests are joined; where
    the copies are equal no row leaves its task. Rows without a key cannot match and go round the join.
    """
    keys = list(keys)
    values = [c for c in rw.columns if c not in keys]
    # one number per range, at most ``ranges`` of them
    unequal = F.broadcast(differing_ranges(rw, ro, keys, ranges))
    rw, ro = (df.join(unequal, _range_of(keys, ranges) == F.col("_range"), "left_semi") for df in (rw, ro))
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    ours, theirs = _keyed(rw, keys, values, "new"), _keyed(ro, keys, values, "old")
    paired = ours.where(has_key).join(theirs.where(has_key), keys, "full_outer")
    change = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(~F.col("old").eqNullSafe(F.col("new")), "update")
    )
    changed = paired.withColumn("change", change).where(F.col("change").isNotNull())
    loose = ours.where(~has_key).withColumns({"old": F.lit(None).cast(theirs.schema["old"].dataType), "change": F.lit("insert")})
    gone = theirs.where(~has_key).withColumns({"new": F.lit(None).cast(ours.schema["new"].dataType), "change": F.lit("delete")})
    rows = changed.unionByName(loose).unionByName(gone)
    kept = [F.when(F.col("change") == "delete", F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in values]
    return rows.select(*keys, *kept, "change")


def synced(ro: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ro`` after the changes. Rows without a key are all replaced, as the changes delete each of them."""
    keys = list(keys)
    stale = changes.where(F.col("change") != "insert").select(*(F.col(k).alias(f"_on_{k}") for k in keys)).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & ro[k].eqNullSafe(stale[f"_on_{k}"])
    kept = ro.join(stale, same, "left_anti")
    return kept.unionByName(changes.where(F.col("change") != "delete").select(*ro.columns))


def out_of_sync_ids(rw: DataFrame, ro: DataFrame, keys: Sequence[str], id_field: str) -> DataFrame:
    """Rows present in both copies whose id differs."""
    keys = list(keys)
    ours = rw.select(*keys, F.col(id_field).alias("rw_id"))
    theirs = ro.select(*keys, F.col(id_field).alias("ro_id"))
    return ours.join(theirs, keys).where(~F.col("rw_id").eqNullSafe(F.col("ro_id")))


def stamp_audit(changes: DataFrame, user: str, at: Column, user_length: int = USER_LENGTH) -> DataFrame:
    """Changes with who made them and when; the creation columns only for inserts.

    A user name longer than ``user_length``, the width of the source system's column, is cut.
    """
    who, when = F.lit(user).substr(1, user_length), at
    created = F.col("change") == "insert"
    touched = F.col("change").isin("insert", "update")
    return changes.withColumns(
        {
            "ADDBY": F.when(created, who),
            "ADDDATE": F.when(created, when),
            "MODBY": F.when(touched, who),
            "MODDATE": F.when(touched, when),
        }
    )


def with_global_ids(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("GlobalID", guid(F.lit(table), *(F.col(k).cast("string") for k in keys)))


def assign_sequence_ids(
    df: DataFrame, order: Sequence[str], field: str, prefix: str = "", start: int = 1, pad: bool = False
) -> DataFrame:
    """``field`` set to consecutive numbers from ``start`` in the given total order, as text after ``prefix``."""
    rows = numbered(df, order, name="_number").withColumn("_number", F.col("_number") + (start - 1))
    value = F.col("_number")
    if pad or prefix:
        text = value.cast("string")
        value = F.concat(F.lit(prefix), padded(text, SEQUENCE_DIGITS) if pad else text)
    return rows.withColumn(field, value).drop("_number")


def fill_sequence_ids(df: DataFrame, order: Sequence[str], field: str, marks: str, prefix: str = "", start: int = 1, pad: bool = False) -> DataFrame:
    """``df`` with ids for the rows whose ``field`` is null, numbered on from the highest number given so far.

    Other rows keep their id. The highest number is kept as a table in the folder ``marks``, and it is raised before the
    ids are handed out: a run that fails leaves numbers unused rather than used twice. Where there is no such table yet, the
    highest number among the ids that have the prefix counts. A second run over its own result changes nothing. The
    new rows are numbered in the given total order.
    """
    spark = df.sparkSession
    known = sinks.stored(spark, marks)
    if known is None:
        digits = F.regexp_extract(F.col(field).cast("string"), rf"^\Q{prefix}\E(\d+)$", 1)
        highest = df.agg(F.max(digits.try_cast("bigint")).alias("n")).first()["n"]
    else:
        highest = known.agg(F.max("n").alias("n")).first()["n"]
    highest = max(start - 1, highest if highest is not None else start - 1)
    bare = df.where(F.col(field).isNull())
    fresh = stored(assign_sequence_ids(bare, order, field, prefix, highest + 1, pad), "new-ids")
    count = fresh.count()
    if count or known is None:
        sinks.publish(spark.createDataFrame([(highest + count,)], "n bigint"), marks)
    kind = df.schema[field].dataType
    return df.where(F.col(field).isNotNull()).unionByName(fresh.withColumn(field, F.col(field).cast(kind)).select(*df.columns))
