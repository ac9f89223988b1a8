"""One row per permit, and the related table of the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.text import padded
from acreage.operators.spread import first_per_key, heavy_keys_of, lookup_join, matching, rows_after_first
from acreage.session import stored

KEYS = ("Permit_Category", "Permit_Number")
RELATED_COLUMNS = ("Permit_Category", "Permit_Number", "PID", "Occupancy_Type", "Active_Parcel")
# What ``split_rows`` says of a row: kept as its permit's one row, related, added to those for its occupancy, or the one of
# equal related and added rows that the related table lists.
KEPT, RELATED, ADDED, LISTED = MARKS = ("_kept", "_related", "_added", "_listed")


def _active() -> Column:
    return F.coalesce(F.col("Active_Parcel") == "Y", F.lit(False))


def _priority(prefer_active: bool) -> Column:
    """How far down a row sorts within its permit; nulls sort last unless active rows are preferred."""
    return F.when(_active(), 2).otherwise(1) if prefer_active else F.when(F.col("Active_Parcel").isNull(), 2).otherwise(1)


def last_first(ties: Sequence[str], prefer_active: bool = False) -> list[Column]:
    """Order that puts a permit's last row, the one kept, first."""
    return [_priority(prefer_active).desc(), F.col("Active_Parcel").desc(), *(F.col(c).desc() for c in ties)]


def permits_unique(
    permits: DataFrame, ties: Sequence[str], keys: Sequence[str] = KEYS, prefer_active: bool = False
) -> DataFrame:
    """One row per permit. As in the source system a null parcel status outranks ``Y``."""
    if KEPT in permits.columns:
        return permits.where(KEPT).drop(*MARKS)
    return first_per_key(permits, keys, last_first(ties, prefer_active))


def permits_extra_rows(permits: DataFrame, ties: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """The rows ``permits_unique`` leaves out."""
    return rows_after_first(permits, keys, last_first(ties))


def permits_repeated(permits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All rows of permits that have more than one."""
    counts = stored(permits.groupBy(*keys).count())
    repeated = counts.where("count > 1").select(*keys)
    return lookup_join(permits, repeated, keys, "left_semi", counts=counts, null_safe=True, probe=True)


def permit_group_profile(permits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows, distinct parcels and occupancies per permit, null counted as a value, and whether all are active."""
    return permits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.countDistinct("PID") + F.max(F.col("PID").isNull().cast("int"))).alias("n_pids"),
        (F.countDistinct("Occupancy_Type") + F.max(F.col("Occupancy_Type").isNull().cast("int"))).alias(
            "n_occupancies"
        ),
        F.bool_and(_active()).alias("all_active"),
    )


def _several(column: str, over=lambda c: c) -> Column:
    """Whether a group has more than one value of ``column``, null being a value; needs no distinct count."""
    c = F.col(column)
    low, high, n, rows = (over(f) for f in (F.min(c), F.max(c), F.count(c), F.count(F.lit(1))))
    return F.coalesce(low < high, F.lit(False)) | ((n > 0) & (n < rows))


def related_rows(permits: DataFrame, ties: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of repeated permits, less those the duplicate rules remove.

    In a permit with several parcels and one occupancy, the first row and its copies go when all parcels are
    active, the active rows go when not all are. Permits without a number are exempt from both rules.
    """
    if "Occupancy_Type" not in permits.columns:
        extra = permits_extra_rows(permits, ties, keys)
        return extra.select(*(c for c in RELATED_COLUMNS if c in extra.columns))
    marked = permits if RELATED in permits.columns else split_rows(permits, ties, keys)
    category = [k for k in keys if k != "Permit_Number"]
    first = [*category, *(c for c in RELATED_COLUMNS if c not in category)]
    return marked.where(RELATED).select(*(c for c in first if c in permits.columns))


def with_digest(permits: DataFrame, columns: Sequence[str], name: str = "Other_Columns") -> DataFrame:
    """Some columns of ``permits``, and a 64-bit digest of the others by which copies are still told from other rows."""
    others = [c for c in permits.columns if c not in columns]
    return permits.select(*columns, F.xxhash64(*(F.col(c).isNull() for c in others), *others).alias(name))


def split_rows(permits: DataFrame, ties: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``permits`` with ``MARKS``: the rows of ``permits_unique``, ``related_rows``, ``occupancy_additions``, ``related_table``.

    A permit's rows meet in one task, so that one shuffle serves all. Only permits with very many rows take other
    ways, in which no task has all of them; a row of theirs comes once for each mark.
    """
    heavy = heavy_keys_of(permits, keys)
    if heavy is None:
        return _marked(permits, ties, keys)
    heavy = heavy.select(*(F.col(k).alias(f"_on_{k}") for k in keys))
    same = matching(permits, heavy, keys, null_safe=True)
    light = _marked(permits.join(heavy, same, "left_anti"), ties, keys)
    return light.unionByName(_marked_heavy(stored(permits.join(heavy, same, "left_semi")), ties, keys))


def _marked(permits: DataFrame, ties: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``split_rows`` for permits whose rows fit one task."""
    group = Window.partitionBy(*keys)
    over = lambda c: c.over(group)
    whole = [c for c in permits.columns if c not in keys]
    rows = permits.withColumn(KEPT, F.row_number().over(group.orderBy(*last_first(ties))) == 1)
    first = F.first(F.struct(*whole)).over(group.orderBy(*(F.col(c).asc() for c in ("Active_Parcel", *ties))))
    rows = rows.withColumns(
        {
            "_copy": F.struct(*whole).eqNullSafe(first),
            "_several": over(F.count(F.lit(1))) > 1,
            "_ruled": _several("PID", over) & ~_several("Occupancy_Type", over) & F.col("Permit_Number").isNotNull(),
            "_all_active": over(F.bool_and(_active())),
        }
    )
    gone = F.col("_ruled") & F.when(F.col("_all_active"), F.col("_copy")).otherwise(_active())
    rows = rows.withColumn(RELATED, F.col("_several") & ~gone)
    held = F.bool_or(RELATED).over(Window.partitionBy(*keys, "Occupancy_Type"))
    rows = rows.withColumn(ADDED, F.col(KEPT) & F.col("Occupancy_Type").isNotNull() & ~held)
    rows = rows.where(F.col(KEPT) | F.col(RELATED)).withColumn("_any", F.col(RELATED) | F.col(ADDED))
    alike = Window.partitionBy(*keys, padded(F.col("PID")), "Occupancy_Type", "Active_Parcel").orderBy(F.col("_any").desc())
    rows = rows.withColumn(LISTED, F.col("_any") & (F.row_number().over(alike) == 1))
    return rows.select(*permits.columns, *MARKS)


def _marked_heavy(permits: DataFrame, ties: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``split_rows`` for permits with very many rows, by aggregates and balanced joins."""
    profile = permits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        (_several("PID") & ~_several("Occupancy_Type")).alias("one_occupancy"),
        F.bool_and(_active()).alias("all_active"),
    )
    facts = profile.where("count > 1").withColumn("ruled", F.col("one_occupancy") & F.col("Permit_Number").isNotNull())
    facts = stored(facts.drop("one_occupancy"))
    rows = lookup_join(
        permits, facts.drop("count"), keys, "inner", counts=facts.select(*keys, "count"), null_safe=True, probe=True
    )
    rows = stored(rows)
    apart = F.col("ruled") & F.col("all_active")
    # only here is a first row wanted, and Spark limits the pick to one row per permit before the shuffle
    whole = [c for c in permits.columns if c not in keys]
    ruled = rows.where(apart)
    firsts = first_per_key(ruled, keys, [F.col(c).asc() for c in ("Active_Parcel", *ties)])
    firsts = stored(firsts.select(*keys, F.struct(*whole).alias("first_row")))
    counts = facts.where(apart).select(*keys, "count")
    others = lookup_join(ruled, firsts, keys, counts=counts, null_safe=True, probe=True)
    others = others.where(~F.struct(*whole).eqNullSafe(F.col("first_row"))).drop("first_row")
    related = stored(rows.where(~apart & ~(F.col("ruled") & _active())).unionByName(others).select(*permits.columns))
    unique = stored(permits_unique(permits, ties, keys))
    added = _not_held(unique, related, keys)
    alike = [*keys, "_pid", "Occupancy_Type", "Active_Parcel"]
    both = related.unionByName(added).withColumn("_pid", padded(F.col("PID")))
    listed = both.dropDuplicates(alike).drop("_pid")
    parts = {KEPT: unique, RELATED: related, ADDED: added, LISTED: listed}
    return reduce(DataFrame.unionByName, (df.withColumns({m: F.lit(m == name) for m in MARKS}) for name, df in parts.items()))


def _not_held(unique: DataFrame, related: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = [*keys, "Occupancy_Type"]
    held = related.select(*(F.col(c).alias(f"_on_{c}") for c in on)).distinct()
    return unique.where(unique["Occupancy_Type"].isNotNull()).join(held, matching(unique, held, on, null_safe=True), "left_anti")


def occupancy_additions(unique: DataFrame, related: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Unique rows with an occupancy that the related table does not hold for their permit.

    Both sides have one row per permit and occupancy, so no key can grow large.
    """
    return _not_held(unique, related, keys).select(*related.columns)


def marked_additions(marked: DataFrame) -> DataFrame:
    """``occupancy_additions`` of the rows of ``split_rows``."""
    return marked.where(ADDED).select(*RELATED_COLUMNS)


def with_padded_pid(df: DataFrame) -> DataFrame:
    return df.withColumn("PID", padded(F.col("PID")))


def related_table(unique: DataFrame, related: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Related rows and occupancy additions, without exact duplicates."""
    if "Occupancy_Type" in related.columns:
        related = stored(related)
        related = related.unionByName(occupancy_additions(unique, related, keys))
    return with_padded_pid(related).dropDuplicates()


def marked_related_table(marked: DataFrame) -> DataFrame:
    """``related_table`` of the rows of ``split_rows``."""
    return with_padded_pid(marked.where(LISTED).select(*RELATED_COLUMNS))


def without_copies(df: DataFrame) -> DataFrame:
    """Distinct rows and how many copies of each were removed."""
    return df.groupBy(*df.columns).count().select(*df.columns, (F.col("count") - 1).alias("n_removed"))
