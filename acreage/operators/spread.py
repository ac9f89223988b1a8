"""Joins, picks and numberings that stay balanced when one key owns a large share of the rows.

A plain window or join sends all rows of a key to one task. The operators here take three ways round that:

* aggregates and first-row picks shrink each map task's rows before the shuffle;
* ``lookup_join`` and ``salted_join`` treat heavy keys apart, those with ``heavyRows`` rows or more, counted exactly;
  there are at most rows / ``heavyRows`` of them, and Spark broadcasts them only if their stored size is small;
* numberings work in blocks or sorted ranges, and only one row per block goes on to the second level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.session import BROADCAST_BYTES, BROADCAST_ROWS, HEAVY_ROWS, checkpointed, setting, stored

# Into how many values keys are hashed to find where rows crowd.
HASHES = 1 << 16


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to broadcast, by rows and then by bytes.

    The row check reads no more rows than the limit, and of those no column; only a table that passes it is
    measured in bytes.
    """
    spark = df.sparkSession
    if not df.select(F.lit(1)).offset(setting(spark, BROADCAST_ROWS)).isEmpty():
        return False
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    return (df.agg(F.sum(width).alias("n")).first()["n"] or 0) <= setting(spark, BROADCAST_BYTES)


def heavy_keys(counts: DataFrame, on: Sequence[str]) -> DataFrame:
    """All keys with many rows, from a table of keys and their ``count``, and into how many shares to cut each."""
    least = setting(counts.sparkSession, HEAVY_ROWS)
    return counts.where(F.col("count") >= least).select(*on, F.ceil(F.col("count") / least).cast("int").alias("_shares"))


def heavy_keys_of(df: DataFrame, on: Sequence[str]) -> DataFrame | None:
    """``heavy_keys`` of the rows of ``df``, stored, or None without any; counts keys only where rows crowd.

    Keys are first counted by a hash in ``HASHES`` values, which shuffles a few bytes a task. A key with many rows lies in a
    value with many rows, and only such values' keys are then counted one by one.
    """
    least = setting(df.sparkSession, HEAVY_ROWS)
    hashed = df.select(*on, F.pmod(F.xxhash64(*on), F.lit(HASHES)).alias("_hash"))
    crowds = stored(hashed.groupBy("_hash").count().where(F.col("count") >= least).select("_hash"), "crowds")
    if crowds.isEmpty():
        return None
    counts = hashed.join(F.broadcast(crowds), "_hash", "left_semi").groupBy(*on).count()
    heavy = stored(heavy_keys(counts, on), "heavy-keys")
    return None if heavy.isEmpty() else heavy


def matching(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool) -> Column:
    """Equality of ``on`` in ``left`` with the ``_on_`` columns of ``right``."""
    test = F.lit(True)
    for name in on:
        theirs = right[f"_on_{name}"]
        test = test & (left[name].eqNullSafe(theirs) if null_safe else left[name] == theirs)
    return test


def _drop_on(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.drop(*(f"_on_{name}" for name in on))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    counts: DataFrame | None = None,
    null_safe: bool = False,
    probe: bool = False,
    keyed_like: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to a table with one row per key.

    Rows of heavy keys get their match from those keys' rows alone, a broadcast where these are few. Together
    with rows without a key they are then spread over the shuffle by their input partition, so they never meet in
    one task. ``counts`` may give the row count per key where it is already at hand, ``keyed_like`` a table that is
    cheaper to read than ``left`` and has at least as many rows of each key. ``probe`` is for a ``right`` that is cheap to read: when it proves small enough it is broadcast whole.
    """
    on = list(on)
    values = [c for c in right.columns if c not in on]
    keyed = right.select(
        *(F.col(c).alias(f"_on_{c}") for c in on), F.struct(F.lit(1).alias("_is"), *values).alias("_found")
    )
    if probe and fits_broadcast(right):
        joined = _drop_on(left.join(F.broadcast(keyed), matching(left, keyed, on, null_safe), "left"), on)
    else:
        # stored tables have a known size, by which Spark broadcasts them or not
        if counts is None:
            heavy = heavy_keys_of(left if keyed_like is None else keyed_like, on)
        else:
            heavy = stored(heavy_keys(counts, on), "heavy-keys")
        rows, apart, some = left, F.lit(False), heavy is not None and not heavy.isEmpty()
        if some:
            heavy = heavy.select(*(F.col(c).alias(f"_on_{c}") for c in on))
            renamed = keyed.select(*(F.col(f"_on_{c}").alias(c) for c in on), "_found")
            hot = renamed.join(heavy, matching(renamed, heavy, on, null_safe), "left_semi").select(
                *(F.col(c).alias(f"_on_{c}") for c in on), F.col("_found").alias("_hot")
            )
            hot = stored(hot, "heavy-rows")
            flagged = heavy.withColumn("_heavy", F.lit(True))
            rows = _drop_on(left.join(flagged, matching(left, flagged, on, null_safe), "left"), on)
            rows = _drop_on(rows.join(hot, matching(rows, hot, on, null_safe), "left"), on)
            apart = F.col("_heavy").isNotNull()
        if not null_safe:
            for name in on:
                apart = apart | F.col(name).isNull()
        rows = rows.withColumn("_slot", F.when(apart, F.spark_partition_id() + 1).otherwise(0))
        # always 0, but not a constant, so that the slot stays a join key and takes part in the shuffle
        cold = keyed.withColumn("_cold", F.pmod(F.hash(*(f"_on_{c}" for c in on)), F.lit(1)))
        joined = _drop_on(
            rows.join(cold, matching(rows, cold, on, null_safe) & (rows["_slot"] == cold["_cold"]), "left"), on
        )
        if some:
            joined = joined.withColumn("_found", F.when(F.col("_heavy").isNotNull(), F.col("_hot")).otherwise(F.col("_found")))
    found = F.col("_found").isNotNull()
    if how in ("inner", "left_semi"):
        joined = joined.where(found)
    elif how == "left_anti":
        joined = joined.where(~found)
    elif how != "left":
        raise ValueError(f"unsupported join: {how}")
    if how in ("left_semi", "left_anti"):
        return joined.select(*left.columns)
    return joined.select(*left.columns, *(F.col(f"_found.{c}").alias(c) for c in values))


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], by: Sequence[str], small: bool = False, right_by: Sequence[str] | None = None
) -> DataFrame:
    """Inner join to a table with many rows per key, for left rows that ``on`` and ``by`` tell apart.

    A key that is heavy on either side is cut in a grid: ``a`` shares of its left rows by a hash of ``by``, ``b`` shares of
    its right rows by a hash of ``right_by`` (all columns, if not given), and every left share meets every right
    one. Its left rows are repeated ``b`` times and its right rows ``a`` times, and no task has more than a share of
    each. ``small`` says that ``right`` is known to fit a broadcast.
    """
    on, by = list(on), list(by)
    if small:
        return left.join(F.broadcast(right), on)
    ours, theirs = (heavy_keys_of(df, on) for df in (left, right))
    if ours is None and theirs is None:
        return left.join(right, on)
    none = left.select(*on, F.lit(1).alias("_shares")).limit(0)
    ours, theirs = (none if x is None else x for x in (ours, theirs))
    both = ours.withColumnRenamed("_shares", "_ours").join(theirs.withColumnRenamed("_shares", "_theirs"), on, "full_outer")
    heavy = stored(both.select(*on, F.coalesce("_ours", F.lit(1)).alias("_ours"), F.coalesce("_theirs", F.lit(1)).alias("_theirs")), "heavy-keys")

    def cut(df: DataFrame, keys: Sequence[str], mine: str, other: str, slots: tuple[str, str]) -> DataFrame:
        own = F.coalesce(F.pmod(F.xxhash64(*keys) if keys else F.lit(0), F.col(mine)), F.lit(0)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return df.join(heavy, on, "left").withColumn(slots[0], own).withColumn(slots[1], each).drop("_ours", "_theirs")

    rows = cut(left, by, "_ours", "_theirs", ("_slot", "_other"))
    repeated = cut(right, list(right_by or right.columns), "_theirs", "_ours", ("_other", "_slot"))
    return rows.join(repeated, [*on, "_slot", "_other"]).drop("_slot", "_other")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. Spark applies the limit before the shuffle, one row per key and map task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def rows_after_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows but the first of each key; of exact copies of the first row only one is left out.

    The first round ranks within key and input partition; the second only compares the partitions' best.
    """
    parted = df.withColumn("_part", F.spark_partition_id())
    local = parted.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    contender = F.when(F.col("_rank") == 1, F.lit(-1)).otherwise(F.col("_part"))
    final = local.withColumn("_round", contender)
    best = F.row_number().over(Window.partitionBy(*keys, "_round").orderBy(*order))
    return (
        final.withColumn("_best", best)
        .where((F.col("_rank") > 1) | (F.col("_best") > 1))
        .drop("_part", "_rank", "_round", "_best")
    )


def linked_rows(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[str],
    payload: Sequence[str],
    wrap: bool = False,
    anchor: Sequence[str] | None = None,
    running_max: Column | None = None,
) -> DataFrame:
    """Add ``rank`` within ``keys``, the ``next`` row's payload and the ``first`` row's payload per ``anchor``.

    ``block`` must rise with ``order``. Only one head per block takes part in the window over whole keys.
    With ``wrap`` the last row is followed by the first. ``running_max`` gives ``highest``, its largest value
    so far.
    """
    extra = running_max is not None
    keys, part = list(keys), [*keys, "_block"]
    anchor = list(anchor or keys)
    row = F.struct(*order, *payload)
    blocked = df.withColumn("_block", block)
    within = Window.partitionBy(*part).orderBy(*order, *payload)
    ranked = blocked.withColumn("_rank", F.row_number().over(within)).withColumn("_next", F.lead(row).over(within))

    top = F.max(running_max) if extra else F.lit(None).cast("int")
    if extra:
        ranked = ranked.withColumn("_top", F.max(running_max).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    heads = blocked.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"), F.min(row).alias("_head"), top.alias("_block_top")
    )
    along = Window.partitionBy(*keys).orderBy("_block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    rest = [k for k in keys if k not in anchor]
    follower = F.lead("_head").over(along)
    if wrap:
        follower = F.coalesce(follower, F.first("_head").over(along))
    if rest:
        # an anchor may have very many keys, whose heads no task should hold: the first one is an aggregate
        heads = stored(heads, "heads")
        firsts = heads.groupBy(*anchor).agg(
            F.min(F.struct(*rest, "_block", "_head"))["_head"].alias("_first"), F.count(F.lit(1)).alias("_heads")
        )
        firsts = stored(firsts, "firsts")
        counts = firsts.select(*anchor, F.col("_heads").alias("count"))
        heads = lookup_join(heads, firsts.drop("_heads"), anchor, "inner", counts=counts, null_safe=True, probe=True)
        first = F.col("_first")
    else:
        first = F.first("_head").over(along)
    heads = heads.select(
        *part,
        first.alias("_first"),
        follower.alias("_follower"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.max("_block_top").over(before).alias("_top_before"),
    )
    heads = heads.select(*(F.col(k).alias(f"_on_{k}") for k in part), *(c for c in heads.columns if c not in part))
    return ranked.join(heads, matching(ranked, heads, part, null_safe=True)).select(
        *df.columns,
        (F.col("_before") + F.col("_rank")).alias("rank"),
        F.coalesce("_next", "_follower").alias("next"),
        F.col("_first").alias("first"),
        *([F.greatest("_top", "_top_before").alias("highest")] if extra else []),
    )


def numbered(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "row_no") -> DataFrame:
    """Number rows 1, 2, … in the total order given, over everything or within groups.

    Rows are sorted into ranges and written once, so that both passes see the same ranges. A row's number is
    its place in its range plus the rows of the ranges before; the only single-task step sees one row per range.
    """
    within = list(within)
    sorting = [F.col(c).asc_nulls_last() for c in (*within, *order)]
    ranges = checkpointed(df.repartitionByRange(*sorting).sortWithinPartitions(*sorting))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranges.withColumn("_range", F.spark_partition_id()).withColumn("_place", place)
    sizes = placed.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    # one row per range; the number of ranges is set by the session, not by the data
    overall = placed.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_offset") + F.col("_place") + 1)
    if within:
        runs = overall.groupBy("_range", *within).agg(F.min(name).alias("_start"))
        runs = runs.select("_range", *within, F.min("_start").over(Window.partitionBy(*within)).alias("_start"))
        runs = runs.select(F.col("_range").alias("_on__range"), "_start", *(F.col(c).alias(f"_on_{c}") for c in within))
        same = matching(overall, runs, ["_range", *within], null_safe=True)
        overall = overall.join(runs, same).withColumn(name, F.col(name) - F.col("_start") + 1)
    return overall.select(*df.columns, name)
