"""Questions about completeness: counts per stage, lost permits, and the related table's contents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import RELATIONSHIPS, SHORT_NAMES, renamed
from acreage.operators.duplicates import KEYS
from acreage.operators.spread import lookup_join
from acreage.session import stored

CATEGORY, PERMIT = KEYS


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per category and stage."""
    tagged = _union([df.select(CATEGORY, F.lit(stage).alias("stage")) for stage, df in stages.items()])
    return tagged.groupBy(CATEGORY, "stage").agg(F.count(F.lit(1)).alias("n"))


def permits_absent(source: DataFrame, *tables: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Source rows whose permit is in none of the tables."""
    present = stored(_union([t.select(*keys) for t in tables]).distinct())
    return lookup_join(source, present, keys, "left_anti", null_safe=True, probe=True)


def reconcile_counts(
    source: DataFrame, rw: DataFrame, ro: DataFrame, failed: DataFrame, related: DataFrame
) -> DataFrame:
    """One row per category: rows per stage, source rows lost on the way and published rows not yet copied."""
    stages = {"source": source, "rw": rw, "ro": ro, "failed": failed, "related": related}
    rows = _union([df.select(*KEYS, F.lit(stage).alias("stage")) for stage, df in stages.items()])
    # rows per stage and permit, null being a value; one shuffle shows which permits are missing where
    permits = rows.groupBy(*KEYS).agg(*(F.count_if(F.col("stage") == stage).alias(stage) for stage in stages))
    lost = F.when((F.col("rw") == 0) & (F.col("failed") == 0) & (F.col("related") == 0), F.col("source")).otherwise(0)
    counts = {stage: F.col(stage) for stage in stages}
    counts |= {"missing_rw": lost, "missing_ro": F.when(F.col("ro") == 0, F.col("rw")).otherwise(0)}
    return permits.groupBy(CATEGORY).agg(*(F.sum(n).alias(name) for name, n in counts.items()))


def load_missing_permits(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """How many distinct permits of each category did not arrive."""
    permits = source.select(*KEYS).distinct()
    absent = permits_absent(permits, loaded)
    return absent.groupBy(CATEGORY).agg(F.count(F.lit(1)).alias("n_missing"))


def occupancy_missing_in_related(permits: DataFrame, related: DataFrame) -> DataFrame:
    """Rows with an occupancy whose permit has no related row."""
    return permits_absent(permits.where(F.col("Occupancy_Type").isNotNull()), related)


def multi_pid_no_occupancy(permits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows without an occupancy of permits that have several parcels among such rows."""
    rows = permits.where(F.col("Occupancy_Type").isNull() & F.col("PID").isNotNull())
    groups = stored(
        rows.groupBy(*keys).agg(F.countDistinct("PID").alias("PID_Count"), F.count(F.lit(1)).alias("count"))
    )
    several = groups.where("PID_Count > 1").select(*keys, "PID_Count")
    return lookup_join(rows, several, keys, "inner", counts=groups.select(*keys, "count"), probe=True)


def related_by_category(related: DataFrame) -> DataFrame:
    return related.groupBy(CATEGORY).agg(F.count(F.lit(1)).alias("n"))


def related_rollup(main: DataFrame, related: DataFrame) -> DataFrame:
    """Each mapped permit with the name of its relationship and a summary of its related rows."""
    groups = related.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_related"),
        F.countDistinct("PID").alias("n_pids"),
        F.min("PID").alias("first_pid"),
        F.max("PID").alias("last_pid"),
        F.countDistinct("Occupancy_Type").alias("n_occupancies"),
    )
    feature = renamed(F.concat(F.lit("LND_PPLC_"), F.col(CATEGORY), F.lit("_Permits")), SHORT_NAMES)
    joined = main.select(*KEYS, renamed(feature, RELATIONSHIPS).alias("relationship")).join(groups, list(KEYS), "left")
    return joined.na.fill(0, ["n_related", "n_pids", "n_occupancies"])


def related_orphans(main: DataFrame, related: DataFrame) -> DataFrame:
    """Related rows whose permit is not among the mapped ones."""
    return permits_absent(related, main)


def max_text_length(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Longest text; null counts as empty."""
    return df.groupBy(*by).agg(F.max(F.coalesce(F.length(column), F.lit(0))).alias("max_length"))


def length_violations(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Per text column, how many values exceed the declared length, and the longest."""
    measures = [
        F.struct(
            F.lit(c).alias("field"),
            F.lit(n).alias("declared"),
            F.count_if(F.length(c) > n).alias("n_too_long"),
            F.coalesce(F.max(F.length(c)), F.lit(0)).alias("longest"),
        )
        for c, n in lengths.items()
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def locate_summary(located: DataFrame, by: Sequence[str]) -> DataFrame:
    return located.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
