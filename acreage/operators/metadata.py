"""Catalog records: which datasets to describe, and their text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.markup import without_tags
from acreage.functions.text import tag_text, with_tag_text

# Names left out of the catalog.
EXCLUDED_ENDS = ("_SAP", "_temp", "_H")
EXCLUDED_STARTS = ("AR_",)
EXCLUDED_PARTS = ("SDE_VAT", "SDEADM.AR_", "SDEADM.SAP_", "SDEADM.TMP_", "DirtyObjects")


def catalog_name_filter(names: DataFrame, column: str, schema: str = "") -> DataFrame:
    """Distinct dataset names of a schema, without history, scratch and archive tables."""
    name = F.col(column)
    kept = name.contains(schema)
    for end in EXCLUDED_ENDS:
        kept = kept & ~name.endswith(end)
    for start in EXCLUDED_STARTS:
        kept = kept & ~name.startswith(start)
    for part in EXCLUDED_PARTS:
        kept = kept & ~name.contains(part)
    return names.where(kept).select(column).distinct().orderBy(column)


def metadata_records(
    datasets: DataFrame, database: str, owner: str, description: str = "description", summary: str | None = None
) -> DataFrame:
    """One record per dataset; dates keep the names of the elements they come from."""
    feature = F.col("feature")
    bare = F.replace(feature, F.lit(f"{database}.{owner}."), F.lit(""))
    untitled = F.concat(bare, F.lit(" (*NO TITLE in Metadata*)"))

    def text(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    return datasets.select(
        F.replace(feature, F.lit(f"{database}."), F.lit("")).alias("FEATURE"),
        F.when(F.col("title") != "", F.col("title")).otherwise(untitled).alias("TITLE"),
        text(F.col(description)).alias("DESCRIPTION"),
        text(without_tags(F.col(description))).alias("DESCRIPTION_SANITIZED"),
        text(F.col(summary) if summary else F.lit(None)).alias("SUMMARY"),
        text(tag_text(F.col("xml"), "CreaDate")).alias("CREATION_DATE"),
        text(tag_text(F.col("xml"), "pubDate")).alias("PUBLICATION_DATE"),
        text(tag_text(F.col("xml"), "reviseDate")).alias("REVISION_DATE"),
    )


def revise_date(datasets: DataFrame, stamp: Column) -> DataFrame:
    """Metadata with the revision date replaced where there is one."""
    return datasets.withColumn("xml", with_tag_text(F.col("xml"), "reviseDate", stamp))
