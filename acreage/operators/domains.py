"""Coded values: decoding, violations, subtypes, and what to create or copy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.operators.spread import lookup_join, numbered

# Types a new domain may have.
DOMAIN_TYPES = ("TEXT", "SHORT", "LONG", "FLOAT", "DOUBLE", "DATE")


def _codes(domains: DataFrame, domain: str, code_column: str) -> DataFrame:
    return (
        domains.where(F.col("domain") == domain)
        .groupBy(F.col("code").alias(code_column))
        .agg(F.min("description").alias("description"))
    )


def domain_decode(rows: DataFrame, domains: DataFrame, column: str, domain: str) -> DataFrame:
    """``rows`` with the description of the code in ``column``."""
    return lookup_join(rows, _codes(domains, domain, column), [column], probe=True)


def domain_violations(rows: DataFrame, domains: DataFrame, column: str, domain: str) -> DataFrame:
    """Rows whose code is present but not in the domain."""
    coded = rows.where(F.col(column).isNotNull())
    codes = _codes(domains, domain, column).select(column)
    return lookup_join(coded, codes, [column], "left_anti", probe=True)


def subtype_domain_check(
    rows: DataFrame, subtypes: DataFrame, domains: DataFrame, subtype_column: str, column: str
) -> DataFrame:
    """Each row's code checked against the domain its subtype prescribes."""
    rules = (
        subtypes.where(F.col("field") == column)
        .groupBy(F.col("subtype_code").alias(subtype_column))
        .agg(F.min("domain").alias("domain"))
    )
    codes = domains.groupBy("domain", F.col("code").alias(column)).agg(
        F.min("description").alias("description"), F.lit(True).alias("_valid")
    )
    ruled = lookup_join(rows, rules, [subtype_column], probe=True)
    checked = lookup_join(ruled, codes, ["domain", column], probe=True)
    return checked.withColumn(
        "check",
        F.when(F.col("domain").isNull(), "no_subtype")
        .when(F.col(column).isNull(), "no_code")
        .when(F.col("_valid"), "valid")
        .otherwise("invalid"),
    ).drop("_valid")


def domain_order(domains: DataFrame, subtype_domains: Sequence[str] = ()) -> DataFrame:
    """Codes numbered in the order in which they are added to their domain.

    Whole-number descriptions come first, by number, then texts, then missing ones. Subtype domains go by code.
    """
    number = F.trim("description").try_cast("bigint")
    by_code = F.col("domain").isin(*subtype_domains) if subtype_domains else F.lit(False)
    keyed = domains.withColumns(
        {
            "_bucket": F.when(by_code, 0).when(number.isNotNull(), 0).when(F.col("description").isNotNull(), 1).otherwise(2),
            "_number": F.when(by_code, F.col("code").try_cast("bigint")).otherwise(number),
            "_text": F.when(by_code | number.isNotNull(), F.lit(None)).otherwise(F.col("description")),
        }
    )
    ordered = numbered(keyed, ["_bucket", "_number", "_text", "code"], within=["domain"], name="ord")
    return ordered.select(*domains.columns, "ord")


def missing_domains(requested: DataFrame, present: DataFrame) -> DataFrame:
    """Requested domain names that are not present in any letter case."""
    wanted = requested.select("domain").distinct().withColumn("_key", F.upper("domain"))
    there = present.select(F.upper("domain").alias("_key")).distinct()
    return wanted.join(there, "_key", "left_anti").select("domain")


def domain_transfer_plan(requested: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """What to do with each requested domain: create it, leave it, or copy it with its codes.

    The source is searched by exact name, the target in any letter case.
    """
    wanted = requested.select("domain").distinct().withColumn("_key", F.upper("domain"))
    sizes = source.groupBy("domain").agg(F.count(F.lit(1)).alias("n_codes"))
    there = target.select(F.upper("domain").alias("_key")).distinct().withColumn("_there", F.lit(True))
    planned = wanted.join(sizes, "domain", "left").join(there, "_key", "left")
    action = (
        F.when(F.col("n_codes").isNull(), "missing_in_source")
        .when(F.col("_there"), "present_in_target")
        .otherwise("copy")
    )
    return planned.select("domain", action.alias("action"), F.when(action == "copy", F.col("n_codes")).alias("n_codes"))


def domain_types(
    domains: DataFrame, overrides: Mapping[str, str] | None = None, subtype_domains: Sequence[str] = ()
) -> DataFrame:
    """Type of each new domain: whole number for subtypes, else the override, else text."""
    overrides = overrides or {}
    for name, kind in overrides.items():
        if kind.upper() not in DOMAIN_TYPES:
            raise ValueError(f"type {kind} of domain {name} is not standard")
    kind = F.lit("TEXT")
    for name, override in overrides.items():
        kind = F.when(F.col("domain") == name, override).otherwise(kind)
    if subtype_domains:
        kind = F.when(F.col("domain").isin(*subtype_domains), "LONG").otherwise(kind)
    return domains.select("domain").distinct().withColumn("field_type", kind)
