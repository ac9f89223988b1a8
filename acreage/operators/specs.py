"""Submitted data held against the forms that describe it: all forms, records and fields in one plan.

Data is in long form, a row per ``(form_id, record, field, value)`` with the value as text, so that tables of any shape can
be checked together. A form's fields are rows as well (``forms.spec_to_schema``), and so are its codes
(``forms.domain_blocks``): no form goes through the driver, and no schema is a column list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import filled
from acreage.operators.forms import FIELD_TYPES
from acreage.operators.spread import lookup_join, salted_join
from acreage.session import stored

CELL = ["form_id", "record", "field"]


def long_form(df: DataFrame, form_id, record: str) -> DataFrame:
    """A table's rows as cells of one form; ``record`` names the column that tells rows apart."""
    names = [c for c in df.columns if c != record]
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), df[c].cast("string").alias("value")) for c in names))
    return df.select(F.lit(form_id).alias("form_id"), df[record].alias("record"), F.explode(pairs).alias("c")).select("form_id", "record", "c.*")


def _typed(value: Column, kind: Column) -> Column:
    """The value in its type's usual spelling, null where it is not of that type; an unknown type takes any text."""
    out = value
    for name in dict.fromkeys(FIELD_TYPES.values()):
        if name != "string":
            out = F.when(kind == name, F.trim(value).try_cast(name).cast("string")).otherwise(out)
    return out


def checked_cells(data: DataFrame, schema_rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Every record's cell for every field of its form, filled, cast and decoded, with the rules it breaks.

    ``value`` is the submitted text, or the field's default where there is none (``is_default``), in the type's usual spelling;
    ``description`` is the code's. ``rules`` may name ``bad_type``, ``too_long`` and ``not_in_domain``, and ``repeated`` where a
    record has a field twice, of which the least value is taken. Cells of fields that the form does not have come back
    with the rule ``unknown_field``. Records of a form without fields have only those.
    """
    kept = F.struct("row_no", F.col("spark_type").alias("kind"), "length", "default_value", "domain")
    fields = schema_rows.groupBy("form_id", F.col("field_name").alias("field")).agg(F.min(kept).alias("spec"))
    fields = stored(fields.select("form_id", "field", "spec.*"), "spec-fields")
    named = data.withColumn("field", F.upper(F.trim("field")))
    given = stored(named.groupBy(*CELL).agg(F.min(filled(F.col("value"))).alias("given"), F.count(F.lit(1)).alias("n")), "cells")
    records = given.select("form_id", "record").distinct()
    wanted = salted_join(records, fields, on=["form_id"], by=["record"])
    # a cell is one row on either side
    cells = wanted.join(given, CELL, "left")
    text = F.coalesce("given", filled(F.col("default_value")))
    cells = cells.withColumns({"text": text, "is_default": F.col("given").isNull() & text.isNotNull(), "value": _typed(text, F.col("kind"))})

    listed = codes.groupBy("form_id", "domain", F.col("code").alias("text")).agg(F.min("description").alias("description"))
    domains = listed.select("form_id", "domain", F.lit(True).alias("listed")).distinct()
    cells = lookup_join(cells, stored(listed, "spec-codes"), ["form_id", "domain", "text"], probe=True)
    cells = lookup_join(cells, stored(domains, "spec-domains"), ["form_id", "domain"], probe=True)
    there = F.col("text").isNotNull()
    broken = {
        "repeated": F.col("n") > 1,
        "bad_type": there & F.col("value").isNull(),
        "too_long": there & (F.col("kind") == "string") & (F.col("length") > 0) & (F.length("text") > F.col("length")),
        "not_in_domain": there & F.col("listed") & F.col("description").isNull(),
    }
    rules = F.array_compact(F.array(*(F.when(test, rule) for rule, test in broken.items())))
    known = cells.select(*CELL, "text", "value", "is_default", "description", rules.alias("rules"))
    strange = lookup_join(given, fields.select("form_id", "field"), ["form_id", "field"], "left_anti", probe=True)
    none = F.lit(None).cast("string")
    unknown = strange.select(*CELL, F.col("given").alias("text"), none.alias("value"), F.lit(False).alias("is_default"), none.alias("description"), F.array(F.lit("unknown_field")).alias("rules"))
    return known.unionByName(unknown)


def filled_cells(checked: DataFrame) -> DataFrame:
    """The cells to load: those of known fields, null where the value is not of the field's type."""
    return checked.where(~F.array_contains("rules", "unknown_field")).select(*CELL, "value", "is_default", "description")


def cell_violations(checked: DataFrame) -> DataFrame:
    """One row per bad cell and rule."""
    return checked.select(*CELL, F.explode("rules").alias("rule"), F.col("text").alias("value"))
