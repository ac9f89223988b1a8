"""Submission forms, many at once, as cells ``(form_id, row_no, c0, c1, …)``.

A form's facts (where its header is, what its shape is) come from one aggregate and go back to the rows by a
lookup, so no form has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.functions.text import filled
from acreage.operators.spread import linked_rows, lookup_join
from acreage.session import BLOCK_ROWS, setting, stored

# Labels and headings of a form.
NAME_LABELS = ("Feature Class Name", "Data Source Name")
FIELD_HEADER = "Alias"
CODE_HEADER = "CODE"
DOMAIN_SECTION = "Fields with associated codes(values) and descriptions"
DEFAULT_SHAPE = "Enterprise Geodatabase Table"
LAST_FIELD, LAST_SHAPE_FIELD = "GLOBALID", "SHAPE_Length"
# Fields made by the database itself, and those of change tracking.
IGNORED_FIELDS = ("OBJECTID", "GLOBALID", "SHAPE", "SHAPE_AREA", "SHAPE_LENGTH")
TRACKING_FIELDS = ("ADDBY", "ADDDATE", "MODBY", "MODDATE")
# Types a field may have, and the Spark types for them.
FIELD_TYPES = {
    "TEXT": "string",
    "FLOAT": "float",
    "DOUBLE": "double",
    "SHORT": "smallint",
    "LONG": "int",
    "DATE": "timestamp_ntz",
    "DATEONLY": "date",
    "TIMEONLY": "string",
}
# Labels of the descriptive sheet; each value is in the row below.
NOTE_LABELS = {
    "description": "Dataset Description:",
    "summary": "Dataset Purpose:",
    "tags": "Dataset Tags:",
    "limitations": "Notes or Disclaimers:",
}
NOTE_NAME = "Dataset Name:"


def form_rows(cells: DataFrame) -> DataFrame:
    """Cells with blank ones null and rows without a label dropped."""
    names = [c for c in cells.columns if c.startswith("c")]
    clean = cells.withColumns({c: filled(F.col(c)) for c in names}).where(F.col("c0").isNotNull())
    return clean.withColumn(
        "c0", F.when(F.col("c0").contains("SourceAccuracy"), "SourceAccuracy").otherwise(F.col("c0"))
    )


def _ranked(rows: DataFrame, **more) -> DataFrame:
    block = F.floor(F.col("row_no") / setting(rows.sparkSession, BLOCK_ROWS))
    return linked_rows(rows, ["form_id"], block, ["row_no"], ["c0", "c1"], **more)


def form_facts(rows: DataFrame) -> DataFrame:
    """Written once: name, shape and type of each form, its header row and where its field and domain sections lie."""
    label = F.regexp_replace("c0", "^:+|:+$", "")
    cells = [c for c in rows.columns if c.startswith("c")]

    def valued(*labels: str) -> Column:
        return F.min_by("c1", F.when(label.isin(*labels) & (F.col("rank") <= 3), F.col("row_no")))

    at = F.col("row_no")
    facts = _ranked(rows).groupBy("form_id").agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(valued(NAME_LABELS[0]), valued(NAME_LABELS[1])).alias("feature_name"),
        F.coalesce(valued("Shape Type"), F.lit(DEFAULT_SHAPE)).alias("shape"),
        valued("Feature Type").alias("feature_type"),
        F.bool_or(label.isin(*NAME_LABELS) & (F.col("rank") <= 3)).alias("has_name"),
        F.bool_or(F.upper("c0") == "SHAPE_AREA").alias("has_area"),
        F.bool_or(F.upper("c0") == "SHAPE_LENGTH").alias("has_length"),
        F.min(F.when(F.col("c0") == FIELD_HEADER, at)).alias("header_row"),
        F.min_by(F.array(*cells), F.when(F.col("c0") == FIELD_HEADER, at)).alias("header"),
        F.min(F.when(F.col("c0") == DOMAIN_SECTION, at)).alias("domain_row"),
        F.max(F.when(F.col("c0") == LAST_FIELD, at)).alias("_last"),
        F.max(F.when(F.col("c0") == LAST_SHAPE_FIELD, at)).alias("_last_shape"),
        F.max(at).alias("_end"),
    )
    shaped = (F.upper("feature_type") == "FEATURE CLASS") & ~F.upper("shape").isin("POINT", "NOT APPLICABLE")
    last = F.when(shaped, F.col("_last_shape")).otherwise(F.col("_last"))
    ends = F.coalesce(last, F.col("domain_row") - 1, F.col("_end"))
    return stored(facts.withColumn("last_row", ends).drop("_last", "_last_shape", "_end"))


def _fields(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per field, its cells under the names in the form's header row."""
    cells = [c for c in rows.columns if c.startswith("c")]
    needed = facts.select("form_id", "header_row", "last_row", "header")
    placed = lookup_join(rows, needed, ["form_id"], "inner", counts=facts.select("form_id", "count"), probe=True)
    fields = placed.where((F.col("row_no") > F.col("header_row")) & (F.col("row_no") <= F.col("last_row")))
    named = fields.withColumn("pairs", F.arrays_zip(F.col("header").alias("k"), F.array(*cells).alias("v")))

    def cell(name: str) -> Column:
        """The cell under a heading, the first column's if the heading is repeated."""
        return F.get(F.filter("pairs", lambda p: p["k"] == name), F.lit(0))["v"]

    kind = F.upper(F.trim(cell("Field Type")))
    return named.select(
        "form_id",
        "row_no",
        F.upper(F.trim(cell("Field Name"))).alias("field_name"),
        F.trim(cell(FIELD_HEADER)).alias("alias"),
        cell("Field Type").alias("given_type"),
        F.when(kind == "STRING", "TEXT").otherwise(kind).alias("spec_type"),
        cell("Field Length").try_cast("double").try_cast("int").alias("length"),
        cell("Default Value").alias("default_value"),
        F.trim(cell("Domain")).alias("domain"),
        cell("Subtype Field").alias("subtype_flag"),
    )


def _ignored(tracking: bool) -> list[str]:
    return [*IGNORED_FIELDS, *(TRACKING_FIELDS if tracking else ())]


def spec_to_schema(cells: DataFrame, tracking: bool = False) -> DataFrame:
    """Each form's fields with the Spark type they become, null where the type is unknown."""
    rows = form_rows(cells)
    fields = _fields(rows, form_facts(rows)).where(~F.col("field_name").isin(_ignored(tracking)))
    kinds = [F.lit(part) for pair in FIELD_TYPES.items() for part in pair]
    return fields.select(
        "form_id",
        "row_no",
        "field_name",
        "alias",
        "spec_type",
        F.element_at(F.create_map(*kinds), F.col("spec_type")).alias("spark_type"),
        "length",
        "default_value",
        "domain",
    )


def struct_of(schema_rows: DataFrame, form_id) -> T.StructType:
    """One form's fields as a Spark schema; text lengths are kept as metadata."""
    rows = schema_rows.where((F.col("form_id") == form_id) & F.col("spark_type").isNotNull()).orderBy("row_no")
    fields = []
    for row in rows.select("field_name", "spark_type", "length", "domain").toLocalIterator():
        notes = {k: v for k, v in (("length", row["length"]), ("domain", row["domain"])) if v is not None}
        kind = T.StructType.fromDDL(f"f {row['spark_type']}")[0].dataType
        fields.append(T.StructField(row["field_name"], kind, True, notes))
    return T.StructType(fields)


def spec_violations(cells: DataFrame, tracking: bool = False) -> DataFrame:
    """Every rule a form breaks: one row per form or field, rule and offending value."""
    rows = form_rows(cells)
    facts = form_facts(rows)
    fields = _fields(rows, facts).where(~F.col("field_name").isin(_ignored(tracking)))
    unsized = (F.col("given_type") == "TEXT") & F.coalesce(F.col("length") == 0, F.lit(True))
    unknown = ~F.coalesce(F.col("spec_type"), F.lit("")).isin(*FIELD_TYPES)
    of_fields = fields.select(
        "form_id",
        "row_no",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(unsized, F.struct(F.lit("text_without_length").alias("rule"), F.col("field_name").alias("value"))),
                    F.when(unknown, F.struct(F.lit("bad_type").alias("rule"), F.col("given_type").alias("value"))),
                )
            )
        ).alias("broken"),
    ).select("form_id", "row_no", "broken.rule", "broken.value")
    is_class = F.upper("feature_type") == "FEATURE CLASS"
    shape = F.upper("shape")
    no_area = is_class & (shape == "POLYGON") & ~F.col("has_area")
    no_length = is_class & shape.isin("POLYGON", "LINE") & ~F.col("has_length")
    of_forms = facts.select(
        "form_id",
        F.lit(None).cast("int").alias("row_no"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(no_area, F.struct(F.lit("missing_shape_area").alias("rule"), F.col("shape").alias("value"))),
                    F.when(no_length, F.struct(F.lit("missing_shape_length").alias("rule"), F.col("shape").alias("value"))),
                    F.when(~F.col("has_name"), F.struct(F.lit("missing_name").alias("rule"), F.lit(None).cast("string").alias("value"))),
                )
            )
        ).alias("broken"),
    ).select("form_id", "row_no", "broken.rule", "broken.value")
    return of_fields.unionByName(of_forms)


def spec_domain_fields(cells: DataFrame) -> DataFrame:
    """Fields that have a domain, and whether the form flags them as subtype fields."""
    rows = form_rows(cells)
    fields = _fields(rows, form_facts(rows))
    return fields.where(F.col("domain").isNotNull() | F.col("subtype_flag").isNotNull()).select(
        "form_id", "field_name", "domain", "spec_type", F.col("subtype_flag").isNotNull().alias("is_subtype")
    )


def domain_blocks(cells: DataFrame) -> DataFrame:
    """Codes and descriptions of each domain a form lists; rows lacking either are dropped.

    A row labelled ``Code`` opens a block that the row before it names. Names must not contain spaces.
    """
    rows = form_rows(cells)
    facts = form_facts(rows)
    sections = facts.select("form_id", "domain_row")
    counts = facts.select("form_id", "count")
    placed = lookup_join(rows, sections, ["form_id"], "inner", counts=counts, probe=True)
    inside = placed.where(F.col("row_no") > F.col("domain_row")).select("form_id", "row_no", "c0", "c1")
    ahead = stored(_ranked(inside).select("form_id", "row_no", "c0", "c1", F.upper("next.c0").alias("next_label")))
    opens = F.coalesce(F.col("next_label") == CODE_HEADER, F.lit(False))
    marked = stored(_ranked(ahead.withColumn("head", F.when(opens, F.col("row_no"))), running_max=F.col("head")))
    names = marked.where(F.col("head").isNotNull()).select(
        "form_id", F.col("row_no").alias("highest"), F.col("c1").alias("domain"), F.col("c0").alias("domain_field")
    )
    codes = marked.where(
        F.col("head").isNull()
        & F.col("highest").isNotNull()
        & (F.upper("c0") != CODE_HEADER)
        & F.col("c1").isNotNull()
    ).select("form_id", "highest", "row_no", F.col("c0").alias("code"), F.col("c1").alias("description"))
    joined = lookup_join(codes, names, ["form_id", "highest"], "inner", probe=True)
    return joined.select(
        "form_id", "domain", "domain_field", "code", "description", (~F.col("domain").contains(" ")).alias("valid_name")
    )


def form_metadata(notes: DataFrame) -> DataFrame:
    """Title, description, purpose, tags and limitations from each form's descriptive sheet."""
    ranked = _ranked(notes)
    at = F.col("row_no")
    title = F.min_by("c1", F.when(F.col("c0") == NOTE_NAME, at))
    return ranked.groupBy("form_id").agg(
        F.concat(F.lit("METADATA: "), title).alias("name"),
        *(F.min_by("next.c0", F.when(F.col("c0") == label, at)).alias(c) for c, label in NOTE_LABELS.items()),
    )


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the form's schema: values cast, absent columns null."""
    have: Sequence[str] = df.columns
    return df.select(
        *((F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema)
    )
