"""Permit rows made clean, routed, pruned and mapped to a target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acreage.functions import text as t

# Columns that a category does not publish.
VALUE_COLUMNS = (
    "Estimated_Project_Value",
    "Existing_Residential_Units",
    "Total_End_Residential_Units",
    "Building_Footprint_Area",
    "Number_of_Storeys",
)
INSPECTION_COLUMNS = ("Date_Inspection_Completed", "Most_Recent_Inspection")
UNPUBLISHED = {
    "Building": (),
    "Construction": (
        "Existing_Residential_Units",
        "Total_End_Residential_Units",
        "Building_Footprint_Area",
        "Number_of_Storeys",
    ),
    "Engineering": VALUE_COLUMNS,
    "Halifax_Water": VALUE_COLUMNS,
    "Land_Use_Approval": VALUE_COLUMNS + INSPECTION_COLUMNS,
    "Public_Works_ROW": VALUE_COLUMNS + INSPECTION_COLUMNS,
}

# The categories whose rows carry a street segment's id; the others carry a civic's.
SEGMENT_CATEGORIES = ("Engineering", "Public_Works_ROW")
SEGMENT_ID, CIVIC_ID = "HRM_ID", "Civic_ID"

# Target column → source column.
PLANNING_FIELDS = {
    "APP_NUM": "Planning_App_Num",
    "APP_NAME": "Application_Name",
    "APP_TYPE": "Application_Type",
    "APPSCOPE": "Application_Scope",
    "ADAPPSCOPE": "Additional_Application_Scope",
    "SUBMITDATE": "Submitted_Date",
    "COMPLEDATE": "Completed_Date",
    "APPSTATUS": "App_Status",
    "DESCRIPACT": "Proposed_Activity_Description",
    "LOCATION": "Location",
    "PID": "PIDs",
    "APPROVDATE": "Approved_Date",
    "FINDDATE": "Findings_Completed_Date",
    "MONMETDATE": "Monitor_Meetings_Completed_Date",
    "RECORDDATE": "Final_Recordation_Completed_Date",
    "PLUSERNAME": "Assigned_Planner_Name",
    "WEBURL": "Website_URL",
    "GSA_NAME": "Community",
    "DIST_ID": "District",
    "CURLANDUSE": "Current_Land_Use",
    "PROPLANDUSE": "Proposed_Land_Use",
    "REGDESIG": "Regional_Land_Use_Designation",
    "LOCDESIG": "Local_Land_Use_Designation",
    "PLAN_NAME": "Community_Plan_Name",
    "ZONE": "Zoning",
}
SUBDIVISION_FIELDS = {
    "APP_NUM": "Planning_App_Num",
    "APP_NAME": "Application_Name",
    "APP_TYPE": "Application_Type",
    "SUBMITDATE": "Submitted_Date",
    "COMPLEDATE": "Completed_Date",
    "APPSTATUS": "App_Status",
    "DESCRIPACT": "Proposed_Activity_Description",
    "LOCATION": "Location",
    "PID": "PIDs",
    "APPROVDATE": "Approved_Date",
    "FINDDATE": "Findings_Completed_Date",
    "MONMETDATE": "Monitor_Meetings_Completed_Date",
    "RECORDDATE": "Final_Recordation_Completed_Date",
    "SUBCOMNAME": "Subdivision_Common_Name",
    "SUBLEGNAME": "Subdivision_Legal_Name",
    "SUBLOTDESC": "Subdivision_Lot_Description",
    "SUBDIVPHAS": "Subdivision_Phase",
    "SUBEXISLOT": "Subdivision_Existing_Num_Lots",
    "SUBPROPLOT": "Subdivision_Proposed_Num_Lots",
    "SUBERESUNT": "Subdivision_Existing_Res_Units",
    "SUBPRESUNIT": "Subdivision_Proposed_Res_Units",
    "GSA_NAME": "Community",
    "DIST_ID": "District",
    "CURLANDUSE": "Current_Land_Use",
    "PROPLANDUSE": "Proposed_Land_Use",
    "REGDESIG": "Regional_Land_Use_Designation",
    "LOCDESIG": "Local_Land_Use_Designation",
    "PLAN_NAME": "Community_Plan_Name",
    "ZONE": "Zoning",
}


def without_object_ids(df: DataFrame) -> DataFrame:
    return df.select(*(c for c in df.columns if "OBJECTID" not in c.upper()))


def inspection_dates_together(columns: Sequence[str]) -> list[str]:
    """Column order with the completed inspection right after the most recent one."""
    moved, beside = INSPECTION_COLUMNS
    if moved not in columns:
        return list(columns)
    rest = [c for c in columns if c != moved]
    at = rest.index(beside) + 1
    return rest[:at] + [moved] + rest[at:]


def clean_permits(permits: DataFrame, id_field: str = "Civic_ID") -> DataFrame:
    """Missing values as null, tidy descriptions, numeric ids and a one-line address."""
    permits = without_object_ids(permits)
    clean = {f.name: t.not_nan(F.col(f.name), f.dataType) for f in permits.schema}
    if "Work_Description" in clean:
        clean["Work_Description"] = F.substring(t.single_spaced(F.col("Work_Description")), 1, t.DESCRIPTION_LENGTH)
    for name in ("PID", "Civic_Number"):
        if name in clean:
            clean[name] = t.filled(t.known(F.col(name).cast("string")))
    for name in ("Street_Name", "Community"):
        clean[name] = t.filled(F.col(name))
    clean[id_field] = t.whole_number(F.col(id_field))
    cleaned = permits.select(*(expr.alias(name) for name, expr in clean.items()))
    line = t.address_line(F.col("Civic_Number"), F.col("Street_Name"), F.col("Community"))
    cleaned = cleaned.withColumn("FORMATTEDADDRESS", line)
    return cleaned.select(*inspection_dates_together(cleaned.columns))


def route(id_field: str = "Civic_ID") -> Column:
    """The first way of locating that a permit qualifies for."""
    parts = [F.col(c) for c in ("Civic_Number", "Street_Name", "Community")]
    complete = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    absent = parts[0].isNull() & parts[1].isNull() & parts[2].isNull()
    return (
        F.when(F.col(id_field).isNotNull(), "1_civic_id")
        .when(complete, "2_address")
        .when(absent & F.col("PID").isNotNull(), "3_pid")
        .when(absent, "4_none")
        .otherwise("5_partial")
    )


def pruned(permits: DataFrame, category: str) -> DataFrame:
    """One category's table without the columns that category does not publish."""
    return permits.drop(*UNPUBLISHED.get(category, ()))


def pruned_values(permits: DataFrame, category: str = "Permit_Category") -> DataFrame:
    """All categories in one table, with null where a category does not publish a column."""
    for column in VALUE_COLUMNS + INSPECTION_COLUMNS:
        if column in permits.columns:
            silent = [c for c, dropped in UNPUBLISHED.items() if column in dropped]
            permits = permits.withColumn(column, F.when(~F.col(category).isin(silent), F.col(column)))
    return permits


def located_by(permits: DataFrame, category: str = "Permit_Category") -> DataFrame:
    """``locator_id``, the id that a row's category goes by, and ``id_kind`` in place of the two id columns.

    A table without one of the columns has null ids there.
    """
    held = [c for c in (CIVIC_ID, SEGMENT_ID) if c in permits.columns]
    segment = F.coalesce(F.col(category).isin(*SEGMENT_CATEGORIES), F.lit(False))
    value = lambda c: F.col(c).cast("bigint") if c in held else F.lit(None).cast("bigint")
    return permits.withColumns(
        {
            "locator_id": F.when(segment, value(SEGMENT_ID)).otherwise(value(CIVIC_ID)),
            "id_kind": F.when(segment, "street_segment").otherwise("civic"),
        }
    ).drop(*held)


def field_mapped(source: DataFrame, target: StructType, fields: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """``source`` in the target's schema, and the mapped fields the target does not have."""
    skipped = [name for name in fields if name not in target.fieldNames()]
    columns = []
    for field in target:
        origin = fields.get(field.name)
        value = F.col(origin) if origin in source.columns else F.lit(None)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return without_object_ids(source).select(*columns), skipped


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Nulls replaced by the specification's default values."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in defaults.items() if c in kinds}
    )


def with_calculated_id(df: DataFrame, target: str, source: str, prefix: str = "") -> DataFrame:
    """``target`` set from ``source``, as text after ``prefix`` when there is one."""
    value = F.concat(F.lit(prefix), F.col(source).cast("string")) if prefix else F.col(source)
    return df.withColumn(target, value)
