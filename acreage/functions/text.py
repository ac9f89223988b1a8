"""Column expressions for parcel ids, addresses, categories and metadata text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Texts that stand for a missing value.
NULL_TEXTS = ("nan", "None")
# Fixed value: the province named at the end of each address line.
PROVINCE = "NOVA SCOTIA"
# Fixed value: longest work description kept.
DESCRIPTION_LENGTH = 2000
# Fixed value: digits in a parcel id.
PID_LENGTH = 8
# Permit categories, in the order in which a file name is searched for them.
CATEGORIES = (
    "Building",
    "Construction",
    "Engineering",
    "Public_Works_ROW",
    "Halifax_Water",
    "Land_Use_Approval",
)
# Short names of three published tables; the others keep their name.
SHORT_NAMES = {
    "LND_PPLC_Halifax_Water_Permits": "LND_PPLC_HW_Permits",
    "LND_PPLC_Land_Use_Approval_Permits": "LND_PPLC_LU_Approval_Permits",
    "LND_PPLC_Public_Works_ROW_Permits": "LND_PPLC_PW_ROW_Permits",
}
# Names of the relationships between published tables and the related table.
RELATIONSHIPS = {
    "LND_PPLC_Building_Permits": "Building_has_permits",
    "LND_PPLC_Construction_Permits": "Construction_has_permits",
    "LND_PPLC_Engineering_Permits": "Engineering_has_permits",
    "LND_PPLC_HW_Permits": "HW_has_permits",
    "LND_PPLC_LU_Approval_Permits": "LU_Approval_has_permits",
    "LND_PPLC_PW_ROW_Permits": "PW_ROW_has_permits",
}


def stripped(text: Column) -> Column:
    """Text without white space, Unicode's included, at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def known(text: Column) -> Column:
    """Null in place of the texts that stand for a missing value."""
    return F.when(~text.isin(*NULL_TEXTS), text)


def not_nan(value: Column, kind) -> Column:
    """Null in place of NaN."""
    return F.when(~F.isnan(value), value) if isinstance(kind, (DoubleType, FloatType)) else value


def filled(text: Column) -> Column:
    """Null in place of blank text."""
    return F.when(text.rlike(r"(?U)\S"), text)


def padded(text: Column, length: int = PID_LENGTH) -> Column:
    """Text with leading zeros up to ``length``; longer text stays whole."""
    return F.when(F.length(text) >= length, text).otherwise(F.lpad(text, length, "0"))


def pid_list(text: Column) -> Column:
    """All parcel ids of a comma-separated list, padded; empty when there are none."""
    parts = F.filter(F.transform(F.split(text, ","), stripped), lambda p: p != "")
    return F.coalesce(F.transform(parts, lambda p: padded(p)), F.array().cast("array<string>"))


def primary_pid(text: Column) -> Column:
    """The first entry of a list, padded; null when that entry is blank, even if others follow."""
    return padded(filled(stripped(F.split(text, ",")[0])))


def single_spaced(text: Column) -> Column:
    """Runs of two or more white-space characters as one space."""
    return F.regexp_replace(text, r"(?U)\s{2,}", " ")


def whole_number(value: Column) -> Column:
    """Text or number as a nullable whole number; what cannot be read is null."""
    text = value.cast("string")
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def house_number(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def address_line(number: Column, street: Column, community: Column) -> Column:
    """One-line address; null when a part is missing."""
    return F.when(
        number.isNotNull() & street.isNotNull() & community.isNotNull(),
        F.concat(house_number(number), F.lit(" "), street, F.lit(", "), community, F.lit(f" {PROVINCE}")),
    )


def category_of_table(name: Column) -> Column:
    """``PPLC_<category>_Permits`` → category."""
    return F.replace(F.replace(name, F.lit("PPLC_"), F.lit("")), F.lit("_Permits"), F.lit(""))


def category_of_file(name: Column) -> Column:
    """The first category whose name occurs in a file name; empty when none does."""
    found = F.lit("")
    for category in reversed(CATEGORIES):
        found = F.when(name.contains(category), F.lit(category)).otherwise(found)
    return found


def renamed(name: Column, names: Mapping[str, str]) -> Column:
    """The mapped name, or the name itself."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), name), name)


def tag_text(xml: Column, tag: str) -> Column:
    """Text of the first ``tag`` element that opens and closes on one line; null when there is none."""
    pattern = rf"(?d)<{tag}>(.*?)</{tag}>"
    return F.when(xml.rlike(pattern), F.regexp_extract(xml, pattern, 1))


def with_tag_text(xml: Column, tag: str, text: Column) -> Column:
    """``xml`` with every occurrence of the first ``tag`` element's text replaced; unchanged when there is none."""
    old, new = (F.concat(F.lit(f"<{tag}>"), t, F.lit(f"</{tag}>")) for t in (tag_text(xml, tag), text))
    return F.coalesce(F.replace(xml, old, new), xml)


def day_stamp(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'00:00:00")


def guid(*parts: Column) -> Column:
    """A GUID that depends on ``parts`` alone, so that a repeated load gives the same ids."""
    digest = F.upper(F.sha2(F.concat_ws("|", *parts), 256))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("{"), F.concat_ws("-", *(F.substring(digest, at, n) for at, n in cuts)), F.lit("}"))
