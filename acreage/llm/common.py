"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.session import stored

# White space that separates words: the characters that ``bytes.split()`` splits at, too.
SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["SPACES", "GAP", "UPPER", "lower_ascii", "table", "stored", "text_bytes", "words_of", "remainder", "packed_rows"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def text_bytes(column: str = "text") -> Column:
    """The text as bytes for Python tasks; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def words_of(text: Column) -> Column:
    """The words of a text that is not null, as an array; none gives an empty array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def packed_rows(docs: DataFrame, **wanted: Column) -> DataFrame:
    """The columns asked for beside ``row``, a struct of all columns of ``docs``, so that no names clash."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *(c.alias(n) for n, c in wanted.items()))
