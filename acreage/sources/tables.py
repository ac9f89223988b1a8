"""Reading tables: attributes only, CSV with a given schema, empty copies of a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that are text in every CSV, whatever they look like.
TEXT_COLUMNS = ("PID", "Civic_Number")

_NOT_ATTRIBUTES = (T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def attributes(df: DataFrame) -> DataFrame:
    """``df`` without geometry, blob and raster columns; the scan does not read them."""
    return df.select(*(f.name for f in df.schema if not isinstance(f.dataType, _NOT_ATTRIBUTES)))


def scan_attributes(spark: SparkSession, path: str) -> DataFrame:
    return attributes(spark.read.parquet(path))


def scan_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; give ``partitionColumn`` and its bounds to read it in parallel."""
    return attributes(spark.read.format("jdbc").options(url=url, dbtable=table, **options).load())


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, read with a schema so that ids keep their leading zeros."""
    typed = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in TEXT_COLUMNS else f for f in schema]
    )
    return spark.read.schema(typed).option("header", True).option("multiLine", False).option("escape", '"').csv(path)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def appended(target: DataFrame, source: DataFrame, strict: bool = False) -> DataFrame:
    """``target`` and ``source`` in one table.

    Strict append needs equal schemas. Otherwise columns are matched by name: what ``target`` lacks is dropped,
    what ``source`` lacks is null, and values that do not fit the column's type are null.
    """
    if strict:
        mine = [(f.name, f.dataType) for f in target.schema]
        if mine != [(f.name, f.dataType) for f in source.schema]:
            raise ValueError("schemas differ")
        return target.unionByName(source)
    matched = [
        (F.col(f.name).try_cast(f.dataType) if f.name in source.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target.schema
    ]
    return target.unionByName(source.select(*matched))
