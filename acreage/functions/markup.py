"""HTML text. Entities have no built-in function, so this is the one place that uses a Python function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def unescaped(text: Column) -> Column:
    """Text with HTML entities replaced by their characters, in Arrow batches."""

    # defined here so that it travels by value and executors need no copy of this package
    def unescape(texts: pd.Series) -> pd.Series:
        import html

        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(unescape, StringType())(text)


def without_tags(text: Column) -> Column:
    """Entities replaced by their characters, then tags removed. Only text with ``&`` is sent to Python."""
    entities = text.contains("&")
    plain = F.when(entities, unescaped(F.when(entities, text))).otherwise(text)
    return F.regexp_replace(plain, "<[^<]+?>", "")
