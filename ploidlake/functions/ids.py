"""Identifiers and labels as the tables deliver them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What may stand around an id.
BLANKS = " \t\r\n"


def clean_id(c: Column | str) -> Column:
    """The id without outer blanks and tabs; null for null, empty and ``*``."""
    trimmed = F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))
    return F.when(trimmed.isin("", "*"), F.lit(None).cast("string")).otherwise(trimmed)


def clean_label(c: Column | str) -> Column:
    """A label in lower case without outer blanks; null for null and empty."""
    trimmed = F.lower(F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS)))
    return F.when(trimmed == "", F.lit(None).cast("string")).otherwise(trimmed)
