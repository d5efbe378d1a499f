"""Strict calendar dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"


def iso_shaped(text: Column) -> Column:
    return text.rlike(ISO_SHAPE)


def strict_date(text: Column) -> Column:
    """The date when the text is a complete YYYY-MM-DD calendar date, else NULL."""
    return F.when(iso_shaped(text), F.call_function("try_to_date", text, F.lit("yyyy-MM-dd")))
