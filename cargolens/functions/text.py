"""Text predicates and lenient conversions for untrusted fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolens.functions.numbers import finite


def has_text(value: Column) -> Column:
    """True when the value holds at least one non-blank character."""
    return F.coalesce(value.rlike(r"\S"), F.lit(False))


def text_or(value: Column, default: Column | str = "") -> Column:
    return F.coalesce(value, F.lit(default) if isinstance(default, str) else default)


def lenient_double(value: Column) -> Column:
    return finite(value.try_cast("double"))


def lenient_int(value: Column) -> Column:
    """Whole number from text such as ``12`` or ``12.0``; anything else is null."""
    return value.try_cast("double").try_cast("int")
