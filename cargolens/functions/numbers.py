"""Ratios, sums and averages.

Integers and decimals add up exactly. Doubles are added as they are: NaN and infinities come through,
and the last bits may depend on the order of the rows, as everywhere in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; 0.0 when the denominator is null or zero.

    A null numerator over a usable denominator stays null.
    """
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def finite(value: Column) -> Column:
    """Null for NaN and infinities (NaN compares above every number)."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def mean(df: DataFrame, name: str) -> Column:
    """Average of a column: from the exact sum where the type has one."""
    if isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType)):
        return F.sum(name).cast("double") / F.count(name)
    return F.avg(name)
