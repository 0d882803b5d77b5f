"""Numeric conventions: rounding of the scaled binary value, clipping, and missing values as null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(x: Column, digits: int) -> Column:
    """Round half to even on ``x * 10**digits``; Spark's round works on the decimal text instead."""
    k = 10.0**digits
    return F.rint(x * k) / k


def clip(x: Column, low: float, high: float) -> Column:
    """``x`` within [low, high]; null stays null, which least and greatest alone would lose."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))


def nan_to_null(x: Column) -> Column:
    return F.nanvl(x, F.lit(None).cast("double"))


def holds(condition: Column) -> Column:
    """The condition, false where it is unknown."""
    return F.coalesce(condition, F.lit(False))
