"""Ratios (FN9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pct_one_decimal(part, whole) -> Column:
    """Percentage with one decimal, half-up, computed on integers.

    ``(part*2000 + whole) div (2*whole) / 10`` avoids engine-specific rounding
    of binary doubles at ties.  NULL when ``whole`` is 0.
    """
    p, w = _c(part).cast("bigint"), _c(whole).cast("bigint")
    num, den = p * 2000 + w, 2 * w
    # exact integer division: num - num % den is a multiple of den
    permille = F.when(w != 0, ((num - num % den) / den).cast("bigint"))
    return (permille / F.lit(10.0)).cast("double")
