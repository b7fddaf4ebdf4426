"""Right-closed equal-width bins, as in a ``cut`` with ``breaks = seq(lo, hi, w)``.

Bin ``k`` (1-based) is ``(lo + (k-1) w, lo + k w]``; with ``include_lowest``
the first bin also takes ``lo``. Values outside ``[lo, hi]`` fall in no bin
(NULL). ``Bucketizer`` and ``width_bucket`` are left-closed, hence the formula.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_index(x: Column, lo: float, hi: float, width: float,
              include_lowest: bool = False) -> Column:
    n = int(round((hi - lo) / width))
    k = F.ceil((x - F.lit(lo)) / F.lit(width))
    if include_lowest:
        k = F.when(x == F.lit(lo), F.lit(1)).otherwise(k)
    return F.when((k >= 1) & (k <= n), k.cast("int"))


def _fmt(v: Column) -> Column:
    # integral breaks print without a decimal point
    return F.when(v == F.floor(v), F.floor(v).cast("bigint").cast("string")).otherwise(
        v.cast("string"))


def cut_label(x: Column, lo: float, hi: float, width: float,
              include_lowest: bool = False) -> Column:
    """Interval text like ``(-50,-45]``; the first bin reads ``[0,10]`` when
    ``include_lowest``."""
    k = cut_index(x, lo, hi, width, include_lowest)
    left = F.lit(float(lo)) + (k - 1).cast("double") * F.lit(float(width))
    right = left + F.lit(float(width))
    opening = F.when((k == 1) & F.lit(include_lowest), F.lit("[")).otherwise(F.lit("("))
    return F.when(k.isNotNull(), F.concat(opening, _fmt(left), F.lit(","), _fmt(right), F.lit("]")))


def hist_center(x: Column, width: float) -> Column:
    """Centre of the histogram bin holding ``x``: bins are right-closed and
    centred on multiples of ``width``."""
    return (F.ceil((x - F.lit(width / 2.0)) / F.lit(width)) * F.lit(width)).cast("double")
