"""Row-level flags and derived measures used by the EDA and the models."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text the airport file uses for "no value" (backslash, N).
SENTINEL = "\\N"


def is_present(c: Column) -> Column:
    """Not NULL, not empty, not the ``\\N`` sentinel."""
    return c.isNotNull() & (c != F.lit("")) & (c != F.lit(SENTINEL))


def late_flag(delay: Column, threshold: float = 15) -> Column:
    """``delay >= 15``; NULL stays NULL."""
    return delay >= F.lit(threshold)


def positive_part(delay: Column) -> Column:
    """Negative delays become 0, NULL stays NULL (``greatest`` would give 0)."""
    return F.when(delay < 0, F.lit(0.0)).otherwise(delay.cast("double"))


def precip_flag(prcp: Column) -> Column:
    """Three-way text: ``missing`` / ``yes`` / ``no``."""
    return (F.when(prcp.isNull(), F.lit("missing"))
            .when(prcp > 0, F.lit("yes")).otherwise(F.lit("no")))


def precip_indicator(prcp: Column) -> Column:
    """1.0 / 0.0 / NULL form of the precipitation flag."""
    return F.when(prcp.isNull(), F.lit(None).cast("double")).otherwise(
        (prcp > 0).cast("double"))


def wind_sin(wdir: Column) -> Column:
    return F.sin(wdir * F.lit(math.pi / 180.0))


def wind_cos(wdir: Column) -> Column:
    return F.cos(wdir * F.lit(math.pi / 180.0))


def coco_text(coco: Column) -> Column:
    """Weather condition code as text, NULL -> ``missing``."""
    return F.coalesce(coco.cast("string"), F.lit("missing"))


def rain_label(prcp: Column) -> Column:
    """``Rain`` / ``No rain`` / NULL."""
    return F.when(prcp > 0, F.lit("Rain")).when(prcp.isNotNull(), F.lit("No rain"))
