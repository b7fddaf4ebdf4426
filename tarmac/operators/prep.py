"""Leakage-aware feature preparation.

Levels and medians are learned on the train rows only and applied to every
split. Levels are a table (feature, level, idx) that is joined to the rows, broadcast
behind a size check and shuffled beyond it, so a factor may have any number of levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.flags import coco_text, precip_flag, precip_indicator, wind_cos, wind_sin
from tarmac.operators.quantiles import exact_quantiles
from tarmac.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, size_at_most

# The predictor sets of the two model families.
RIDGE_FACTORS = ["carrier", "origin", "dest", "dep_hour_local", "dow", "month", "coco"]
RIDGE_NUMERICS = ["temp", "wspd", "rhum", "pres", "prcp", "has_prcp", "wdir_sin", "wdir_cos"]
TREE_FACTORS = ["carrier", "origin", "dest", "dep_hour_local", "dow", "month", "coco", "has_prcp"]
TREE_NUMERICS = ["temp", "wspd", "rhum", "pres", "prcp", "wdir_sin", "wdir_cos"]
OTHER, MISSING = "other", "missing"


def ridge_features(df: DataFrame, keep: Sequence[str] = ("flight_id", "split")) -> DataFrame:
    """Ridge frame: factors as text (coco NULL -> ``missing``), 0/1/NULL rain
    indicator, wind direction as sine/cosine."""
    keep = [c for c in keep if c in df.columns]
    return df.select(
        *keep, "dep_delay_min",
        *[F.col(c).cast("string").alias(c) for c in RIDGE_FACTORS[:-1]],
        coco_text(F.col("coco")).alias("coco"),
        "temp", "wspd", "rhum", "pres", "prcp",
        precip_indicator(F.col("prcp")).alias("has_prcp"),
        wind_sin(F.col("wdir")).alias("wdir_sin"), wind_cos(F.col("wdir")).alias("wdir_cos"))


def tree_features(df: DataFrame, keep: Sequence[str] = ("flight_id", "split")) -> DataFrame:
    """Tree frame: same numerics, three-way rain flag as a factor."""
    keep = [c for c in keep if c in df.columns]
    return df.select(
        *keep, "dep_delay_min",
        *[F.col(c).cast("string").alias(c) for c in TREE_FACTORS[:-1]],
        precip_flag(F.col("prcp")).alias("has_prcp"),
        "temp", "wspd", "rhum", "pres", "prcp",
        wind_sin(F.col("wdir")).alias("wdir_sin"), wind_cos(F.col("wdir")).alias("wdir_cos"))


def _long(df: DataFrame, cols: Sequence[str], value_type: str = "string") -> DataFrame:
    """(feature, value) pairs for the listed columns."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast(value_type).alias("value"))
        for c in cols])).alias("kv")).select("kv.feature", "kv.value")


def category_levels(train: DataFrame, cols: Sequence[str], variant: str = "other") -> DataFrame:
    """(feature, level, idx): the model's levels per factor, from one
    aggregation of the train rows.

    ``variant="other"``: sorted distinct non-NULL train values, then ``other`` last.
    ``variant="missing"``: sorted distinct of train values (NULL/empty ->
    ``missing``) plus ``missing`` and ``other``.
    """
    value = F.col("value")
    if variant == "missing":
        value = F.when(value.isNull() | (value == ""), F.lit(MISSING)).otherwise(value)
    seen = _long(train, cols).select("feature", value.alias("level")).where("level is not null").distinct()
    added = (OTHER,) if variant == "other" else (MISSING, OTHER)
    extra = train.sparkSession.createDataFrame([(c, lv) for c in cols for lv in added], "feature string, level string")
    last = F.lit(variant == "other") & (F.col("level") == OTHER)
    order = Window.partitionBy("feature").orderBy(last, "level")
    return (seen.unionByName(extra).distinct()
            .select("feature", "level", (F.row_number().over(order) - 1).cast("long").alias("idx")))


def level_lists(levels: DataFrame) -> dict[str, list[str]]:
    """Levels per factor in order: the names of a design's columns, as many as it is wide."""
    out: dict[str, list[tuple[int, str]]] = {}
    for r in levels.collect():
        out.setdefault(r["feature"], []).append((r["idx"], r["level"]))
    return {k: [lv for _, lv in sorted(v)] for k, v in out.items()}


def align_levels(df: DataFrame, levels: DataFrame, cols: Sequence[str], variant: str = "other",
                 index: str | None = None) -> DataFrame:
    """Replace each factor value by itself when it is a model level, else by
    ``other``; NULL -> ``other`` (variant ``other``) or NULL/empty ->
    ``missing`` (variant ``missing``). With ``index`` a column ``<factor><index>``
    holds the level's place. The level table is joined, factor by factor."""
    small = size_at_most(levels, DEFAULT_MAX_BROADCAST_ROWS, DEFAULT_MAX_BROADCAST_BYTES)
    others = {r["feature"]: r["idx"] for r in levels.where(F.col("level") == OTHER).collect()} if index else {}
    out = df
    for c in cols:
        val = F.col(c).cast("string")
        if variant == "missing":
            val = F.when(val.isNull() | (val == ""), F.lit(MISSING)).otherwise(val)
        of = levels.where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("idx").alias("_idx"))
        out = out.withColumn("_value", val).join(F.broadcast(of) if small else of, F.col("_value") == F.col("_level"), "left")
        new = {c: F.coalesce("_level", F.lit(OTHER))}
        if index:
            new[f"{c}{index}"] = F.coalesce("_idx", F.lit(others[c])).cast("int")
        out = out.withColumns(new).drop("_value", "_level", "_idx")
    return out


def train_medians(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, median) over the train rows; no finite median -> 0."""
    med = exact_quantiles(_long(train, cols, "double"), ["feature"], "value", [0.5], ["median"])
    names = train.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))
    return (names.join(med, "feature", "left")
            .select("feature", F.when(F.isnan("median") | F.col("median").isNull()
                                      | (F.abs("median") == float("inf")), F.lit(0.0))
                    .otherwise(F.col("median")).alias("median")))


def median_values(medians: DataFrame) -> dict[str, float]:
    """The train medians as a dict: one number per numeric predictor."""
    return {r["feature"]: r["median"] for r in medians.collect()}


def impute_medians(df: DataFrame, medians: DataFrame | dict[str, float]) -> DataFrame:
    """Fill NULLs with the train medians (a handful of numbers, read once)."""
    values = medians if isinstance(medians, dict) else median_values(medians)
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])
