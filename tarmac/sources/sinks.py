"""Feature, metric, prediction and model sinks."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tarmac.sources.paths import path_exists


def write_features(df: DataFrame, out_root: str) -> None:
    """Features partitioned by the flight's own ``year`` and ``month`` (its date at
    the origin, not the UTC schedule, which may fall into the next month), so a
    month's run replaces exactly that month's flights. Rebalanced by month (AQE
    splits big months into advisory-size tasks)."""
    (df.hint("rebalance", "year", "month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(out_root))


def register_views(spark: SparkSession, roots: dict[str, str]) -> None:
    """Temporary SQL views over landed Parquet, by name; a root that is not there
    is left out."""
    for name, root in roots.items():
        if path_exists(spark, root):
            spark.read.parquet(root).createOrReplaceTempView(name)


def write_small_csv(df: DataFrame, path: str) -> None:
    """Metrics / split counts: a handful of rows, one file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_small_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


METRICS_SCHEMA = ("model string, split string, n long, mae double, rmse double, median_ae double, "
                  "p90_ae double, bias double")


def append_metrics(spark: SparkSession, new: DataFrame, prior_path: str, schema: str = METRICS_SCHEMA) -> DataFrame:
    """Prior metrics (when the file exists) with ``new`` appended by name."""
    if path_exists(spark, prior_path):
        return read_small_csv(spark, prior_path, schema).unionByName(new, allowMissingColumns=True)
    return new


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions, one folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def save_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """One JSON document (levels, medians, parameters, small coefficient tables)."""
    (spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "value string")
     .coalesce(1).write.mode("overwrite").text(f"{path}/metadata"))


def load_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()["value"])


def save_model(spark: SparkSession, model: PipelineModel, path: str, metadata: dict) -> None:
    """Model with its metadata next to it."""
    model.write().overwrite().save(f"{path}/model")
    save_metadata(spark, path, metadata)


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), load_metadata(spark, path)
