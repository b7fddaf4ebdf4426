"""Boosted regression trees that go on round by round.

Squared-error boosting with MLlib's own trees: a round fits one tree (a random forest of
one, on a share of the rows and of the columns per node) to twice the residuals, the
first tree counts in full and every later one ``step``-fold. That is what MLlib's boosted
trees do inside one ``fit``; here the rounds are ours, so none is ever fitted again:

* rounds come in blocks. Within a block a round's train rows are kept with their label, as
  a fit passes over them several times: a round adds the last tree to the rows of the round
  before and drops those. After a block the new predictions are written beside features and
  target, for train and validation rows, so a round never replays the rounds before its
  block and a lost executor re-reads files;
* one aggregation over the validation rows gives the error after each of the block's rounds;
* a block ends with a record of its errors, written last. With ``folder`` a run that was
  stopped goes on after its last recorded block; a record of other rows or other
  parameters is not taken up.

Boosting stops once ``patience`` rounds pass without a better error; the model is the
trees up to the best round."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.session import drop_path, scratch_path
from tarmac.sources.paths import path_exists

BLOCK = 10
_SO_FAR, _LABEL = "_so_far", "_label"


def best_round(curve: Sequence[float], patience: int = 40) -> int:
    """Trees to keep: the best validation score, stopping once ``patience``
    rounds pass without a strict improvement."""
    best_i, best = 0, float("inf")
    for i, v in enumerate(curve):
        if v < best:
            best_i, best = i, v
        elif i - best_i >= patience:
            break
    return best_i + 1


@dataclass
class Boosted:
    """Trees of all rounds, their weights and the validation error after each."""
    trees: list[RandomForestRegressionModel]
    step: float
    curve: list[float]
    best: int

    def model(self, prediction: str = "prediction") -> PipelineModel:
        """The trees up to the best round, added up."""
        names = [f"_tree{k}" for k in range(self.best)]
        stages = [t.copy().setPredictionCol(n) for t, n in zip(self.trees, names)]
        weighted = ", ".join(n if k == 0 else f"{self.step!r}D * {n}" for k, n in enumerate(names))
        total = SQLTransformer(statement=f"SELECT *, aggregate(array({weighted}), 0D, (a, x) -> a + x) AS {prediction} FROM __THIS__")
        return PipelineModel(stages=[*stages, total])

    def predict(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        return self.model(prediction).transform(df).drop(*[f"_tree{k}" for k in range(self.best)])


class _Progress:
    """Blocks under a folder: predictions, trees, and a record written last."""

    def __init__(self, spark, folder: str | None, mark: dict):
        self.spark, self.mark, self.resumable = spark, mark, folder is not None
        self.folder = (folder or scratch_path(spark, f"boosting-{uuid.uuid4().hex[:12]}")).rstrip("/")

    def path(self, rounds: int, what: str) -> str:
        return f"{self.folder}/rounds={rounds}/{what}"

    def last(self) -> dict | None:
        """The record of the last finished block of the same run."""
        if not path_exists(self.spark, self.folder):
            return None
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        rounds = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(top, "rounds=*")) or [])
        for n in reversed(rounds):
            if path_exists(self.spark, self.path(n, "record/_SUCCESS")):
                record = json.loads(self.spark.read.text(self.path(n, "record")).first()["value"])
                return record if record["mark"] == self.mark else None
        return None

    def tables(self, rounds: int) -> tuple[DataFrame, DataFrame]:
        return tuple(self.spark.read.parquet(self.path(rounds, w)) for w in ("train", "valid"))

    def trees(self, rounds: int) -> list[RandomForestRegressionModel]:
        return [RandomForestRegressionModel.load(f"{self.folder}/trees/{k}") for k in range(rounds)]

    def put(self, rounds: int, train: DataFrame, valid: DataFrame, trees, first: int, curve: list[float]) -> None:
        if self.resumable:
            with ThreadPoolExecutor(4) as pool:  # small files each
                list(pool.map(lambda k: trees[k].write().overwrite().save(f"{self.folder}/trees/{first + k}"), range(len(trees))))
        for what, df in (("train", train), ("valid", valid)):
            df.write.mode("overwrite").parquet(self.path(rounds, what))
        if not self.resumable:
            return
        record = json.dumps({"mark": self.mark, "rounds": rounds, "curve": curve})
        self.spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(self.path(rounds, "record"))

    def drop_block(self, rounds: int) -> None:
        drop_path(self.spark, f"{self.folder}/rounds={rounds}")


def _after(trees: int, step: float, first: int) -> Column:
    """The prediction after a block's first ``trees`` trees; ``first``: rounds before the block."""
    out = F.col(_SO_FAR)
    for k in range(trees):
        out = out + F.col(f"_t{k}") * (1.0 if first + k == 0 else step)
    return out


def boost(train: DataFrame, valid: DataFrame, target: str, features: str = "features", max_rounds: int = 1000, patience: int = 40,
          seed: int = 42, step: float = 0.05, block: int = BLOCK, folder: str | None = None, **tree) -> Boosted:
    """Rounds until ``patience`` or ``max_rounds``. ``tree``: parameters of the trees (MLlib's names)."""
    spark = train.sparkSession
    forest = RandomForestRegressor(featuresCol=features, labelCol=_LABEL, numTrees=1, bootstrap=False, **tree)
    keep = [features, target, _SO_FAR]
    start = [df.select(features, target).withColumn(_SO_FAR, F.lit(0.0)) for df in (train, valid)]
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("s")).first()
    mark = {"rows": row.n, "target": round(row.s or 0.0, 3), "seed": seed, "step": step, **{k: str(v) for k, v in sorted(tree.items())}}
    progress = _Progress(spark, folder, mark)
    record = progress.last() if folder else None
    done, curve = (record["rounds"], record["curve"]) if record else (0, [])
    trees = progress.trees(done)
    rows, held = progress.tables(done) if done else start
    while done < max_rounds and not (curve and best_round(curve, patience) + patience <= len(curve)):
        new: list[RandomForestRegressionModel] = []
        kept: DataFrame | None = None
        for k in range(min(block, max_rounds - done)):
            residual = F.col(target) - F.col(_SO_FAR)
            label = F.col(target).cast("double") if done + k == 0 else 2.0 * residual
            now = rows.withColumn(_LABEL, label).select(*keep, _LABEL).persist(StorageLevel.MEMORY_AND_DISK)
            fitted = forest.copy({forest.seed: seed + done + k}).fit(now.select(features, _LABEL))
            if kept is not None:
                kept.unpersist()
            kept = now
            new.append(fitted.setPredictionCol(f"_t{k}"))
            weight = 1.0 if done + k == 0 else step
            rows = new[-1].transform(now).withColumn(_SO_FAR, F.col(_SO_FAR) + F.col(f"_t{k}") * weight).select(*keep)
            held = new[-1].transform(held)
        errors = held.agg(*[F.avg(F.abs(_after(k + 1, step, done) - F.col(target))).alias(f"e{k}") for k in range(len(new))]).first()
        curve = curve + [e if e is not None else float("inf") for e in errors]
        trees += new
        before, done = done, done + len(new)
        held = held.withColumn(_SO_FAR, _after(len(new), step, before)).select(*keep)
        progress.put(done, rows, held, new, before, curve)
        kept.unpersist()
        rows, held = progress.tables(done)
        if before:
            progress.drop_block(before)
    return Boosted(trees, step, curve, best_round(curve, patience))
