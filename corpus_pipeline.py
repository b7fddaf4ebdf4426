"""The corpus pipeline: toxicity filter, near-dedup, source mixing, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's documents. ``run`` writes every stage's result as
Parquet into the cluster's shared folder and rereads it as the next one's input,
so a lost executor re-reads files instead of repeating earlier stages. All but
the last stage return the columns of ``documents``; the last returns pieces of
packed sequences.

Every row is judged as itself: the first two stages number their rows and decide by that
number, so rows without an id are judged too and rows that repeat an id do not stand for
each other. Texts may be null or empty in every stage, tables empty, and further columns of
any name are carried along (see the operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: pipeline mixing: no source is drawn more than this many times as often as the least drawn one
MAX_REPEAT = 1.25


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number per row, written so that it stands; and the number's column."""
    from tarmac.llm.base import Scratch

    name = "_row"
    while name in docs.columns:
        name += "_"
    return Scratch(docs.sparkSession, "rows").put(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier doesn't reject."""
    from tarmac.llm.toxicity import toxicity
    from tarmac.session import importable

    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, number = _numbered(docs)
    bad = toxicity(rows, labels, row_col=number).where("predicted = 1").select(number)
    return rows.join(bad, number, "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate group: one with the smallest id (a null id is largest).
    Rows without words are in no group and stay."""
    from tarmac.llm.near import near_duplicates
    from tarmac.session import importable

    importable(spark)
    rows, number = _numbered(docs)
    groups = near_duplicates(rows, number)
    inside = groups.where("n_shingles > 0").join(rows.select(number, "doc_id"), number)
    first = inside.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", number)).alias("r"))
    stay = first.select(F.col(f"r.{number}").alias(number)).unionByName(groups.where("n_shingles = 0").select(number))
    return rows.join(stay, number, "left_semi").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to MAX_REPEAT times as often."""
    from tarmac.llm.mixing import draw
    from tarmac.session import importable

    importable(spark)
    return draw(docs, max_repeat=MAX_REPEAT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens in the sources' proportions."""
    from tarmac.llm.packing import pack
    from tarmac.llm.queries import pieces_digest
    from tarmac.session import importable

    importable(spark)
    return pieces_digest(pack(docs))


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: the classifier and the tokenizer of the stages have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage has written for itself, and the rows of the
    stage before, go once its own rows are written."""
    from tarmac.llm.base import Scratch, spent

    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with spent(spark):
            docs = scratch.put(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
