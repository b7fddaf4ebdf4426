"""Mixing sources to target weights by temperature.

A source with token share p gets the weight ``p**a / sum(p**a)``. The exponent a
in [0, 1] is bisected until the weights' entropy meets ``target_entropy`` or until
no source is repeated more than ``max_repeat`` times as often as the least
repeated one (smallest a that keeps the limit). Every pass evaluates the 31
midpoints of five bisection steps in one aggregate over the table of sources.

The token budget (one epoch of the least repeated source, unless given) times the
weight is a source's budget. It is realised as whole epochs plus a partial one:
documents are dealt into hashed blocks of about ``BLOCK_DOCS``; an epoch permutes
the blocks by a keyed hash, and the documents inside a block by another; the
partial epoch takes the longest prefix of that order within the budget. Prefix
sums run over blocks, then inside blocks, so a hot source is no hot task.

Tokens are the words ``[^\\x20\\x09-\\x0D]+``. Edge cases: a null or empty text has 0
tokens and takes part in every epoch's order; a null source is a source of its
own; sources without tokens keep one copy of each row; an empty table gives an
empty result; repeated rows are mixed each on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.base import Scratch, source_key

BLOCK_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"
PASSES, STEPS = 10, 5


def exponent(per: DataFrame, target_entropy: float | None, max_repeat: float | None) -> float:
    """The exponent for ``per (p)``, positive token shares of the sources."""
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        k = 1 << STEPS
        grid = [low + (high - low) * i / k for i in range(1, k)]
        aggs = []
        for i, a in enumerate(grid):
            q = F.pow("p", F.lit(a))
            if target_entropy is not None:
                z = F.sum(q)
                aggs.append((F.log(z) - F.lit(a) * F.sum(q * F.log("p")) / z).alias(f"v{i}"))
            else:
                aggs.append(F.pow(F.max("p") / F.min("p"), F.lit(1 - a)).alias(f"v{i}"))
        row = per.agg(*aggs).first()
        limit = target_entropy if target_entropy is not None else max_repeat
        if row[0] is None:
            return 1.0
        # entropy and repetition both fall as the exponent grows
        above = sum(v > limit for v in row)
        low, high = low + (high - low) * above / k, low + (high - low) * (above + 1) / k
    return 0.0 if low == 0.0 and high < 1e-12 else high


def weights(tokens: DataFrame, scratch: Scratch, target_entropy: float | None = None, max_repeat: float | None = None,
            budget_tokens: float | None = None) -> DataFrame:
    """``src, docs, tokens, weight, budget, epochs, partial`` per source of ``tokens (src, n)``."""
    per = scratch.put(tokens.groupBy("src").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")), "sources")
    total = per.agg(F.sum("tokens"), F.max("tokens")).first()
    all_tokens, most = float(total[0] or 0) or 1.0, float(total[1] or 0) or 1.0
    a = exponent(per.where("tokens > 0").select((F.col("tokens") / F.lit(all_tokens)).alias("p")), target_entropy, max_repeat)
    z = per.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.lit(all_tokens), F.lit(a)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(all_tokens), F.lit(a)) / F.lit(z)).otherwise(F.lit(0.0))
    budget = budget_tokens if budget_tokens is not None else most / ((most / all_tokens) ** a / z)
    per = (per.withColumn("weight", weight).withColumn("budget", F.col("weight") * F.lit(float(budget)))
           .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + F.lit(1e-9)))
                       .otherwise(F.lit(1)).cast("long")))
    return per.withColumn("partial", F.greatest(F.lit(0.0), F.col("budget") - F.col("epochs") * F.col("tokens")))


def _hash(*cols) -> F.Column:
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]).cast("binary"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        target_entropy: float | None = None, max_repeat: float | None = None, budget_tokens: float | None = None,
        key: int = 11, scratch: Scratch | None = None) -> DataFrame:
    """``id_col, source, n_tokens, block, copies``: how often each row is drawn."""
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    rows = scratch.put(docs.select(
        F.col(id_col).alias("doc"), F.col(source_col).alias("source"), source_key(source_col).alias("src"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("n")), "rows")
    per = scratch.put(weights(rows, scratch, target_entropy, max_repeat, budget_tokens), "weights")
    k = F.lit(key)
    deal = F.conv(F.substring(_hash(k, F.coalesce(F.col("doc").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    placed = rows.join(per.select("src", F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).alias("blocks"), "epochs", "partial"), "src")
    placed = placed.withColumn("block", deal % F.col("blocks"))
    tot = placed.groupBy("src", "block").agg(F.sum("n").alias("tokens"), F.max("epochs").alias("epochs"))
    turn = Window.partitionBy("src").orderBy(_hash(k, F.col("src"), F.col("epochs"), F.col("block")), "block").rowsBetween(
        Window.unboundedPreceding, -1)
    tot = tot.withColumn("base", F.coalesce(F.sum("tokens").over(turn), F.lit(0))).select("src", "block", "base")
    inside = Window.partitionBy("src", "block").orderBy(
        _hash(k, F.col("epochs"), F.coalesce(F.col("doc").cast("string"), F.lit(""))), "n").rowsBetween(
        Window.unboundedPreceding, 0)
    cum = F.sum("n").over(inside)
    out = placed.withColumn("cum", cum).join(tot, ["src", "block"])
    taken = (F.col("partial") > 0) & (F.col("base") + F.col("cum") <= F.col("partial"))
    return out.select(F.col("doc").alias(id_col), "source", F.col("n").alias("n_tokens"), "block",
                      (F.col("epochs") + taken.cast("long")).alias("copies"))


def draw(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The mixed table itself: every row of ``docs`` as often as it is drawn (rows
    that repeat an id are drawn alike)."""
    scratch = Scratch(docs.sparkSession, "draw")
    copies = mix(docs, id_col, scratch=scratch, **kw).groupBy(F.col(id_col).alias("_id")).agg(F.max("copies").alias("_c"))
    drawn = docs.join(copies, docs[id_col].eqNullSafe(copies["_id"])).where(copies["_c"] > 0)
    times = F.explode(F.sequence(F.lit(1).cast("long"), copies["_c"])).alias("_drawn_time")
    return drawn.select(*[docs[c] for c in docs.columns], times).drop("_drawn_time")
