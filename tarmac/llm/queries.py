"""Registered queries of the training-corpus operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir, importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# the component query of DuckDB: smallest id reachable over `links(a, b)` for every `nodes(id)`
REACH_SQL = """,
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, r) AS (SELECT id, id FROM nodes UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
nodes AS (SELECT d.doc_id AS id, count(s) AS n FROM documents d LEFT JOIN sh USING (doc_id) GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * c >= 75 * (p.n + q.n - c))""" + REACH_SQL + """
SELECT nodes.id AS doc_id, n AS n_shingles, component_id, nodes.id = component_id AS kept FROM nodes JOIN comp ON comp.id = nodes.id"""


@query("op4_minhash_near_dedup", OP4_SQL)
def op4(spark, sf_dir):
    """Near-duplicate groups of all documents over five-word shingles at 0.75."""
    from tarmac.llm.near import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_mixture_packing")
def op5(spark, sf_dir):
    """All documents packed into windows of 2048 tokens by deficit round-robin."""
    from tarmac.llm.packing import pack
    return pieces_digest(pack(table(spark, sf_dir, "documents")))


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query("op9_training_order_shards")
def op9(spark, sf_dir):
    """Every document's sequences at their permuted slots, read back from the shards."""
    from tarmac.llm.base import Scratch
    from tarmac.llm.shards import ROWS_PER_SHARD, SEQ_LEN, write_shards
    path = Scratch(spark, "training-order").root
    out = write_shards(table(spark, sf_dir, "documents"), path)
    row = F.col("slot") % ROWS_PER_SHARD
    used = F.expr(f"substring(ids, 1, cast(n_tokens * (length(ids) / {SEQ_LEN}) as int))")
    return out.select("doc_id", "seq_no", (F.col("seq_no") * SEQ_LEN).alias("start"), "n_tokens", "slot", "shard",
                      row.alias("row"), (row * F.length("ids")).alias("byte_offset"),
                      F.length("ids").cast("long").alias("stride"), F.crc32(used).alias("ids_crc32"))


@query("op10_trie_token_counts")
def op10(spark, sf_dir):
    """Unigram token counts of every document."""
    from tarmac.llm.counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"))


MAX_REPEAT = 2.0
OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce('s:' || source, 'n') AS src,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
per AS (SELECT src, sum(n) AS t, count(*) AS docs FROM d GROUP BY 1),
ends AS (SELECT max(t)::DOUBLE AS hi, min(t)::DOUBLE AS lo FROM per WHERE t > 0),
ex AS (SELECT hi, CASE WHEN hi > lo THEN greatest(0.0, 1 - ln(2.0) / ln(hi / lo)) ELSE 0.0 END AS a FROM ends),
bud AS (SELECT src, t, docs, CASE WHEN t > 0 THEN hi * pow(t / hi, a) ELSE 0 END AS b FROM per, ex),
ep AS (SELECT *, CASE WHEN t > 0 THEN floor(b / t + 1e-9) ELSE 1 END::BIGINT AS e FROM bud),
pa AS (SELECT src, e, greatest(0.0, b - e * t) AS part, ceil(docs / 4096.0)::BIGINT AS blocks FROM ep),
pl AS (SELECT d.*, e, part, ('0x' || substr(md5('11:' || doc_id), 1, 8))::BIGINT % blocks AS block FROM d JOIN pa USING (src)),
c AS (SELECT *, sum(n) OVER (PARTITION BY src ORDER BY md5('11:' || src || ':' || e || ':' || block), block,
                             md5('11:' || e || ':' || doc_id), n ROWS UNBOUNDED PRECEDING) AS cum FROM pl)
SELECT doc_id, source, n::BIGINT AS n_tokens, block, e + (part > 0 AND cum <= part)::BIGINT AS copies FROM c"""


@query("op6_temperature_mixing", OP6_SQL)
def op6(spark, sf_dir):
    """How often each document is drawn when no source repeats more than twice."""
    from tarmac.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"), max_repeat=MAX_REPEAT)


PROBE = "</s>[INST] ok [/INST]"
OP1_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\|endoftext\|>|\|im_start\|>|\|im_end\|>|</SYS>>|<SYS>>|/INST\]|INST\]|/s>|s>)', '\1\\\2\3', 'g') AS esc FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(role) + 1 + length(esc) + 11)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


@query("op1_chat_format", OP1_SQL)
def op1(spark, sf_dir):
    """Every conversation (and the probe -7) formatted, with digests read back from the output."""
    from tarmac.llm.chat import chain, formatted, loss_text, parsed
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    out = formatted(chain(rows.unionByName(probe), "conv_id", "turn"))
    turns = parsed(F.col("formatted"))
    said = F.concat_ws("", F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))))
    out = out.withColumn("turns", turns).withColumn("lost", loss_text(F.col("formatted"), F.col("loss")))
    return out.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.length("lost").cast("long").alias("loss_chars"),
                      F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


@query("op8_weak_toxicity")
def op8(spark, sf_dir):
    """Toxicity score of every document."""
    from tarmac.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id < y.id
          AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93)""" + REACH_SQL + """,
deg AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT nodes.id AS vec_id, coalesce(deg.n, 0) AS n_links, component_id, nodes.id = component_id AS kept
FROM nodes JOIN comp ON comp.id = nodes.id LEFT JOIN deg ON deg.a = nodes.id"""


@query("op3_pq_near_vectors", OP3_SQL)
def op3(spark, sf_dir):
    """Near-duplicate vectors of equal label at cosine 0.93."""
    from tarmac.llm.vectors import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


TOP_K = 10
OP2_SQL = r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*)::DOUBLE AS tf FROM w GROUP BY 1, 2),
dl AS (SELECT d.doc_id, count(t)::DOUBLE AS dl FROM documents d LEFT JOIN w USING (doc_id) GROUP BY 1),
st AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS mean FROM dl),
df AS (SELECT t, count(*)::DOUBLE AS df FROM tf GROUP BY 1),
sc AS (SELECT q.doc_id AS query_id, p.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
       FROM tf q JOIN tf p ON p.t = q.t JOIN df ON df.t = q.t JOIN dl ON dl.doc_id = p.doc_id, st WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc)
SELECT query_id, rank, doc_id, score FROM r WHERE rank <= 10"""


@query("op2_bm25_top_k", OP2_SQL)
def op2(spark, sf_dir):
    """The 10 best documents for every document whose id is divisible by 100."""
    from tarmac.llm.search import top_k
    docs = table(spark, sf_dir, "documents")
    asked = docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return top_k(docs, asked, TOP_K)


@query("op7_pitman_yor_scores")
def op7(spark, sf_dir):
    """Log-probabilities of every document under a model of the training documents."""
    from tarmac.llm.lm import score_texts
    return score_texts(table(spark, sf_dir, "documents"))


SEARCH_K = 20
OP11_SQL = r"""
WITH dt AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
it AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
len AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY 1),
st AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM len),
norm AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // l) AS m FROM len, st),
tf AS (SELECT doc_id, t, count(*) AS tf FROM dt GROUP BY 1, 2),
q AS (SELECT item_id, t, count(*) AS c FROM it GROUP BY 1, 2),
wt AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, st GROUP BY t, docs),
sc AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
       FROM q JOIN wt USING (t) JOIN tf USING (t) JOIN norm USING (doc_id) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""


@query("op11_stratified_search", OP11_SQL)
def op11(spark, sf_dir):
    """The 20 best documents for every benchmark item."""
    from tarmac.llm.strata import ranked
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), SEARCH_K)


@query("op13_cholesky_whitening")
def op13(spark, sf_dir):
    """The whitened first 8 components of every vector."""
    from tarmac.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


@query("op12_block_extraction")
def op12(spark, sf_dir):
    """The main text of every page."""
    from tarmac.llm.pages import extract
    return extract(table(spark, sf_dir, "pages"))
