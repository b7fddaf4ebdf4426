"""Reply trees to chat conversations.

``formatted`` takes messages ``(tree, node, parent, role, text, score)``:

1. iterative self-joins double every message's pointer to its ancestor (1, 2, 4,
   ... levels), which gives depth and path score in log2(depth) rounds;
2. leaves are ranked in their tree by mean score of the path, ties by longer path,
   then smaller node; the best ``branches`` leaves stay;
3. the doubled pointers, largest first, list each chosen leaf's ancestors, every
   one exactly once;
4. each chosen root-to-leaf path becomes one formatted conversation with the
   character spans of its assistant texts (the loss mask).

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts and
roles get one backslash after their first character (one more if some stand there
already), so no text can open or close a turn and ``parsed`` restores every text.

Edge cases: a null text or role is empty; a null tree is a tree of its own; a
parent that does not exist makes a root; messages in a cycle reach no root and
give no conversation; repeated (tree, node) rows raise no error but each stands
for the other, so give nodes that are unique in their tree (``chain`` numbers
them; equal rows are turns of their own there); very long texts stay whole; an empty
table gives no conversations; other columns are ignored, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.base import Scratch

START, END = "<|im_start|>", "<|im_end|>\n"
#: control strings of common chat templates (fixed values); the first character opens them
CONTROL = [START, END[:-1], "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def _quote(s: str) -> str:
    return "".join("\\" + c if c in r"\|[](){}.*+?^$" else c for c in s)


_REST = "|".join(_quote(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
ESCAPE = rf"([<\[])(\\*)({_REST})"
UNESCAPE = rf"([<\[])\\(\\*)({_REST})"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(ESCAPE), F.lit(r"$1\\$2$3"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(UNESCAPE), F.lit("$1$2$3"))


def escape_role(c: Column) -> Column:
    """One line: a backslash becomes backslash-s, a line end backslash-n, so a backslash is
    always the first of two characters."""
    return F.replace(F.replace(escape(c), F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\")))


def chain(rows: DataFrame, tree_col: str, turn_col: str, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of linear conversations: each turn replies to the one before it
    (order: turn, then role, then text; nulls first)."""
    w = Window.partitionBy(tree_col).orderBy(turn_col, role_col, text_col)
    n = F.row_number().over(w).cast("long")
    return (rows.select(F.col(tree_col).alias("tree"), n.alias("node"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text"), F.lit(1.0).alias("score"))
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)))


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, rank, n_turns, formatted, loss (array of start, length)``."""
    scratch = Scratch(messages.sparkSession, "chat")
    t = F.coalesce(F.concat(F.lit("t"), F.col("tree").cast("string")), F.lit("n"))
    msg = scratch.put(messages.select(t.alias("t"), "tree", F.col("node").cast("long").alias("node"),
                                      F.col("parent").cast("long").alias("parent"),
                                      F.coalesce("role", F.lit("")).alias("role"),
                                      F.coalesce("text", F.lit("")).alias("text"),
                                      F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "messages")
    nodes = msg.select("t", F.col("node").alias("parent"), F.lit(1).alias("there"))
    links = (msg.select("t", "node", "parent", "score").join(nodes, ["t", "parent"], "left")
             .select("t", "node", F.when(F.col("there") == 1, F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"), "score"))
    links = scratch.put(links, "jump")
    # messages whose pointer has passed the root are done and only looked up from then on
    jumps, done = [links.where("up is not null")], links.where("up is null")
    rounds = msg.count().bit_length()  # no path is longer than all messages; what still has an ancestor is a cycle
    while len(jumps) <= rounds and not jumps[-1].isEmpty():
        a, b = jumps[-1].alias("a"), done.unionByName(jumps[-1]).alias("b")
        step = scratch.put(a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.up") == F.col("b.node"))).select(
            "a.t", "a.node", F.col("b.up").alias("up"), (F.col("a.depth") + F.col("b.depth")).alias("depth"),
            (F.col("a.score") + F.col("b.score")).alias("score")), "jump")
        jumps.append(step.where("up is not null"))
        done = done.unionByName(step.where("up is null"))
    parents = jumps[0].select("t", F.col("up").alias("node")).distinct()
    best = [(F.col("score") / F.col("depth")).desc(), F.col("depth").desc(), F.col("node")]
    leaves = done.join(parents, ["t", "node"], "left_anti").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(32)))
    for keys in (["t", "salt"], ["t"]):  # a tree with very many leaves is first ranked in parts
        leaves = leaves.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(
            F.col("rank") <= branches)
    path = scratch.put(leaves.select("t", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("d")), "leaves")
    for i in range(len(jumps) - 1, -1, -1):
        up = path.join(jumps[i].select("t", "node", "up"), ["t", "node"]).select(
            "t", "leaf", "rank", F.col("up").alias("node"), (F.col("d") + (1 << i)).alias("d"))
        path = scratch.put(path.unionByName(up), "path")
    rows = path.join(msg, ["t", "node"]).withColumn("role1", escape_role(F.col("role"))).withColumn("text1", escape(F.col("text")))
    rows = rows.withColumn("piece", F.concat(F.lit(START), "role1", F.lit("\n"), "text1", F.lit(END)))
    w = Window.partitionBy("t", "leaf").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(w), F.lit(0)) + len(START) + 1 + F.length("role1"))
    turn = F.struct((-F.col("d")).alias("o"), "piece", F.when(F.col("role") == "assistant", F.struct(
        F.col("at").cast("int").alias("start"), F.length("text1").alias("length"))).alias("loss"))
    out = rows.groupBy("t", "leaf", "rank").agg(F.first("tree").alias("tree"), F.sort_array(F.collect_list(turn)).alias("p"))
    return out.select("tree", "leaf", "rank", F.size("p").cast("long").alias("n_turns"),
                      F.concat_ws("", F.transform("p", lambda x: x.piece)).alias("formatted"),
                      F.filter(F.transform("p", lambda x: x.loss), lambda x: x.isNotNull()).alias("loss"))


def parsed(c: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(c, _quote(END[:-1]) + "\n"), lambda x: x != "")

    def turn(x):
        body = F.substr(x, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(pieces, turn)


def loss_text(c: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(loss, lambda s: unescape(F.substr(c, s.start + 1, s.length))))
