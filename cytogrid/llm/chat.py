"""Chat formatting of reply trees: the best root-to-leaf paths, each written as one conversation.

A message knows its tree, its own node and its parent. Self-joins on the parent, each reaching twice as far as the last, give every
message its depth and the sum of scores along its path; these jump tables hold keys and numbers only. Leaves are ranked in their tree by
the mean score of their path (ties: lesser node), and the paths of the best ``top`` are enumerated by the same tables from the farthest
jump down, so a path of n messages takes log2 n joins. Texts join once, when the paths are known.

Template: ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline, for each message. In texts and roles a backslash is doubled, and every
control string is broken by ``\\-`` after its first character, so neither a marker of this template nor one of other common templates can
stand inside; a newline in a role becomes ``\\n``. ``unescape`` undoes all of this. ``loss`` has the code point spans of the assistants'
texts in ``formatted``.

Scale: joins are on (tree, node), which is unique on one side. A path is gathered in chunks of ``CHUNK`` messages, ordered within each, and
the chunks are then joined; a conversation is one row of the result and so is held whole, like a document, but nothing larger is. A tree
may hold a third of all rows: ranking keeps ``top`` leaves per task before it shuffles.

Defined cases: null texts and roles are empty; a null tree is a tree of its own; a parent that is null or missing makes a root; messages on
a cycle hang on no root and are on no path; of rows that share tree and node the one with the least (parent, score, role, text) counts,
since a node is one message; an empty table gives an empty result; further columns are ignored. For plain conversations (``linear``) every
row is a message, repeated rows too, in order of turn (null last), role and text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.llm.common import blank_if_null, col, materialize

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
#: What other templates use as markers; any <|...|> is covered by its beginning.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Messages gathered at a time, and turns numbered at a time.
CHUNK = 256
SCHEMA = "tree string, node string, parent string, score double, role string, text string"


def _pattern(strings: tuple[str, ...] = CONTROL) -> str:
    """The first character of a control string whose rest follows."""
    return "|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in strings)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_pattern()})", r"$1\\-")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    """The text or role that ``escape`` or ``escape_role`` was given."""
    return "\\".join(part.replace("\\-", "").replace("\\n", "\n") for part in text.split("\\\\"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each message of a formatted conversation."""
    turns = [t.removeprefix(OPEN).split("\n", 1) for t in formatted.split(CLOSE)[:-1]]
    return [(unescape(role), unescape(text)) for role, text in turns]


def _linear(rows: DataFrame, id_col: str, turn_col: str, *others: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with their tree and stretch of turns, and per stretch its number of rows and of those before it in the tree."""
    tree = F.coalesce(F.concat(F.lit("s"), col(id_col).cast("string")), F.lit("n"))
    r = rows.select(tree.alias("tree"), col(turn_col).cast("long").alias("turn"), *others).withColumn("stretch", F.floor(F.col("turn") / CHUNK))
    counts = r.groupBy("tree", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy(F.col("stretch").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return r, counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def linear(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations without parents as trees of one path: each row's parent is the row before it.

    Rows are numbered within stretches of turns, and a stretch begins where the counts of the earlier ones end, so no conversation is sorted in one task.
    """
    r, counts = _linear(rows, id_col, turn_col, col(role_col).cast("string").alias("role"), col(text_col).cast("string").alias("text"))
    order = Window.partitionBy("tree", "stretch").orderBy("turn", blank_if_null(F.col("role")), blank_if_null(F.col("text")))
    begin = counts.select(F.col("tree").alias("t"), F.col("stretch").alias("s"), "first")
    met = r.withColumn("nth", F.row_number().over(order)).join(begin, (F.col("tree") == F.col("t")) & F.col("stretch").eqNullSafe(F.col("s")))
    at = F.col("first") + F.col("nth") - 1
    return met.select("tree", at.cast("string").alias("node"), F.when(at > 0, (at - 1).cast("string")).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def linear_keys(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(tree, node, parent, score) of ``linear``, from the stretches' counts alone."""
    _, counts = _linear(rows, id_col, turn_col)
    at = counts.select("tree", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("at"))
    return at.select("tree", F.col("at").cast("string").alias("node"), F.when(F.col("at") > 0, (F.col("at") - 1).cast("string")).alias("parent"), F.lit(0.0).alias("score"))


def messages(rows: DataFrame, tree_col: str, node_col: str, parent_col: str, role_col: str, text_col: str, score: Column) -> DataFrame:
    """Rows of a reply tree as (tree, node, parent, score, role, text), one per node; keys begin with s, that of null is n."""
    text = lambda c: col(c).cast("string")
    key = lambda c: F.concat(F.lit("s"), text(c))
    m = rows.select(F.coalesce(key(tree_col), F.lit("n")).alias("tree"), F.coalesce(key(node_col), F.lit("n")).alias("node"), key(parent_col).alias("parent"), F.coalesce(score.cast("double"), F.lit(0.0)).alias("score"), text(role_col).alias("role"), text(text_col).alias("text"))
    rest = ["parent", "score", "role", "text"]
    return m.groupBy("tree", "node").agg(F.min(F.struct(*rest)).alias("m")).select("tree", "node", *[f"m.{c}" for c in rest])


def _jumps(keys: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the ancestors 1, 2, 4, ... above (tree, node, up), and per node under a root its depth and the sum of scores down to it."""
    parents = keys.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    hung = keys.join(parents, ["tree", "parent"], "left")
    now = materialize(hung.select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"), "score"))
    jumps, nodes = [], now.count()
    while (1 << len(jumps)) <= nodes:
        open_rows = now.where("up is not null")
        if open_rows.isEmpty():
            break
        jumps.append(open_rows.select("tree", "node", "up"))
        above = now.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("score").alias("plus"))
        met = open_rows.join(above, ["tree", "up"]).select("tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("score") + F.col("plus")).alias("score"))
        now = materialize(met.unionByName(now.where("up is null")))
    return jumps, now.where("up is null").select("tree", "node", "depth", "score")


def paths(keys: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, score, place, node): the messages on the best ``top`` root-to-leaf paths of each tree, the root at place 0.

    ``keys``: tree, node, parent, score. A path's score is the mean of its messages'.
    """
    jumps, placed = _jumps(keys)
    leaves = placed.join(keys.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    mean = F.col("score") / (F.col("depth") + 1)
    best = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "node"))
    chosen = leaves.select("tree", "node", "depth", mean.alias("score")).withColumn("rank", best).where(F.col("rank") <= top)
    met = materialize(chosen.select("tree", F.col("node").alias("leaf"), "rank", "score", F.col("depth").alias("place"), "node"))
    for k in range(len(jumps) - 1, -1, -1):
        up = met.join(jumps[k], ["tree", "node"]).select("tree", "leaf", "rank", "score", (F.col("place") - (1 << k)).alias("place"), F.col("up").alias("node"))
        met = materialize(met.unionByName(up))
    return met


def conversations(trees: DataFrame, keys: DataFrame | None = None, top: int = 1) -> DataFrame:
    """Per chosen path: tree, leaf, rank, score, n_turns, formatted, loss (array of start and end).

    ``trees`` as ``linear`` and ``messages`` give them; ``keys``, if given, are their keys and scores made without the texts.
    """
    keys = materialize((trees if keys is None else keys).select("tree", "node", "parent", "score"))
    on = paths(keys, top).join(trees.select("tree", "node", "role", "text"), ["tree", "node"])
    role, text = escape_role(blank_if_null(F.col("role"))), escape(blank_if_null(F.col("text")))
    path = ["tree", "leaf", "rank", "score"]
    t = on.select(*path, "place", (F.col("role") == ASSISTANT).alias("spoken"), F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"), text.alias("body"))
    t = t.withColumn("chunk", F.floor(F.col("place") / CHUNK)).withColumn("from", F.length("head")).withColumn("to", F.length("head") + F.length("body")).withColumn("size", F.col("to").cast("long") + len(CLOSE))
    within = F.sum("size").over(Window.partitionBy(*path, "chunk").orderBy("place")) - F.col("size")
    t = t.withColumn("before", within)
    turn = F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), F.when(F.col("spoken"), F.struct((F.col("before") + F.col("from")).alias("start"), (F.col("before") + F.col("to")).alias("end"))).alias("span"))
    chunks = t.groupBy(*path, "chunk").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.sum("size").alias("size"))
    chunks = chunks.select(*path, "chunk", "size", F.size("turns").alias("n"), F.array_join("turns.turn", "").alias("body"), F.filter("turns.span", lambda s: s.isNotNull()).alias("spans"))
    ahead = F.sum("size").over(Window.partitionBy(*path).orderBy("chunk")) - F.col("size")
    chunks = chunks.withColumn("ahead", ahead)
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("ahead")).alias("start"), (s["end"] + F.col("ahead")).alias("end")))
    whole = chunks.withColumn("spans", moved).groupBy(*path).agg(F.sort_array(F.collect_list(F.struct("chunk", "body", "spans"))).alias("c"), F.sum("n").alias("n_turns"))
    return whole.select(*path, "n_turns", F.array_join("c.body", "").alias("formatted"), F.flatten("c.spans").alias("loss"))
