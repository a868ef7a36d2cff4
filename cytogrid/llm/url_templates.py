"""URL filter: listed rules first, then a path-template tree judged by smoothed labelled purity.

Rules name a host and a path prefix; the longest that fits decides. The URLs that rules decide are the labels. For the rest, each host's
paths form a tree: segments that vary (numbers, hexadecimal ids) become wildcards, sibling branches whose labelled block rates do not
differ significantly are merged into one wildcard branch (among a node's many rare values, only those with ENOUGH labels can differ), and the templates so found are
blocked if their block rate, shrunk towards the host's and that towards the overall rate, reaches the limit.

Scale: only the url column is read; URLs are first reduced to (host, generalised path) with counts, so the tree is built on a
table of shapes by partial aggregates, level by level, until no node has two shapes; a host with most pages is a few rows. The template verdict joins back by key.

Defined cases: a null url, or one without "://", has empty host and path and gets the verdict of that (empty) host's root
template; repeated rows are judged alike and count each; of equally long rules the first listed decides; a url counts as a whole, however long and deep; an
empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import col, materialize

#: (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: A node with more different segments than this, met fewer than RARE times each on average, is variable there.
MOST_CHILDREN, RARE = 20, 3.0
#: Labels that a branch of such a node needs to stand by itself.
ENOUGH = 10
#: Two-sided 5 % limit for a branch against its siblings.
SIMILAR_Z = 1.96
#: Pseudo-counts of the parent's rate, and the block rate that rejects a template.
PRIOR, REJECT = 4.0, 0.8


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, as "host/path"; null where none does. Of equally long ones the first listed."""
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def shape_of(path: Column) -> Column:
    """Path segments with numbers and long hexadecimal ids generalised."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(s, r"[0-9a-fA-F]*[0-9][0-9a-fA-F]{7,}", "{x}"), r"[0-9]+", "{n}"))


def template_tree(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, shape, n, labelled, blocked) with each shape's ``template``."""
    own, node = ["host", "shape", "n", "labelled", "blocked"], ["host", "template"]
    t = materialize(shapes.select(*own, F.lit("").alias("template")))
    done, t, level = t.where(F.size("shape") == 0), t.where(F.size("shape") > 0), 0
    while not t.isEmpty():
        t = t.withColumn("seg", F.get("shape", F.lit(level)))
        kids = t.groupBy(*node, "seg").agg(F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.count("*").alias("shapes"))
        whole = kids.groupBy(*node).agg(F.count("*").alias("kids"), F.sum("n").alias("all_n"), F.sum("l").alias("all_l"), F.sum("b").alias("all_b"), F.sum("shapes").alias("all_shapes"))
        k = kids.join(whole, node)
        k = k.withColumn("rest_l", F.col("all_l") - F.col("l")).withColumn("rest_b", F.col("all_b") - F.col("b"))
        variable = (F.col("kids") > MOST_CHILDREN) & (F.col("all_n") < RARE * F.col("kids"))
        rate = F.try_divide("all_b", "all_l")
        gap = F.try_divide("b", "l") - F.try_divide("rest_b", "rest_l")
        spread = rate * (1 - rate) * (F.try_divide(F.lit(1), "l") + F.try_divide(F.lit(1), "rest_l"))
        differs = F.coalesce(gap * gap > SIMILAR_Z**2 * spread, F.lit(False)) & (~variable | (F.col("l") >= ENOUGH))
        stays = (F.col("kids") == 1) | differs
        decided = k.select(*node, "seg", F.when(stays, F.col("seg")).otherwise("*").alias("part"), (F.col("all_shapes") == 1).alias("alone"))
        # a shape alone at its node has no branches left to compare with
        rest = F.array_join(F.slice("shape", level + 1, F.size("shape")), "/")
        template = F.concat("template", F.lit("/"), F.when(F.col("alone"), rest).otherwise(F.col("part")))
        t = materialize(t.join(decided, [*node, "seg"]).select(*own, template.alias("template"), (F.col("alone") | (F.size("shape") <= level + 1)).alias("ended")))
        done, t, level = done.unionByName(t.where("ended").drop("ended")), t.where("not ended").drop("ended"), level + 1
    return done


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Per row: id, host, path, rule, verdict, template, purity (the template's shrunk block rate)."""
    rows = pages.select(col(id_col).alias("id"), host_of(col(url_col)).alias("host"), path_of(col(url_col)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", "host", "path", rule.alias("rule"), verdict.alias("listed"), shape_of(F.col("path")).alias("shape"))
    shapes = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("listed").alias("labelled"), F.count_if(F.col("listed") == "block").alias("blocked"))
    tree = materialize(template_tree(shapes))
    sums = [F.sum("labelled").alias("l"), F.sum("blocked").alias("b")]
    overall = tree.agg(*sums).select(F.coalesce(F.try_divide("b", "l"), F.lit(0.0)).alias("rate"))
    # one row of one number
    hosts = tree.groupBy("host").agg(*sums).crossJoin(F.broadcast(overall)).select("host", ((F.col("b") + PRIOR * F.col("rate")) / (F.col("l") + PRIOR)).alias("host_rate"))
    made = tree.groupBy("host", "template").agg(*sums).join(hosts, "host").select("host", "template", ((F.col("b") + PRIOR * F.col("host_rate")) / (F.col("l") + PRIOR)).alias("purity"))
    # a table of its own, so that both sides of the join are plain shuffles, of which a very common shape's can be split
    verdicts = materialize(tree.select("host", "shape", "template").join(made, ["host", "template"]))
    out = rows.join(verdicts, ["host", "shape"])
    judged = F.coalesce("listed", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", judged.alias("verdict"), "template", "purity")
