"""Marker statistics by group: rank sums, adjusted p-values, top markers, dot-plot statistics and contributions.

Zeros are implicit: with non-negative values a gene's Z zero cells share the average rank (Z + 1) / 2 and every other cell's rank
is Z plus its rank among the non-zero cells, so cells x genes is never made.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cytogrid.operators.durable import settle


@F.pandas_udf(DoubleType())
def normal_two_sided(z: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """P(|N| > |z|); SQL has no erfc."""
    import math

    for s in z:
        yield s.map(lambda v: None if v is None or v != v else math.erfc(abs(v) / math.sqrt(2)))


def _group_sizes(cells: DataFrame, group: str, by: Sequence[str] = ()) -> DataFrame:
    n = cells.groupBy(*by, group).agg(F.count("*").alias("n_g"))
    n_all = n.groupBy(*by).agg(F.sum("n_g").alias("n_all"))
    return n.join(n_all, list(by)) if by else n.join(n_all)


def rank_sum(values: DataFrame, cells: DataFrame, group: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., group, gene, rank_sum, score, logfoldchange) of each group against the rest of its ``by``.

    ``values``: sample, cell_id, gene, value > 0 for the non-zero entries. The score is the rank-sum z without tie correction.
    A cell may have a row for each of several ``by``, as for several clusterings; all are ranked in one pass. ``by`` may not be null.
    """
    by = list(by)
    sizes = F.broadcast(_group_sizes(cells, group, by))  # a row per label
    x = values.where("value > 0").join(cells.select("sample", "cell_id", *by, group), ["sample", "cell_id"])
    # ties by counting equal values, so a frequent value is one row, which knows its groups; the entries are read once and not joined with their ranks
    counted = x.groupBy(*by, "gene", "value", F.col(group).alias("__g")).agg(F.count("*").alias("n"))
    per_value = counted.groupBy(*by, "gene", "value").agg(F.sum("n").alias("same"), F.collect_list(F.struct("__g", "n")).alias("groups"))
    below = Window.partitionBy(*by, "gene").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_value.withColumn("rank", F.coalesce(F.sum("same").over(below), F.lit(0)) + (F.col("same") + 1) / 2).select(*by, "gene", "value", "rank", F.explode("groups").alias("o"))
    of = ranks.select(*by, "gene", "value", "rank", F.col("o.__g").alias(group), F.col("o.n").alias("n"))
    per_group = settle(of.groupBy(*by, "gene", group).agg(F.sum(F.col("rank") * F.col("n")).alias("r"), F.sum("n").alias("nz"), F.sum(F.expm1("value") * F.col("n")).alias("e")))
    of_gene = per_group.groupBy(*by, "gene").agg(F.sum("nz").alias("nz_all"), F.sum("e").alias("e_all"))
    full = (of_gene.join(sizes, by) if by else of_gene.join(sizes)).join(per_group, [*by, "gene", group], "left").na.fill(0, ["r", "nz", "e"])
    zeros = F.col("n_all") - F.col("nz_all")
    r = F.col("r") + F.col("nz") * zeros + (F.col("n_g") - F.col("nz")) * (zeros + 1) / 2
    n, m = F.col("n_g").cast("double"), F.col("n_all").cast("double")
    score = F.try_divide(r - n * (m + 1) / 2, F.sqrt(n * (m - n) * (m + 1) / 12))
    mean, rest = F.col("e") / n, F.try_divide(F.col("e_all") - F.col("e"), m - n)
    return full.select(*by, group, "gene", r.alias("rank_sum"), score.alias("score"), F.log2((mean + 1e-9) / (F.coalesce(rest, F.lit(0.0)) + 1e-9)).alias("logfoldchange"))


def adjust(df: DataFrame, p: str, by: list[str], name: str = "padj") -> DataFrame:
    """Benjamini-Hochberg within ``by``; null p-values stay null and are not counted."""
    part = Window.partitionBy(*by)
    n, rank = F.count(p).over(part), F.row_number().over(part.orderBy(F.col(p).asc_nulls_last()))
    raw = df.withColumn("__q", F.when(F.col(p).isNotNull(), F.col(p) * n / rank))
    after = part.orderBy(F.col(p).desc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return raw.withColumn(name, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("__q").over(after)))).drop("__q")


def top_markers(scores: DataFrame, group: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` best genes of each group, with rank."""
    best = Window.partitionBy(*by, group).orderBy(F.round("score", 9).desc_nulls_last(), "gene")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def first_appearance(top: DataFrame, group: str) -> DataFrame:
    """Genes of a top list once each, in order of (group, rank) of their first appearance."""
    first = top.groupBy("gene").agg(F.min(F.struct(group, "rank")).alias("f"))
    return first.select("gene", F.row_number().over(Window.orderBy("f")).alias("place"))


def dot_stats(values: DataFrame, cells: DataFrame, group: Column, name: str = "grp", by: Sequence[str] = ()) -> DataFrame:
    """Per (by..., gene, group): mean over all cells of the group, fraction of cells above 0, and the mean scaled per gene to 0..1."""
    by = list(by)
    g = cells.select("sample", "cell_id", *by, group.alias(name))
    n = g.groupBy(*by, name).agg(F.count("*").alias("n"))
    # sums are few and stored, so the genes come from them and the values are computed once; a gene of no labelled cell is known by the rows that met none
    sums = [F.sum("value").alias("s"), F.count_if(F.col("value") > 0).alias("k")]
    x = settle(values.join(g.withColumn("__met", F.lit(True)), ["sample", "cell_id"], "left").groupBy(*by, "gene", name, "__met").agg(*sums))
    full = x.select("gene").distinct().join(F.broadcast(n)).join(x.where("__met").drop("__met"), [*by, "gene", name], "left").na.fill(0, ["s", "k"])
    out = full.select(*by, "gene", name, (F.col("s") / F.col("n")).alias("mean"), (F.col("k") / F.col("n")).alias("fraction"))
    w = Window.partitionBy(*by, "gene")
    lo, hi = F.min("mean").over(w), F.max("mean").over(w)
    return out.withColumn("scaled", F.coalesce(F.try_divide(F.col("mean") - lo, hi - lo), F.lit(0.0)))


def contributions(values: DataFrame, cells: DataFrame, a: str, b: str) -> DataFrame:
    """Sums and positive cells per gene by sample, sample x a and sample x b in one pass (grouping sets)."""
    x = values.join(cells.select("sample", "cell_id", a, b), ["sample", "cell_id"])
    return x.groupingSets([["gene", "sample"], ["gene", "sample", a], ["gene", "sample", b]], "gene", "sample", a, b).agg(F.sum("value").alias("sum_value"), F.count_if(F.col("value") > 0).alias("n_positive"))
