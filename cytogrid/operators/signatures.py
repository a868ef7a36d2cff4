"""Gene queries and signatures: entries, presence, recovery-curve scores and expression ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entries(wide: DataFrame) -> DataFrame:
    """A ragged table of gene lists (a column per entry) as rows (entry, gene), blanks dropped, text trimmed."""
    long = wide.unpivot([], [F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns], "entry", "gene")
    return long.select("entry", F.trim("gene").alias("gene")).where(F.col("gene") != "")


def kinds(lists: DataFrame) -> DataFrame:
    """(entry, kind, n): an entry that lists just itself is a gene, others are signatures."""
    alone = (F.count("*") == 1) & (F.first("gene") == F.first("entry"))
    return lists.groupBy("entry").agg(F.when(alone, "gene").otherwise("signature").alias("kind"), F.count("*").alias("n"))


def present(lists: DataFrame, genes: DataFrame) -> DataFrame:
    """The entries' genes that the data has; entries with none vanish."""
    return lists.join(genes.select("gene").distinct(), "gene", "left_semi")


def aucell(values: DataFrame, network: DataFrame, n_genes: int, share: float = 0.05) -> DataFrame:
    """Recovery score per (cell, signature): area under the curve of signature genes within the top ``n_up`` of a cell, of the largest possible.

    Only expressed genes are ranked (value, then name); a cell's unexpressed genes rank below and add nothing within the top.
    """
    n_up = max(1, int(n_genes * share))
    best = Window.partitionBy("sample", "cell_id").orderBy(F.desc("value"), "gene")
    ranked = values.where("value > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") < n_up)
    size = F.least(F.count("*"), F.lit(n_up - 1))
    most = network.groupBy("source").agg((size * n_up - size * (size + 1) / 2).alias("most"))
    hits = ranked.join(F.broadcast(network.select("source", F.col("target").alias("gene"))), "gene")
    area = hits.groupBy("sample", "cell_id", "source").agg(F.sum(n_up - F.col("rank")).alias("area"))
    return area.join(F.broadcast(most), "source").select("sample", "cell_id", "source", (F.col("area") / F.col("most")).alias("score"))


def expression_ranges(values: DataFrame, n_cells: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Per gene the percentiles (linear) over all cells: one zero row per gene stands for its unexpressed cells."""
    x = values.where("value > 0").groupBy("gene", "value").agg(F.count("*").alias("f"))
    nz = x.groupBy("gene").agg(F.sum("f").alias("nz")).join(n_cells)
    zero = nz.select("gene", F.lit(0.0).alias("value"), (F.col("n_cells") - F.col("nz")).alias("f")).where("f > 0")
    p = x.unionByName(zero).groupBy("gene").agg(F.percentile("value", [low, high], F.col("f")).alias("p"))
    return p.select("gene", F.get("p", F.lit(0)).alias("vmin"), F.get("p", F.lit(1)).alias("vmax"))


def clipped(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(value, high))
