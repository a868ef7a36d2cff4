"""Pseudobulk: counts summed by sample and grouping, gates, size factors and quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Group labels that are no group (fixed values of the data format).
NO_REGION = ("Unlabeled", "Bubble")


def regions_only(cells: DataFrame, region: str = "region_annotation", skip: tuple[str, ...] = NO_REGION) -> DataFrame:
    return cells.where(F.col(region).isNotNull() & ~F.col(region).isin(*skip, "nan", ""))


def aggregate(counts: DataFrame, cells: DataFrame, by: list[str], min_cells: int = 10, min_counts: int = 1000) -> DataFrame:
    """(by..., gene, count, psbulk_n_cells, psbulk_counts) of the pseudobulks that pass both limits (inclusive)."""
    group = cells.select("sample", "cell_id", *[c for c in by if c != "sample"])
    n = group.groupBy(*by).agg(F.count("*").alias("psbulk_n_cells"))
    summed = counts.join(group, ["sample", "cell_id"]).groupBy(*by, "gene").agg(F.sum("count").alias("count"))
    total = summed.groupBy(*by).agg(F.sum("count").alias("psbulk_counts"))
    kept = n.join(total, by).where((F.col("psbulk_n_cells") >= min_cells) & (F.col("psbulk_counts") >= min_counts))
    return summed.join(kept, by)


def aggregate_by_type(counts: DataFrame, cells: DataFrame, type_col: str, by: list[str], min_cells: int = 10, min_counts: int = 1000, min_groups: int = 4) -> DataFrame:
    """The same within each cell type; a type with fewer than ``min_cells`` cells or ``min_groups`` pseudobulks is left out."""
    enough = cells.groupBy(type_col).agg(F.count("*").alias("n")).where(F.col("n") >= min_cells)
    out = aggregate(counts, cells.join(enough.select(type_col), type_col, "left_semi"), [type_col, *by], min_cells, min_counts)
    several = out.select(type_col, *by).distinct().groupBy(type_col).agg(F.count("*").alias("n")).where(F.col("n") >= min_groups)
    return out.join(several.select(type_col), type_col, "left_semi")


def manifest(bulks: DataFrame, grouping: list[str], condition: str) -> DataFrame:
    """One row: grouping, condition column, number of pseudobulks and genes."""
    return bulks.agg(F.count_distinct(*grouping).alias("n_samples"), F.count_distinct("gene").alias("n_genes")).select(F.lit("+".join(grouping)).alias("grouping"), F.lit(condition).alias("condition_col"), "n_samples", "n_genes")


def replicate_gate(bulks: DataFrame, bulk: list[str], condition: str, least: int) -> DataFrame:
    """Rows of the conditions with at least ``least`` pseudobulks, if there are two such conditions; otherwise none."""
    n = bulks.select(*bulk, condition).distinct().groupBy(condition).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    enough = n.agg(F.count("*").alias("levels"))
    return bulks.join(n.join(enough).where("levels >= 2").select(condition), condition, "left_semi")


def expressed(bulks: DataFrame) -> DataFrame:
    """Without genes whose counts are all zero."""
    return bulks.join(bulks.groupBy("gene").agg(F.sum("count").alias("t")).where("t > 0").select("gene"), "gene", "left_semi")


def completed(bulks: DataFrame, bulk: list[str], gene: str = "gene", count: str = "count") -> DataFrame:
    """``bulk`` columns, gene and count of every gene in every pseudobulk: 0 where it was not counted."""
    every = bulks.select(*bulk).distinct().crossJoin(bulks.select(gene).distinct())
    return every.join(bulks.select(*bulk, gene, count), [*bulk, gene], "left").withColumn(count, F.coalesce(count, F.lit(0).cast("long")))


def size_factors(bulks: DataFrame, bulk: str) -> DataFrame:
    """Median of ratios: exp(median over genes of ln count - mean ln count), over genes counted in every pseudobulk."""
    n = bulks.agg(F.count_distinct(bulk).alias("all"))
    pos = bulks.where("count > 0").withColumn("lc", F.log("count"))
    full = pos.groupBy("gene").agg(F.count("*").alias("n"), F.avg("lc").alias("m")).join(F.broadcast(n)).where(F.col("n") == F.col("all"))
    return pos.join(full.select("gene", "m"), "gene").groupBy(bulk).agg(F.exp(F.percentile(F.col("lc") - F.col("m"), 0.5)).alias("size_factor"))


def log_normalised(bulks: DataFrame, factors: DataFrame, bulk: str) -> DataFrame:
    """``bulks`` with norm = count / size factor and value = log2(norm + 1)."""
    return bulks.join(F.broadcast(factors), bulk).withColumn("norm", F.col("count") / F.col("size_factor")).withColumn("value", F.log2(F.col("norm") + 1))


def gene_zscores(values: DataFrame, bulk: str, value: str = "value") -> DataFrame:
    """Per gene the z-score (sample SD) over pseudobulks; genes without spread or with non-finite values are left out."""
    w = Window.partitionBy("gene")
    z = values.withColumn("sd", F.stddev_samp(value).over(w)).withColumn("m", F.avg(value).over(w))
    return z.where((F.col("sd") > 0) & (F.abs(F.col(value)) < float("inf"))).select("gene", bulk, ((F.col(value) - F.col("m")) / F.col("sd")).alias("z"))
