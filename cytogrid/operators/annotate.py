"""Labels for cells: lookups with defaults, joins that must be total, cluster names, majority votes and derived keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_default(cells: DataFrame, labels: DataFrame, on: list[str], label: str, default: str, name: str | None = None) -> DataFrame:
    """Left join of one label column; cells without one get ``default``, of several the least is taken."""
    name = name or label
    lab = labels.groupBy(*on).agg(F.min(label).alias("__label"))
    return cells.join(lab, on, "left").withColumn(name, F.coalesce(F.col("__label").cast("string"), F.lit(default))).drop("__label")


def coverage(cells: DataFrame, labels: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """Per group: n cells and n_uncovered, those without a label row."""
    met = cells.join(labels.select(*on).distinct().withColumn("__hit", F.lit(1)), on, "left")
    return met.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("__hit").isNull()).alias("n_uncovered"))


def total_join(cells: DataFrame, labels: DataFrame, on: list[str], label: str) -> DataFrame:
    """Left join that must cover every cell; raises with the number that it does not. Of several labels the least is taken."""
    bad = coverage(cells, labels, on, []).first()
    if bad and bad["n_uncovered"]:
        raise ValueError(f"{bad['n_uncovered']} of {bad['n']} cells have no {label}")
    return cells.join(labels.groupBy(*on).agg(F.min(label).alias(label)), on)


def cluster_names(matrix: DataFrame, key: str = "cluster") -> DataFrame:
    """The wide annotation matrix (cluster x "<sample>_<resolution>") as rows (cluster, column, cell_type), blanks left out."""
    cols = [c for c in matrix.columns if c != key]
    long = matrix.unpivot([F.col(key).cast("string").alias(key)], [F.col(f"`{c}`").cast("string").alias(c) for c in cols], "column", "cell_type")
    return long.where(F.trim("cell_type") != "")


def map_clusters(cells: DataFrame, names: DataFrame, cluster: str, column: Column, default: str = "Unannotated") -> DataFrame:
    """cell_type of each cell by its cluster and annotation column; ``names`` is a short table."""
    n = names.select(F.col("cluster").alias("__c"), F.col("column").alias("__k"), F.col("cell_type").alias("__t"))
    met = cells.join(F.broadcast(n), (F.col(cluster).cast("string") == F.col("__c")) & (column == F.col("__k")), "left")
    return met.withColumn("cell_type", F.coalesce("__t", F.lit(default))).drop("__c", "__k", "__t")


def majority_vote(labelled: DataFrame, group: str, label: str) -> DataFrame:
    """Per group: the most frequent label (ties: the smaller), and purity, its share."""
    n = labelled.groupBy(group, label).agg(F.count("*").alias("n"))
    best = Window.partitionBy(group).orderBy(F.desc("n"), label)
    n = n.withColumn("r", F.row_number().over(best)).withColumn("all", F.sum("n").over(Window.partitionBy(group)))
    return n.where("r = 1").select(group, F.col(label).alias("winner"), (F.col("n") / F.col("all")).alias("purity"))


def resolution_key(resolution: Column) -> Column:
    return F.concat(F.lit("leiden_"), F.replace(resolution.cast("string"), F.lit("."), F.lit("_")))


def composite(*parts: Column) -> Column:
    return F.concat_ws(" | ", *parts)


def highlight(label: Column, one: str, other: str = "Other") -> Column:
    return F.when(label == one, label).otherwise(other)


def stamp(cells: DataFrame, sheet: DataFrame) -> DataFrame:
    """Each cell with its sample's sheet columns, as text; the sheet has a row per sample."""
    design = [c for c in sheet.columns if c != "sample"]
    return cells.join(F.broadcast(sheet.select("sample", *[F.col(c).cast("string").alias(c) for c in design])), "sample", "left")


def big_enough(cells: DataFrame, label: str, least: int, skip: tuple[str, ...] = ("Unannotated",)) -> DataFrame:
    """Cells whose label has at least ``least`` cells and says something."""
    ok = cells.where(~F.col(label).isin(*skip)).groupBy(label).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return cells.join(ok.select(label), label, "left_semi")


def usable_labels(cells: DataFrame, label: str, skip: tuple[str, ...] = ("Unannotated", "", "nan", "NA", "None")) -> DataFrame:
    """One row: n_labels, distinct labels that say something, and whether there are any, or more than one."""
    n = F.count_distinct(F.when(~F.col(label).isin(*skip), F.col(label)))
    return cells.agg(n.alias("n_labels")).withColumn("has_real", F.col("n_labels") > 0).withColumn("has_several", F.col("n_labels") > 1)


def concat_inner(counts: DataFrame) -> DataFrame:
    """Counts of all samples over the genes that every sample has, ids made unique as "<cell>-<sample>"."""
    n = counts.select("sample").distinct().agg(F.count("*").alias("all"))
    shared = counts.select("sample", "gene").distinct().groupBy("gene").agg(F.count("*").alias("n")).join(F.broadcast(n)).where(F.col("n") == F.col("all")).select("gene")
    return counts.join(shared, "gene", "left_semi").withColumn("cell_id", F.concat_ws("-", "cell_id", "sample"))


def shared_genes(query: DataFrame, reference: DataFrame, least: int = 100) -> DataFrame:
    """Genes of both; raises where there are fewer than ``least``."""
    both = query.select("gene").intersect(reference.select("gene"))
    n = both.count()
    if n < least:
        raise ValueError(f"{n} shared genes; at least {least} are needed")
    return both
