"""What is told of the clusterings of a part of the cells: how well they hold, their metrics, composition and sizes.

``by`` names the columns that tell clusterings apart (compartment, branch, resolution); all of them are worked on in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.operators import compose, embed, qc, report
from cytogrid.operators.durable import settle

#: Metrics told of clusters.
METRICS = ("n_genes_by_counts", "total_counts", "pct_top_50", "pct_top_100", "pct_counts_mt", "pct_counts_hb")


def cell_qc(counts: DataFrame, mito: tuple[str, ...] = ("MT-", "mt-"), hb: str = "^HB[^P]") -> DataFrame:
    """METRICS of each cell, counted within ``counts`` alone."""
    return qc.cell_metrics(counts, mito, hb).join(qc.pct_in_top(counts, (50, 100)), list(qc.CELL)).select(*qc.CELL, *METRICS)


def silhouettes(pcs: DataFrame, clusters: DataFrame) -> DataFrame:
    """(id, resolution, cluster, silhouette) in standardised components, for all clusterings at once.

    ``pcs``: id, v; ``clusters``: id, resolution, cluster, each cell once a resolution. Resolutions that found one cluster are left out.
    """
    several = clusters.groupBy("resolution").agg(F.count_distinct("cluster").alias("k")).where("k > 1")
    steps = sorted(r["resolution"] for r in several.collect())  # a row per resolution
    if not steps:
        return clusters.where("false").select("id", "resolution", F.col("cluster").cast("string").alias("cluster"), F.lit(0.0).alias("silhouette"))
    named = F.array_sort(F.collect_list(F.struct("resolution", F.col("cluster").cast("string").alias("cluster"))))
    labels = clusters.where(F.col("resolution").isin(steps)).groupBy("id").agg(F.transform(named, lambda x: x["cluster"]).alias("labels"))
    got = embed.ladder_silhouettes(settle(embed.standardised(pcs.select("id", "v")).join(labels, "id")))
    return got.select("id", F.get(F.array(*[F.lit(r) for r in steps]), "res_idx").alias("resolution"), F.col("label").alias("cluster"), "silhouette")


def metric_distribution(cells: DataFrame, by: Sequence[str], cluster: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """(by..., cluster, metric, point, value): five points of each metric's distribution per cluster; cells without a value take no part."""
    long = cells.unpivot([*by, cluster], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value").where("value IS NOT NULL")
    return report.distribution(long, [*by, cluster, "metric"], "value")


def compositions(cells: DataFrame, by: Sequence[str], cluster: str, kinds: Sequence[str], always: Sequence[str] = ("sample",)) -> DataFrame:
    """(by..., cluster, kind, value, n, pct_of_cluster, pct_of_value): clusters by each of the label columns ``kinds``, both ways round.

    A kind with one value within its ``by`` says nothing and is left out, unless it is one of ``always``. Cells without a label take no part in its kind.
    """
    long = cells.unpivot([*by, cluster], [F.col(k).cast("string").alias(k) for k in kinds], "kind", "value").where("value IS NOT NULL")
    n = long.groupBy(*by, cluster, "kind", "value").agg(F.count("*").alias("n"))
    of = lambda *c: Window.partitionBy(*by, *c)
    pct = lambda *c: 100.0 * F.col("n") / F.sum("n").over(of(*c))
    told = n.withColumn("varied", F.min("value").over(of("kind")) < F.max("value").over(of("kind"))).where(F.col("varied") | F.col("kind").isin(*always)).drop("varied")
    return told.withColumn("pct_of_cluster", pct(cluster, "kind")).withColumn("pct_of_value", pct("kind", "value"))


def middle_counts(cells: DataFrame, by: Sequence[str], cluster: str, columns: Sequence[str]) -> DataFrame:
    """(by..., cluster, columns..., n_cells) of the middle clustering, the later of two; ``cells`` have res_idx, from 0."""
    middle = cells.groupBy(*by).agg(F.expr("(max(res_idx) + 1) div 2").cast("int").alias("res_idx"))
    return compose.cell_counts(cells.join(F.broadcast(middle), [*by, "res_idx"], "left_semi"), *by, cluster, *columns)
