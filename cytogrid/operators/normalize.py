"""Library-size normalisation and highly variable genes, on long counts with implicit zeros."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL = ("sample", "cell_id")


def log_normalise(counts: DataFrame, target: float | None = None) -> DataFrame:
    """``counts`` with value = ln(1 + count * target / cell total); without a target, the median total of the sample's cells."""
    # a cell's total goes along with its rows, so they are not joined with their own sums; rows without a cell have none
    total = F.when(F.col("sample").isNotNull() & F.col("cell_id").isNotNull(), F.sum("count").over(Window.partitionBy(*CELL)))
    of_cell = counts.withColumn("__total", total).where("__total > 0")
    if target is None:
        totals = counts.groupBy(*CELL).agg(F.sum("count").alias("total")).where("total > 0")
        median = totals.groupBy("sample").agg(F.percentile("total", 0.5).alias("__target"))
        of_cell = of_cell.join(F.broadcast(median), "sample")  # a row per sample
    else:
        of_cell = of_cell.withColumn("__target", F.lit(float(target)))
    return of_cell.select(*counts.columns, F.log1p(F.col("count") * F.col("__target") / F.col("__total")).alias("value"))


def highly_variable(values: DataFrame, n_cells: DataFrame, bins: int = 20, top: int = 2000) -> DataFrame:
    """Per gene: mean, dispersion, its z-score among genes of like mean, and rank; the ``top`` first. ``n_cells``: one row n_cells."""
    x = F.expm1("value")
    g = values.groupBy("gene").agg(F.sum(x).alias("s"), F.sum(x * x).alias("ss")).join(n_cells)
    mean = F.col("s") / F.col("n_cells")
    var = (F.col("ss") - F.col("s") * F.col("s") / F.col("n_cells")) / (F.col("n_cells") - 1)
    g = g.select("gene", F.when(mean == 0, 1e-12).otherwise(mean).alias("mean"), var.alias("var"))
    g = g.select("gene", "mean", F.log1p("mean").alias("lm"), F.log(F.when(F.col("var") > 0, F.col("var") / F.col("mean"))).alias("dispersion"))
    span = g.agg(F.min("lm").alias("lo"), F.max("lm").alias("hi"))
    at = F.least(F.floor(F.try_divide((F.col("lm") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    g = g.join(F.broadcast(span)).withColumn("bin", F.coalesce(at, F.lit(0)))
    b = g.groupBy("bin").agg(F.avg("dispersion").alias("m"), F.stddev_samp("dispersion").alias("sd"))
    g = g.join(F.broadcast(b), "bin").withColumn("norm", F.when(F.col("sd").isNull(), 1.0).otherwise(F.try_divide(F.col("dispersion") - F.col("m"), F.col("sd"))))
    # one row per gene of a panel
    ranked = g.withColumn("rank", F.row_number().over(Window.orderBy(F.round("norm", 9).desc_nulls_last(), "gene")))
    return ranked.where(F.col("rank") <= top).select("gene", "mean", "dispersion", "bin", "norm", "rank")
