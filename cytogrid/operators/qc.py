"""Quality control: per-cell and per-gene metrics, ranges, threshold sweeps and the ordered filter chain.

Counts are long (zeros implicit). Metrics are one aggregate each; the filter chain is a sequence of aggregates and semi-joins whose
order matters, since each step counts only what the earlier ones left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ("sample", "cell_id")


def has_prefix(gene: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | gene.startswith(p)
    return out


def cell_metrics(counts: DataFrame, mito: tuple[str, ...] = ("MT-", "mt-"), hb: str = "^HB[^P]") -> DataFrame:
    """Per cell: total_counts, n_genes_by_counts, total_counts_mt, total_counts_hb, pct_counts_mt, pct_counts_hb."""
    n, gene = F.col("count"), F.col("gene")
    out = counts.groupBy(*CELL).agg(
        F.sum(n).alias("total_counts"),
        F.count_if(n > 0).alias("n_genes_by_counts"),
        F.sum(F.when(has_prefix(gene, mito), n).otherwise(0)).alias("total_counts_mt"),
        F.sum(F.when(gene.rlike(hb), n).otherwise(0)).alias("total_counts_hb"),
    )
    pct = lambda c: F.coalesce(F.try_divide(100.0 * F.col(c), F.col("total_counts")), F.lit(0.0))
    return out.withColumn("pct_counts_mt", pct("total_counts_mt")).withColumn("pct_counts_hb", pct("total_counts_hb"))


def pct_in_top(counts: DataFrame, tops: tuple[int, ...]) -> DataFrame:
    """Per cell: percent of its counts in its ``k`` most-counted genes, a column pct_top_<k> for each k."""
    best = Window.partitionBy(*CELL).orderBy(F.desc("count"), "gene")
    r = counts.withColumn("r", F.row_number().over(best))
    part = lambda k: F.try_divide(100.0 * F.sum(F.when(F.col("r") <= k, F.col("count"))), F.sum("count"))
    return r.groupBy(*CELL).agg(*[part(k).alias(f"pct_top_{k}") for k in tops])


def gene_metrics(counts: DataFrame, n_cells: DataFrame) -> DataFrame:
    """Per gene: n_cells_by_counts, total_counts, and the mean over all cells; ``n_cells``: one row, column n_cells."""
    g = counts.groupBy("gene").agg(F.count_if(F.col("count") > 0).alias("n_cells_by_counts"), F.sum("count").alias("total_counts"))
    return g.join(n_cells).withColumn("mean_counts", F.col("total_counts") / F.col("n_cells")).drop("n_cells")


def ranges(metrics: DataFrame, names: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """Long table (by..., metric, minimum, median, maximum); exact median."""
    long = metrics.unpivot([*by], [F.col(n).cast("double").alias(n) for n in names], "metric", "value")
    return long.groupBy(*by, "metric").agg(F.min("value").alias("minimum"), F.percentile("value", 0.5).alias("median"), F.max("value").alias("maximum"))


def report(metrics: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """QC report rows (sample, metric, value as text); rows of several samples can be put together."""
    r = ranges(metrics, names, ("sample",))
    text = lambda c: F.coalesce(F.round(c, 3).cast("string"), F.lit("NA"))
    cols = [text(F.col(c)).alias(c) for c in ("minimum", "median", "maximum")]
    long = r.select("sample", "metric", *cols).unpivot(["sample", "metric"], ["minimum", "median", "maximum"], "stat", "value")
    return long.select("sample", F.concat_ws("_", "metric", "stat").alias("metric"), "value")


def removes(direction: Column, value: Column, threshold: Column) -> Column:
    """Whether a threshold takes a value out: strictly below, or strictly above it."""
    return F.when(direction == "below", value < threshold).otherwise(value > threshold)


def sweep(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per threshold (feature, direction, threshold): ranges of the feature and what it would remove. ``thresholds`` is a short list."""
    names = [r["feature"] for r in thresholds.select("feature").distinct().collect()]  # a short list of features
    long = metrics.unpivot([*CELL], [F.col(n).cast("double").alias(n) for n in names], "feature", "value")
    met = long.join(F.broadcast(thresholds), "feature")
    gone = removes(F.col("direction"), F.col("value"), F.col("threshold"))
    out = met.groupBy("feature", "direction", "threshold").agg(
        F.min("value").alias("feature_min"),
        F.percentile("value", 0.5).alias("feature_p50"),
        F.max("value").alias("feature_max"),
        F.round(100 * F.avg((F.col("value") < F.col("threshold")).cast("int")), 3).alias("threshold_percentile"),
        F.count_if(gone).alias("n_removed"),
        F.round(100 * F.avg(gone.cast("int")), 3).alias("pct_removed"),
        F.count_if(~gone).alias("n_retained"),
    )
    return out.withColumns({c: F.round(c, 3) for c in ("feature_min", "feature_p50", "feature_max")})


def sweep_by_type(metrics: DataFrame, thresholds: DataFrame, types: DataFrame, type_col: str) -> DataFrame:
    """Removed cells per threshold and cell type, types without any left out."""
    names = [r["feature"] for r in thresholds.select("feature").distinct().collect()]  # a short list of features
    long = metrics.join(types.select(*CELL, type_col), [*CELL]).unpivot([*CELL, type_col], [F.col(n).cast("double").alias(n) for n in names], "feature", "value")
    met = long.join(F.broadcast(thresholds), "feature").where(removes(F.col("direction"), F.col("value"), F.col("threshold")))
    return met.groupBy("feature", "direction", "threshold", type_col).agg(F.count("*").alias("n_removed"))


def effective_thresholds(samples: DataFrame, overrides: DataFrame, defaults: dict[str, float | None]) -> DataFrame:
    """Per sample each threshold of ``defaults``, a text override (blank or missing: the default) first."""
    met = samples.select("sample").distinct().join(F.broadcast(overrides), "sample", "left")
    value = lambda k: F.coalesce(F.expr(f"try_cast(nullif(trim(`{k}`), '') AS DOUBLE)"), F.lit(defaults[k]).cast("double"))
    return met.select("sample", *[(value(k) if k in overrides.columns else F.lit(v).cast("double")).alias(k) for k, v in defaults.items()])


def filter_chain(counts: DataFrame, thresholds: DataFrame, mito: tuple[str, ...]) -> DataFrame:
    """The counts that survive, in this order: cells by total (min, then max), genes by cells, cells by genes left, cells by percent mito.

    ``thresholds``: per sample min_counts, max_counts, min_cells, min_genes, max_pct_mt (null: no limit). The percent mito is that of the
    unfiltered counts. Steps after the gene filter count what it left, so they cannot move before it.
    """
    t = F.broadcast(thresholds)
    no = lambda c: F.col(c).isNull()
    m = cell_metrics(counts, mito).join(t, "sample")
    m = m.where((no("min_counts") | (F.col("total_counts") >= F.col("min_counts"))) & (no("max_counts") | (F.col("total_counts") <= F.col("max_counts"))))
    kept = counts.join(m.select(*CELL, "pct_counts_mt"), [*CELL])
    genes = kept.where("count > 0").groupBy("sample", "gene").agg(F.count("*").alias("n")).join(t, "sample").where(no("min_cells") | (F.col("n") >= F.col("min_cells")))
    kept = kept.join(genes.select("sample", "gene"), ["sample", "gene"], "left_semi")
    left = kept.groupBy(*CELL).agg(F.count_if(F.col("count") > 0).alias("n"), F.first("pct_counts_mt").alias("pct")).join(t, "sample")
    left = left.where((no("min_genes") | (F.col("n") >= F.col("min_genes"))) & (no("max_pct_mt") | (F.col("pct") <= F.col("max_pct_mt"))))
    return kept.join(left.select(*CELL), [*CELL], "left_semi").select(*CELL, "gene", "count")


def annotated_only(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Instead of QC: counts of the annotated cells, and of them genes with any count. ``labels``: sample, cell_id."""
    kept = counts.join(labels.select(*CELL).distinct(), [*CELL], "left_semi")
    return kept.where("count > 0")
