"""Queries of contract, QC, normalisation, annotation and composition operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytogrid.operators import annotate, compose, contract, normalize, qc
from cytogrid.plans import views as V
from cytogrid.plans.registry import query

MITO, HB = ("hot-", "Hot-"), "^red-[^r]"
THRESHOLDS = [("total_counts", "below", 50.0), ("total_counts", "above", 150.0), ("n_genes_by_counts", "below", 3.0), ("pct_counts_mt", "above", 20.0)]
_THRESHOLDS_SQL = "(VALUES " + ", ".join(f"('{f}', '{d}', CAST({t} AS DOUBLE))" for f, d, t in THRESHOLDS) + ") AS t(feature, direction, threshold)"
_METRICS = """metrics AS (
  SELECT sample, cell_id, CAST(sum(count) AS BIGINT) AS total_counts, count(*) FILTER (WHERE count > 0) AS n_genes_by_counts,
    CAST(coalesce(sum(count) FILTER (WHERE gene LIKE 'hot-%' OR gene LIKE 'Hot-%'), 0) AS BIGINT) AS total_counts_mt,
    CAST(coalesce(sum(count) FILTER (WHERE regexp_matches(gene, '^red-[^r]')), 0) AS BIGINT) AS total_counts_hb,
    100.0 * coalesce(sum(count) FILTER (WHERE gene LIKE 'hot-%' OR gene LIKE 'Hot-%'), 0) / sum(count) AS pct_counts_mt,
    100.0 * coalesce(sum(count) FILTER (WHERE regexp_matches(gene, '^red-[^r]')), 0) / sum(count) AS pct_counts_hb
  FROM counts GROUP BY 1, 2)"""


def rounded(df: DataFrame, *cols: str, to: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, to) for c in cols})


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "feature string, direction string, threshold double")


def n_cells(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count("*").alias("n_cells"))


@query("""SELECT (SELECT count(*) FROM cells) AS cells, (SELECT count(*) - count(DISTINCT (sample, cell_id)) FROM cells) AS n_duplicate_ids,
 (SELECT count(*) FILTER (WHERE x IS NULL OR y IS NULL OR NOT isfinite(x) OR NOT isfinite(y)) FROM cells) AS n_bad_coordinates,
 (SELECT count(*) FILTER (WHERE sample IS NULL) FROM cells) AS n_no_sample, (SELECT count(DISTINCT gene) FROM counts) AS genes,
 (SELECT count(*) FILTER (WHERE count < 0 OR count IS NULL) FROM counts) AS n_negative, 0 AS n_not_finite, 0 AS n_not_integer,
 (SELECT count(*) - count(DISTINCT (sample, cell_id, gene)) FROM counts) AS n_duplicate_entries, true AS passed""")
def contract_checks(spark: SparkSession, d: str) -> DataFrame:
    return contract.hard_checks(V.counts(spark, d), V.cells(spark, d)).withColumn("passed", contract.passed())


@query("SELECT CASE WHEN count(*) FILTER (WHERE gene LIKE 'MT-%') = 0 THEN 'no_mito' ELSE '' END AS warnings FROM genes")
def contract_warnings(spark: SparkSession, d: str) -> DataFrame:
    return contract.soft_checks(V.cells(spark, d), V.genes(spark, d), ("MT-",)).select(F.array_join("warnings", ",").alias("warnings"))


@query("""WITH a AS (SELECT DISTINCT doc_id FROM labels WHERE quality IS NOT NULL AND quality = 1)
SELECT count(*) AS annotated, count(d.doc_id) AS matched, round(count(d.doc_id) / CAST(count(*) AS DOUBLE), 6) AS fraction FROM a LEFT JOIN (SELECT DISTINCT doc_id FROM documents) d USING (doc_id)""")
def label_overlap(spark: SparkSession, d: str) -> DataFrame:
    labels = V.table(spark, d, "labels").withColumn("label", F.when(F.col("quality") == 1, "good").otherwise("NaN"))
    return contract.label_overlap(V.table(spark, d, "documents"), labels, "doc_id", "label")


@query(f"WITH {_METRICS} SELECT sample, cell_id, total_counts, n_genes_by_counts, total_counts_mt, total_counts_hb, round(pct_counts_mt, 6) AS pct_counts_mt, round(pct_counts_hb, 6) AS pct_counts_hb FROM metrics")
def qc_cell_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(qc.cell_metrics(V.counts(spark, d), MITO, HB), "pct_counts_mt", "pct_counts_hb")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY sample, cell_id ORDER BY count DESC, gene) AS r FROM counts)
SELECT sample, cell_id, round(100.0 * sum(count) FILTER (WHERE r <= 2) / sum(count), 6) AS pct_top_2, round(100.0 * sum(count) FILTER (WHERE r <= 3) / sum(count), 6) AS pct_top_3 FROM r GROUP BY 1, 2""")
def qc_pct_top_k(spark: SparkSession, d: str) -> DataFrame:
    return rounded(qc.pct_in_top(V.counts(spark, d), (2, 3)), "pct_top_2", "pct_top_3")


@query("SELECT gene, count(*) FILTER (WHERE count > 0) AS n_cells_by_counts, CAST(sum(count) AS BIGINT) AS total_counts, round(sum(count) / CAST((SELECT count(*) FROM cells) AS DOUBLE), 6) AS mean_counts FROM counts GROUP BY 1")
def qc_gene_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(qc.gene_metrics(V.counts(spark, d), n_cells(V.cells(spark, d))), "mean_counts")


_LONG = " UNION ALL ".join(f"SELECT sample, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM metrics" for c in ("total_counts", "n_genes_by_counts", "pct_counts_mt"))


@query(f"WITH {_METRICS}, long AS ({_LONG}) SELECT sample, metric, round(min(value), 6) AS minimum, round(quantile_cont(value, 0.5), 6) AS median, round(max(value), 6) AS maximum FROM long GROUP BY 1, 2")
def qc_ranges_long(spark: SparkSession, d: str) -> DataFrame:
    m = qc.cell_metrics(V.counts(spark, d), MITO, HB)
    return rounded(qc.ranges(m, ("total_counts", "n_genes_by_counts", "pct_counts_mt"), ("sample",)), "minimum", "median", "maximum")


@query(f"""WITH {_METRICS}, long AS (SELECT sample, metric, value FROM ({_LONG}) AS q WHERE metric <> 'pct_counts_mt'),
s AS (SELECT sample, metric, min(value) AS minimum, quantile_cont(value, 0.5) AS median, max(value) AS maximum FROM long GROUP BY 1, 2),
u AS (SELECT sample, metric || '_minimum' AS metric, minimum AS value FROM s UNION ALL SELECT sample, metric || '_median', median FROM s UNION ALL SELECT sample, metric || '_maximum', maximum FROM s)
SELECT sample, metric, CAST(round(value, 3) AS VARCHAR) AS value FROM u""")
def qc_report(spark: SparkSession, d: str) -> DataFrame:
    return qc.report(qc.cell_metrics(V.counts(spark, d), MITO, HB), ("total_counts", "n_genes_by_counts"))


_SWEPT = f"""long AS (
  SELECT sample, cell_id, 'total_counts' AS feature, CAST(total_counts AS DOUBLE) AS value FROM metrics UNION ALL
  SELECT sample, cell_id, 'n_genes_by_counts', CAST(n_genes_by_counts AS DOUBLE) FROM metrics UNION ALL SELECT sample, cell_id, 'pct_counts_mt', pct_counts_mt FROM metrics),
met AS (SELECT l.*, t.direction, t.threshold, CASE WHEN t.direction = 'below' THEN value < threshold ELSE value > threshold END AS gone FROM long l JOIN {_THRESHOLDS_SQL} USING (feature))"""


@query(f"""WITH {_METRICS}, {_SWEPT}
SELECT feature, direction, threshold, round(min(value), 3) AS feature_min, round(quantile_cont(value, 0.5), 3) AS feature_p50, round(max(value), 3) AS feature_max,
 round(100.0 * avg(CAST(value < threshold AS INT)), 3) AS threshold_percentile, count(*) FILTER (WHERE gone) AS n_removed, round(100.0 * avg(CAST(gone AS INT)), 3) AS pct_removed, count(*) FILTER (WHERE NOT gone) AS n_retained
FROM met GROUP BY 1, 2, 3""")
def qc_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return qc.sweep(qc.cell_metrics(V.counts(spark, d), MITO, HB), thresholds(spark))


@query(f"WITH {_METRICS}, {_SWEPT} SELECT feature, direction, threshold, cell_type, count(*) AS n_removed FROM met JOIN cells USING (sample, cell_id) WHERE gone GROUP BY 1, 2, 3, 4")
def qc_sweep_by_type(spark: SparkSession, d: str) -> DataFrame:
    return qc.sweep_by_type(qc.cell_metrics(V.counts(spark, d), MITO, HB), thresholds(spark), V.cells(spark, d), "cell_type")


OVERRIDES = [("MACHINERY", "60", ""), ("HOUSEHOLD", "", "3"), ("AUTOMOBILE", None, " 4 ")]
DEFAULTS = {"min_counts": 40.0, "max_counts": 220.0, "min_cells": 20.0, "min_genes": 2.0, "max_pct_mt": 60.0}
_OVERRIDES_SQL = "(VALUES ('MACHINERY', '60', ''), ('HOUSEHOLD', '', '3'), ('AUTOMOBILE', NULL, ' 4 ')) AS o(sample, min_counts, min_genes)"
_EFFECTIVE = f"""eff AS (SELECT s.sample, coalesce(TRY_CAST(nullif(trim(o.min_counts), '') AS DOUBLE), 40.0) AS min_counts, CAST(220 AS DOUBLE) AS max_counts, CAST(20 AS DOUBLE) AS min_cells,
  coalesce(TRY_CAST(nullif(trim(o.min_genes), '') AS DOUBLE), 2.0) AS min_genes, CAST(60 AS DOUBLE) AS max_pct_mt FROM (SELECT DISTINCT sample FROM cells) s LEFT JOIN {_OVERRIDES_SQL} USING (sample))"""
_CHAIN = f"""{_METRICS}, {_EFFECTIVE},
c1 AS (SELECT m.sample, m.cell_id, m.pct_counts_mt FROM metrics m JOIN eff USING (sample) WHERE total_counts >= min_counts AND total_counts <= max_counts),
k1 AS (SELECT c.*, c1.pct_counts_mt FROM counts c JOIN c1 USING (sample, cell_id)),
g1 AS (SELECT sample, gene FROM (SELECT sample, gene, count(*) AS n FROM k1 WHERE count > 0 GROUP BY 1, 2) q JOIN eff USING (sample) WHERE n >= min_cells),
k2 AS (SELECT k1.* FROM k1 SEMI JOIN g1 USING (sample, gene)),
c2 AS (SELECT sample, cell_id FROM (SELECT sample, cell_id, count(*) FILTER (WHERE count > 0) AS n, any_value(pct_counts_mt) AS pct FROM k2 GROUP BY 1, 2) q JOIN eff USING (sample) WHERE n >= min_genes AND pct <= max_pct_mt),
filtered AS (SELECT k2.sample, k2.cell_id, k2.gene, k2.count FROM k2 SEMI JOIN c2 USING (sample, cell_id))"""


def effective(spark: SparkSession, d: str) -> DataFrame:
    over = spark.createDataFrame(OVERRIDES, "sample string, min_counts string, min_genes string")
    return qc.effective_thresholds(V.cells(spark, d), over, DEFAULTS)


@query(f"WITH {_EFFECTIVE} SELECT * FROM eff")
def qc_per_sample_overrides(spark: SparkSession, d: str) -> DataFrame:
    return effective(spark, d)


@query(f"WITH {_CHAIN} SELECT sample, cell_id, CAST(sum(count) AS BIGINT) AS total, count(*) AS n_genes FROM filtered GROUP BY 1, 2")
def qc_filter_chain(spark: SparkSession, d: str) -> DataFrame:
    out = qc.filter_chain(V.counts(spark, d), effective(spark, d), MITO)
    return out.groupBy("sample", "cell_id").agg(F.sum("count").alias("total"), F.count("*").alias("n_genes"))


@query("SELECT sample, count(DISTINCT cell_id) AS n_cells, count(DISTINCT gene) AS n_genes, CAST(sum(count) AS BIGINT) AS total FROM counts SEMI JOIN (SELECT sample, cell_id FROM cells WHERE cell_type <> '4-NOT SPECIFIED') a USING (sample, cell_id) WHERE count > 0 GROUP BY 1")
def external_mask(spark: SparkSession, d: str) -> DataFrame:
    labels = V.cells(spark, d).where(F.col("cell_type") != "4-NOT SPECIFIED")
    return qc.annotated_only(V.counts(spark, d), labels).groupBy("sample").agg(F.count_distinct("cell_id").alias("n_cells"), F.count_distinct("gene").alias("n_genes"), F.sum("count").alias("total"))


_NORM = """totals AS (SELECT sample, cell_id, sum(count) AS total FROM counts GROUP BY 1, 2 HAVING sum(count) > 0),
med AS (SELECT sample, quantile_cont(CAST(total AS DOUBLE), 0.5) AS target FROM totals GROUP BY 1),
normal AS (SELECT c.sample, c.cell_id, c.gene, c.count, ln(1 + c.count * target / total) AS value FROM counts c JOIN totals USING (sample, cell_id) JOIN med USING (sample))"""


@query(f"WITH {_NORM} SELECT sample, gene, round(sum(value), 5) AS sum_value, count(*) AS n FROM normal GROUP BY 1, 2")
def normalize_median_log1p(spark: SparkSession, d: str) -> DataFrame:
    return normalize.log_normalise(V.counts(spark, d)).groupBy("sample", "gene").agg(F.round(F.sum("value"), 5).alias("sum_value"), F.count("*").alias("n"))


@query("WITH t AS (SELECT sample, cell_id, sum(count) AS total FROM counts GROUP BY 1, 2) SELECT gene, round(sum(ln(1 + count * 1000000.0 / total)), 5) AS sum_value FROM counts JOIN t USING (sample, cell_id) GROUP BY 1")
def normalize_cpm(spark: SparkSession, d: str) -> DataFrame:
    return normalize.log_normalise(V.counts(spark, d), 1e6).groupBy("gene").agg(F.round(F.sum("value"), 5).alias("sum_value"))


@query(f"""WITH {_NORM}, n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cells),
s AS (SELECT gene, sum(exp(value) - 1) AS s, sum((exp(value) - 1) * (exp(value) - 1)) AS ss FROM normal GROUP BY 1),
g AS (SELECT gene, s / n AS mean, (ss - s * s / n) / (n - 1) AS var FROM s, n),
h AS (SELECT gene, mean, ln(1 + mean) AS lm, ln(var / mean) AS dispersion FROM g),
b AS (SELECT *, CAST(least(floor((lm - min(lm) OVER ()) * 20 / (max(lm) OVER () - min(lm) OVER ())), 19) AS BIGINT) AS bin FROM h),
z AS (SELECT *, CASE WHEN stddev_samp(dispersion) OVER (PARTITION BY bin) IS NULL THEN 1.0 ELSE (dispersion - avg(dispersion) OVER (PARTITION BY bin)) / stddev_samp(dispersion) OVER (PARTITION BY bin) END AS norm FROM b),
r AS (SELECT *, row_number() OVER (ORDER BY round(norm, 9) DESC, gene) AS rank FROM z)
SELECT gene, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, bin, round(norm, 5) AS norm, rank FROM r WHERE rank <= 30""")
def hvg_rank(spark: SparkSession, d: str) -> DataFrame:
    out = normalize.highly_variable(normalize.log_normalise(V.counts(spark, d)), n_cells(V.cells(spark, d)), top=30)
    return rounded(rounded(out, "mean", "dispersion"), "norm", to=5)


CLUSTERS = [("0", "T cell", "B cell"), ("1", "T cell", None), ("2", "Fibro", "Fibro"), ("3", "", "Macro")]
_CLUSTERS_SQL = "(VALUES ('c0', 's0_0.5', 'T cell'), ('c0', 's1_0.5', 'B cell'), ('c1', 's0_0.5', 'T cell'), ('c2', 's0_0.5', 'Fibro'), ('c2', 's1_0.5', 'Fibro'), ('c3', 's1_0.5', 'Macro')) AS m(cluster, col, ct)"


@query(f"SELECT sample, coalesce(ct, 'Unannotated') AS cell_type, count(*) AS n FROM spots LEFT JOIN {_CLUSTERS_SQL} ON label = cluster AND col = sample || '_0.5' GROUP BY 1, 2")
def cluster_to_type(spark: SparkSession, d: str) -> DataFrame:
    wide = spark.createDataFrame([("c" + c, a, b) for c, a, b in CLUSTERS], "cluster string, `s0_0.5` string, `s1_0.5` string")
    mapped = annotate.map_clusters(V.spots(spark, d), annotate.cluster_names(wide), "label", F.concat("sample", F.lit("_0.5")))
    return mapped.groupBy("sample", "cell_type").agg(F.count("*").alias("n"))


@query("SELECT coalesce(CAST(quality AS VARCHAR), 'Unannotated') AS label, count(*) AS n FROM documents LEFT JOIN (SELECT doc_id, any_value(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id) GROUP BY 1")
def left_default_labels(spark: SparkSession, d: str) -> DataFrame:
    out = annotate.with_default(V.table(spark, d, "documents").select("doc_id"), V.table(spark, d, "labels"), ["doc_id"], "quality", "Unannotated", "label")
    return out.groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT lang, count(*) AS n, count(*) FILTER (WHERE l.doc_id IS NULL) AS n_uncovered FROM documents LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY 1")
def total_join_gate(spark: SparkSession, d: str) -> DataFrame:
    return annotate.coverage(V.table(spark, d, "documents"), V.table(spark, d, "labels"), ["doc_id"], ["lang"])


@query("""WITH n AS (SELECT niche, condition, count(*) AS n FROM cells GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY niche ORDER BY n DESC, condition) AS r, sum(n) OVER (PARTITION BY niche) AS a FROM n)
SELECT niche, condition AS winner, round(n / CAST(a AS DOUBLE), 6) AS purity FROM r WHERE r = 1""")
def majority_vote_purity(spark: SparkSession, d: str) -> DataFrame:
    return rounded(annotate.majority_vote(V.cells(spark, d), "niche", "condition"), "purity")


@query("SELECT sample, 'leiden_' || replace(CAST(r AS VARCHAR), '.', '_') AS key, cell_type || ' | ' || region_annotation AS composite, CASE WHEN cell_type = '1-URGENT' THEN cell_type ELSE 'Other' END AS shown, count(*) AS n FROM cells, (VALUES ('0.2'), ('1.0')) AS q(r) GROUP BY 1, 2, 3, 4")
def derived_keys(spark: SparkSession, d: str) -> DataFrame:
    res = spark.createDataFrame([("0.2",), ("1.0",)], "r string")
    c = V.cells(spark, d).crossJoin(F.broadcast(res))
    return c.groupBy("sample", annotate.resolution_key(F.col("r")).alias("key"), annotate.composite(F.col("cell_type"), F.col("region_annotation")).alias("composite"), annotate.highlight(F.col("cell_type"), "1-URGENT").alias("shown")).agg(F.count("*").alias("n"))


@query("SELECT batch, patient, count(*) AS n FROM cells LEFT JOIN (VALUES ('MACHINERY', '1', 'P1'), ('FURNITURE', '2', 'P1'), ('BUILDING', '2', 'P2')) AS s(sample, batch, patient) USING (sample) GROUP BY 1, 2")
def stamp_sheet(spark: SparkSession, d: str) -> DataFrame:
    sheet = spark.createDataFrame([("MACHINERY", 1, "P1"), ("FURNITURE", 2, "P1"), ("BUILDING", 2, "P2")], "sample string, batch int, patient string")
    return annotate.stamp(V.cells(spark, d), sheet).groupBy("batch", "patient").agg(F.count("*").alias("n"))


@query("WITH ok AS (SELECT niche FROM cells WHERE niche <> 'NATION_3' GROUP BY 1 HAVING count(*) >= 600) SELECT niche, count(*) AS n FROM cells SEMI JOIN ok USING (niche) GROUP BY 1")
def group_size_gate(spark: SparkSession, d: str) -> DataFrame:
    return annotate.big_enough(V.cells(spark, d), "niche", 600, ("NATION_3",)).groupBy("niche").agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT condition) FILTER (WHERE condition NOT IN ('O')) AS n_labels, true AS has_real, true AS has_several FROM cells")
def label_presence(spark: SparkSession, d: str) -> DataFrame:
    return annotate.usable_labels(V.cells(spark, d), "condition", ("O",))


@query("""WITH part2 AS (SELECT * FROM counts WHERE NOT (sample = 'MACHINERY' AND gene LIKE 'old%')), n AS (SELECT count(DISTINCT sample) AS n FROM part2), g AS (SELECT gene FROM part2, n GROUP BY gene, n HAVING count(DISTINCT sample) = n)
SELECT count(DISTINCT gene) AS n_genes, count(DISTINCT cell_id || '-' || sample) AS n_cells, CAST(sum(count) AS BIGINT) AS total FROM part2 SEMI JOIN g USING (gene)""")
def concat_inner_genes(spark: SparkSession, d: str) -> DataFrame:
    c = V.counts(spark, d).where(~((F.col("sample") == "MACHINERY") & F.col("gene").startswith("old")))
    return annotate.concat_inner(c).agg(F.count_distinct("gene").alias("n_genes"), F.count_distinct("cell_id").alias("n_cells"), F.sum("count").alias("total"))


@query("SELECT gene FROM counts WHERE sample = 'MACHINERY' AND gene LIKE '%o%' INTERSECT SELECT gene FROM counts WHERE sample = 'BUILDING' AND gene LIKE '%e%'")
def shared_gene_gate(spark: SparkSession, d: str) -> DataFrame:
    c = V.counts(spark, d)
    return annotate.shared_genes(c.where((F.col("sample") == "MACHINERY") & F.col("gene").contains("o")), c.where((F.col("sample") == "BUILDING") & F.col("gene").contains("e")), 5)


_TAB = """tab AS (SELECT g.sample, c.cell_type, coalesce(n, 0) AS n FROM (SELECT DISTINCT sample FROM cells) g CROSS JOIN (SELECT DISTINCT cell_type FROM cells) c
  LEFT JOIN (SELECT sample, cell_type, count(*) AS n FROM cells GROUP BY 1, 2) q ON q.sample = g.sample AND q.cell_type = c.cell_type)"""


@query(f"WITH {_TAB} SELECT sample, cell_type, n FROM tab")
def composition_absolute(spark: SparkSession, d: str) -> DataFrame:
    return compose.crosstab(V.cells(spark, d), "sample", "cell_type")


@query(f"WITH {_TAB} SELECT sample, cell_type, n, round(100.0 * n / sum(n) OVER (PARTITION BY sample), 6) AS pct FROM tab")
def composition_relative(spark: SparkSession, d: str) -> DataFrame:
    return rounded(compose.row_percent(compose.crosstab(V.cells(spark, d), "sample", "cell_type"), "sample"), "pct")


@query(f"WITH {_TAB} SELECT sample, cell_type, n, round(n / CAST(sum(n) OVER (PARTITION BY cell_type) AS DOUBLE), 6) AS share FROM tab")
def composition_colnorm(spark: SparkSession, d: str) -> DataFrame:
    return rounded(compose.column_share(compose.crosstab(V.cells(spark, d), "sample", "cell_type"), "cell_type"), "share")


@query("SELECT sample, region_annotation, cell_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY sample, region_annotation), 6) AS pct FROM cells GROUP BY 1, 2, 3")
def composition_grouped(spark: SparkSession, d: str) -> DataFrame:
    return rounded(compose.nested_percent(V.cells(spark, d), "sample", "region_annotation", "cell_type"), "pct")


@query("""WITH q AS (SELECT sample, region_annotation, condition, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY sample, region_annotation) AS pct FROM cells GROUP BY 1, 2, 3)
SELECT sample, region_annotation, round(coalesce(sum(pct) FILTER (WHERE condition = 'F'), 0), 6) AS "F", round(coalesce(sum(pct) FILTER (WHERE condition = 'O'), 0), 6) AS "O", round(coalesce(sum(pct) FILTER (WHERE condition = 'P'), 0), 6) AS "P" FROM q GROUP BY 1, 2""")
def composition_wide(spark: SparkSession, d: str) -> DataFrame:
    return rounded(compose.wide_percent(V.cells(spark, d), "sample", "region_annotation", "condition", ["F", "O", "P"]), "F", "O", "P")


@query("SELECT condition, sample, region_annotation, cell_type, count(*) AS n_cells FROM cells GROUP BY 1, 2, 3, 4")
def cell_count_summary(spark: SparkSession, d: str) -> DataFrame:
    return compose.cell_counts(V.cells(spark, d), "condition", "sample", "region_annotation", "cell_type")


@query("""WITH lab AS (SELECT cell_id, 0 AS res_idx, condition AS cluster FROM cells UNION ALL SELECT cell_id, 1, cell_type FROM cells UNION ALL SELECT cell_id, 2, niche FROM cells)
SELECT a.res_idx, a.cluster AS "from", b.cluster AS "to", count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY a.res_idx, a.cluster) AS DOUBLE), 6) AS share FROM lab a JOIN lab b ON a.cell_id = b.cell_id AND b.res_idx = a.res_idx + 1 GROUP BY 1, 2, 3""")
def cluster_tree_edges(spark: SparkSession, d: str) -> DataFrame:
    c = V.cells(spark, d)
    labels = c.unpivot(["cell_id"], ["condition", "cell_type", "niche"], "which", "cluster").withColumn("res_idx", F.when(F.col("which") == "condition", 0).when(F.col("which") == "cell_type", 1).otherwise(2)).drop("which")
    return rounded(compose.cluster_tree(labels), "share")


@query("""WITH t AS (SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN p_brand WHEN p_size % 3 = 1 THEN CAST(p_size AS VARCHAR) ELSE lpad(CAST(p_size AS VARCHAR), 4, '0') END AS label FROM part)
SELECT label, row_number() OVER (ORDER BY TRY_CAST(label AS DOUBLE) NULLS LAST, label) AS place, CASE label WHEN '10' THEN 0 WHEN 'Brand#13' THEN 1 ELSE 2 END AS config_place, CASE label WHEN '0005' THEN '#111111' ELSE '#cccccc' END AS colour FROM t""")
def label_ordering(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    size = F.col("p_size").cast("string")
    t = V.table(spark, d, "part").select(F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).when(F.col("p_size") % 3 == 1, size).otherwise(F.lpad(size, 4, "0")).alias("label")).distinct()
    return t.select("label", F.row_number().over(Window.orderBy(*compose.numeric_order(F.col("label")))).alias("place"), compose.level_order(F.col("label"), ["10", "Brand#13"]).alias("config_place"), compose.palette(F.col("label"), {"0005": "#111111"}).alias("colour"))
