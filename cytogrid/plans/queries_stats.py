"""Queries of pseudobulk, marker, signature and differential-expression operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytogrid.operators import de, markers, nbinom, normalize, pseudobulk, qc, signatures
from cytogrid.operators.durable import settle
from cytogrid.plans import views as V
from cytogrid.plans.queries_core import _CHAIN, _NORM, MITO, effective, n_cells, rounded
from cytogrid.plans.registry import query


def values(spark: SparkSession, d: str) -> DataFrame:
    return normalize.log_normalise(V.counts(spark, d))


def bulk_sql(counts: str = "counts", by: str = "sample, region_annotation", cells: int = 20, total: int = 500) -> str:
    keys = [k.strip() for k in by.split(",")]
    return f"""bn AS (SELECT {by}, count(*) AS psbulk_n_cells FROM cells GROUP BY ALL),
bs AS (SELECT {', '.join('c.' + k for k in keys)}, k.gene, CAST(sum(k.count) AS BIGINT) AS count FROM {counts} k JOIN cells c USING (sample, cell_id) GROUP BY ALL),
bt AS (SELECT {by}, CAST(sum(count) AS BIGINT) AS psbulk_counts FROM bs GROUP BY ALL),
bulks AS (SELECT bs.*, psbulk_n_cells, psbulk_counts FROM bs JOIN bn USING ({by}) JOIN bt USING ({by}) WHERE psbulk_n_cells >= {cells} AND psbulk_counts >= {total})"""


def bulks(spark: SparkSession, d: str) -> DataFrame:
    cells = pseudobulk.regions_only(V.cells(spark, d))
    return pseudobulk.aggregate(V.counts(spark, d), cells, ["sample", "region_annotation"], 20, 500)


@query(f"WITH {bulk_sql()} SELECT * FROM bulks")
def pseudobulk_by_region(spark: SparkSession, d: str) -> DataFrame:
    return bulks(spark, d)


@query(f"WITH {_CHAIN}, {bulk_sql('filtered')} SELECT * FROM bulks")
def pseudobulk_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """QC chain, then pseudobulk by sample and region with its gates: the flagship query."""
    kept = qc.filter_chain(V.counts(spark, d), effective(spark, d), MITO)
    return pseudobulk.aggregate(kept, pseudobulk.regions_only(V.cells(spark, d)), ["sample", "region_annotation"], 20, 500)


@query(f"""WITH enough AS (SELECT cell_type FROM cells GROUP BY 1 HAVING count(*) >= 30), {bulk_sql(by='cell_type, sample, region_annotation', cells=12, total=1000)},
s AS (SELECT cell_type FROM (SELECT DISTINCT cell_type, sample, region_annotation FROM bulks) q GROUP BY 1 HAVING count(*) >= 4)
SELECT b.* FROM bulks b SEMI JOIN s USING (cell_type) SEMI JOIN enough USING (cell_type)""")
def pseudobulk_by_type_region(spark: SparkSession, d: str) -> DataFrame:
    return pseudobulk.aggregate_by_type(V.counts(spark, d), V.cells(spark, d), "cell_type", ["sample", "region_annotation"], 12, 1000, 4).select("cell_type", "sample", "region_annotation", "gene", "count", "psbulk_n_cells", "psbulk_counts")


@query(f"WITH {bulk_sql()} SELECT 'sample+region_annotation' AS \"grouping\", 'region_annotation' AS condition_col, count(DISTINCT (sample, region_annotation)) AS n_samples, count(DISTINCT gene) AS n_genes FROM bulks")
def pseudobulk_manifest(spark: SparkSession, d: str) -> DataFrame:
    return pseudobulk.manifest(bulks(spark, d), ["sample", "region_annotation"], "region_annotation")


@query(f"""WITH {bulk_sql()}, n AS (SELECT region_annotation, count(*) AS n FROM (SELECT DISTINCT sample, region_annotation FROM bulks) q GROUP BY 1 HAVING count(*) >= 3), ok AS (SELECT * FROM n WHERE (SELECT count(*) FROM n) >= 2),
z AS (SELECT gene FROM bulks GROUP BY 1 HAVING sum(count) > 0)
SELECT region_annotation, count(*) AS n_rows, CAST(sum(count) AS BIGINT) AS total FROM bulks SEMI JOIN ok USING (region_annotation) SEMI JOIN z USING (gene) GROUP BY 1""")
def replicate_gate(spark: SparkSession, d: str) -> DataFrame:
    kept = pseudobulk.expressed(pseudobulk.replicate_gate(bulks(spark, d), ["sample"], "region_annotation", 3))
    return kept.groupBy("region_annotation").agg(F.count("*").alias("n_rows"), F.sum("count").alias("total"))


_FACTORS = f"""{bulk_sql()}, b AS (SELECT e.sample || '|' || e.region_annotation AS bulk, e.region_annotation, g.gene, coalesce(k.count, 0) AS count FROM (SELECT DISTINCT sample, region_annotation FROM bulks) e CROSS JOIN (SELECT DISTINCT gene FROM bulks) g
  LEFT JOIN bulks k ON k.sample = e.sample AND k.region_annotation = e.region_annotation AND k.gene = g.gene),
lc AS (SELECT *, ln(count) AS lc FROM b WHERE count > 0), fullg AS (SELECT gene, avg(lc) AS m FROM lc GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT bulk) FROM b)),
sf AS (SELECT bulk, exp(quantile_cont(lc - m, 0.5)) AS size_factor FROM lc JOIN fullg USING (gene) GROUP BY 1),
normed AS (SELECT b.*, count / size_factor AS norm, log2(count / size_factor + 1) AS value FROM b JOIN sf USING (bulk))"""


def named_bulks(spark: SparkSession, d: str) -> DataFrame:
    # a small table (pseudobulks x genes) that several branches read
    every = settle(pseudobulk.completed(settle(bulks(spark, d)), ["sample", "region_annotation"]))
    return every.select(F.concat_ws("|", "sample", "region_annotation").alias("bulk"), "region_annotation", "gene", "count")


def normed(spark: SparkSession, d: str) -> DataFrame:
    b = named_bulks(spark, d)
    return pseudobulk.log_normalised(b, pseudobulk.size_factors(b, "bulk"), "bulk")


@query(f"WITH {_FACTORS} SELECT bulk, round(size_factor, 6) AS size_factor FROM sf")
def size_factors(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pseudobulk.size_factors(named_bulks(spark, d), "bulk"), "size_factor")


@query(f"WITH {_FACTORS}, z AS (SELECT gene, bulk, (value - avg(value) OVER (PARTITION BY gene)) / nullif(stddev_samp(value) OVER (PARTITION BY gene), 0) AS z FROM normed) SELECT gene, bulk, round(z, 5) AS z FROM z WHERE z IS NOT NULL")
def gene_zscore(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pseudobulk.gene_zscores(normed(spark, d), "bulk"), "z", to=5)


_RATIOS = f"""{_FACTORS}, m AS (SELECT gene, region_annotation AS lv, avg(norm) AS m FROM normed GROUP BY 1, 2),
ratios AS (SELECT x.gene, x.lv AS a, y.lv AS b, x.lv || '_vs_' || y.lv AS contrast, CASE WHEN x.m > 0 OR y.m > 0 THEN log2(CASE WHEN x.m > 0 THEN x.m ELSE 0.5 END / CASE WHEN y.m > 0 THEN y.m ELSE 0.5 END) END AS log2fc FROM m x JOIN m y ON x.gene = y.gene AND x.lv < y.lv)"""
_ERFC = " + ".join(f"({c!r} * pow(1 / (1 + 0.3275911 * abs(stat) / sqrt(2.0)), {k + 1}))" for k, c in enumerate(de.ERFC))
#: Welch's statistic of log2 normalised counts, and its p-value.
_WELCH = f"""{_RATIOS}, lvl AS (SELECT gene, region_annotation AS lv, avg(value) AS m, var_samp(value) AS v, count(*) AS n FROM normed GROUP BY 1, 2),
wz AS (SELECT x.gene, x.lv AS a, y.lv AS b, (x.m - y.m) / nullif(sqrt(x.v / x.n + y.v / y.n), 0) AS stat FROM lvl x JOIN lvl y ON x.gene = y.gene AND x.lv < y.lv),
wp AS (SELECT gene, a, b, stat, exp(-stat * stat / 2) * ({_ERFC}) AS p FROM wz)"""


def ratios(spark: SparkSession, d: str) -> DataFrame:
    n = settle(normed(spark, d))
    return de.mean_ratios(n, "region_annotation").join(de.welch(n, "region_annotation").drop("contrast"), ["gene", "a", "b"])


@query(f"WITH {_WELCH} SELECT gene, a, b, round(stat, 5) AS stat, round(p, 7) AS p FROM wp")
def welch_tests(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(de.welch(normed(spark, d), "region_annotation"), "stat", to=5), "p", to=7).drop("contrast")


@query(f"WITH {_RATIOS} SELECT gene, a, b, contrast, round(log2fc, 5) AS log2fc FROM ratios")
def pairwise_contrasts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(de.mean_ratios(normed(spark, d), "region_annotation"), "log2fc", to=5)


_ADJ = f"""{_WELCH}, pv AS (SELECT r.*, round(p, 9) AS p FROM ratios r JOIN wp USING (gene, a, b)), rk AS (SELECT *, row_number() OVER (PARTITION BY contrast ORDER BY p, gene) AS r, count(*) OVER (PARTITION BY contrast) AS n FROM pv),
adj AS (SELECT *, least(1.0, min(p * n / r) OVER (PARTITION BY contrast ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj FROM rk),
stats AS (SELECT gene, a, b, contrast, log2fc, p, padj FROM adj)"""


def stats(spark: SparkSession, d: str) -> DataFrame:
    # a small table that several branches read
    return settle(markers.adjust(rounded(ratios(spark, d), "p", to=9), "p", ["contrast"]))


@query(f"WITH {_ADJ} SELECT gene, contrast, round(p, 7) AS p, round(padj, 6) AS padj FROM stats")
def bh_adjust(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(stats(spark, d), "padj"), "p", to=7).select("gene", "contrast", "p", "padj")


_CLASSED = f"{_ADJ}, classed AS (SELECT *, CASE WHEN padj >= 0.9 THEN 'NS' WHEN log2fc > 0.05 THEN 'Up' WHEN log2fc < -0.05 THEN 'Down' ELSE 'NS' END AS class, -log10(greatest(padj, 1e-300)) AS neg_log10 FROM stats WHERE padj IS NOT NULL AND log2fc IS NOT NULL)"


@query(f"WITH {_CLASSED} SELECT contrast, class, count(*) AS n, round(sum(neg_log10), 4) AS s FROM classed GROUP BY 1, 2")
def volcano_classes(spark: SparkSession, d: str) -> DataFrame:
    return de.classes(stats(spark, d), 0.9, 0.05).groupBy("contrast", "class").agg(F.count("*").alias("n"), F.round(F.sum("neg_log10"), 4).alias("s"))


@query(f"WITH {_ADJ} SELECT contrast, count(padj) AS n_tested, count(*) FILTER (WHERE padj < 0.9) AS n_significant, count(*) FILTER (WHERE padj < 0.9 AND log2fc > 0.05) AS n_up, count(*) FILTER (WHERE padj < 0.9 AND log2fc < -0.05) AS n_down FROM stats GROUP BY 1")
def de_summary(spark: SparkSession, d: str) -> DataFrame:
    return de.summary(stats(spark, d), "contrast", 0.9, 0.05)


@query(f"""WITH {_CLASSED} SELECT contrast, gene, side, rank FROM (
SELECT contrast, gene, 'Up' AS side, row_number() OVER (PARTITION BY contrast ORDER BY log2fc DESC, gene) AS rank FROM classed WHERE class = 'Up' UNION ALL
SELECT contrast, gene, 'Down', row_number() OVER (PARTITION BY contrast ORDER BY log2fc, gene) FROM classed WHERE class = 'Down') q WHERE rank <= 10""")
def topk_up_down(spark: SparkSession, d: str) -> DataFrame:
    return de.labels_up_down(de.classes(stats(spark, d), 0.9, 0.05), "contrast").select("contrast", "gene", "side", "rank")


@query(f"""WITH {_ADJ}, s AS (SELECT * FROM stats WHERE padj < 0.9) SELECT contrast, gene, side, mode, rank FROM (
SELECT contrast, gene, 'up' AS side, 'fixed' AS mode, row_number() OVER (PARTITION BY contrast ORDER BY log2fc DESC, gene) AS rank FROM s WHERE log2fc > 0 UNION ALL
SELECT contrast, gene, 'down', 'fixed', row_number() OVER (PARTITION BY contrast ORDER BY log2fc, gene) FROM s WHERE log2fc < 0 UNION ALL
SELECT contrast, gene, 'up', 'compat', row_number() OVER (PARTITION BY contrast ORDER BY log2fc DESC, gene) FROM s WHERE log2fc > 0 UNION ALL
SELECT contrast, gene, 'down', 'compat', row_number() OVER (PARTITION BY contrast ORDER BY log2fc DESC, gene) FROM s WHERE log2fc < 0) q WHERE rank <= 5""")
def heatmap_genes(spark: SparkSession, d: str) -> DataFrame:
    s = stats(spark, d)
    both = [de.heatmap_genes(s, "contrast", 5, 0.9, c).withColumn("mode", F.lit("compat" if c else "fixed")) for c in (False, True)]
    return both[0].unionByName(both[1]).select("contrast", "gene", "side", "mode", "rank")


_UNIQUE = f"{_ADJ}, up AS (SELECT DISTINCT a AS level, gene FROM stats WHERE padj < 0.9 AND log2fc > 0.02), uniq AS (SELECT level, gene FROM up u WHERE NOT EXISTS (SELECT 1 FROM up o WHERE o.gene = u.gene AND o.level <> u.level))"


def unique(spark: SparkSession, d: str) -> DataFrame:
    return de.unique_markers(stats(spark, d).withColumnRenamed("a", "level"), "level", 0.9, 0.02)


@query(f"WITH {_UNIQUE} SELECT level, gene FROM uniq")
def unique_markers(spark: SparkSession, d: str) -> DataFrame:
    return unique(spark, d)


@query(f"""WITH {_UNIQUE}, r AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY gene) AS row FROM uniq)
SELECT row, max(gene) FILTER (WHERE level = 'AFRICA') AS "AFRICA", max(gene) FILTER (WHERE level = 'AMERICA') AS "AMERICA", max(gene) FILTER (WHERE level = 'ASIA') AS "ASIA", max(gene) FILTER (WHERE level = 'EUROPE') AS "EUROPE", max(gene) FILTER (WHERE level = 'MIDDLE EAST') AS "MIDDLE EAST" FROM r GROUP BY 1""")
def unique_markers_wide(spark: SparkSession, d: str) -> DataFrame:
    return de.ragged(unique(spark, d), "level", REGIONS)


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query()
def nb_wald(spark: SparkSession, d: str) -> DataFrame:
    """Negative-binomial tests of all regions with adjusted p-values; held against loops over genes and planted effects in tests."""
    b = named_bulks(spark, d)
    return nbinom.nb_tests(b, pseudobulk.size_factors(b, "bulk"), "bulk", "region_annotation", REGIONS)


#: A trend of dispersions for the test of the transform alone; ``nb_stabilised`` fits its own.
A0, A1 = 0.05, 2.0


@query(f"WITH {_FACTORS} SELECT bulk, gene, round(log2((1 + {A1} + 2 * {A0} * norm + 2 * sqrt({A0} * norm * (1 + {A1} + {A0} * norm))) / (4 * {A0})), 6) AS value FROM normed")
def vst_values(spark: SparkSession, d: str) -> DataFrame:
    n = normed(spark, d)
    return rounded(n.select("bulk", "gene", nbinom.vst(F.col("norm"), A0, A1).alias("value")), "value")


@query()
def nb_stabilised(spark: SparkSession, d: str) -> DataFrame:
    """Variance-stabilised counts under the trend fitted to the data."""
    b = named_bulks(spark, d)
    return nbinom.stabilised(b, pseudobulk.size_factors(b, "bulk"), "bulk", "region_annotation", REGIONS)


@query()
def pattern_groups(spark: SparkSession, d: str) -> DataFrame:
    """All genes by their profile over the regions; held against planted profiles in tests."""
    values = nb_stabilised(spark, d)
    return de.pattern_groups(values, values, "region_annotation", least=2)


_DOTS = f"""{_NORM}, dg AS (SELECT sample, cell_id, cell_type || ' | ' || region_annotation AS grp FROM cells), dn AS (SELECT grp, count(*) AS n FROM dg GROUP BY 1),
dx AS (SELECT gene, grp, sum(value) AS s, count(*) FILTER (WHERE value > 0) AS k FROM normal JOIN dg USING (sample, cell_id) GROUP BY 1, 2),
df AS (SELECT g.gene, dn.grp, coalesce(s, 0) / n AS mean, coalesce(k, 0) / CAST(n AS DOUBLE) AS fraction FROM (SELECT DISTINCT gene FROM normal) g CROSS JOIN dn LEFT JOIN dx ON dx.gene = g.gene AND dx.grp = dn.grp)"""


@query(f"WITH {_DOTS} SELECT gene, grp, round(mean, 6) AS mean, round(fraction, 6) AS fraction, round(coalesce((mean - min(mean) OVER w) / nullif(max(mean) OVER w - min(mean) OVER w, 0), 0), 5) AS scaled FROM df WINDOW w AS (PARTITION BY gene)")
def dotplot_stats(spark: SparkSession, d: str) -> DataFrame:
    out = markers.dot_stats(values(spark, d), V.cells(spark, d), F.concat_ws(" | ", "cell_type", "region_annotation"))
    return rounded(rounded(out, "mean", "fraction"), "scaled", to=5)


@query(f"WITH {_NORM} SELECT gene, sample, cell_type, region_annotation, round(sum(value), 5) AS sum_value, count(*) FILTER (WHERE value > 0) AS n_positive FROM normal JOIN cells USING (sample, cell_id) GROUP BY GROUPING SETS ((gene, sample), (gene, sample, cell_type), (gene, sample, region_annotation))")
def sample_contribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(markers.contributions(values(spark, d), V.cells(spark, d), "cell_type", "region_annotation"), "sum_value", to=5)


@query(f"""WITH {_NORM}, nc AS (SELECT count(*) AS n FROM cells), z AS (SELECT gene, round(value, 9) AS value FROM normal UNION ALL SELECT gene, 0 FROM (SELECT gene, n - count(*) AS k FROM normal, nc GROUP BY gene, n) q, range(1000000) r(i) WHERE i < k)
SELECT gene, round(quantile_cont(value, 0.01), 5) AS vmin, round(quantile_cont(value, 0.99), 5) AS vmax FROM z GROUP BY 1""")
def expression_ranges(spark: SparkSession, d: str) -> DataFrame:
    return rounded(signatures.expression_ranges(values(spark, d), n_cells(V.cells(spark, d))), "vmin", "vmax", to=5)


_RANKED = f"""{_NORM}, v AS (SELECT gene, sample, cell_id, round(value, 9) AS value FROM normal), gs AS (SELECT cell_type, count(*) AS n_g, (SELECT count(*) FROM cells) AS n_all FROM cells GROUP BY 1),
pv AS (SELECT gene, value, count(*) AS same FROM v GROUP BY 1, 2), rk AS (SELECT gene, value, coalesce(sum(same) OVER (PARTITION BY gene ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (same + 1) / 2.0 AS rank FROM pv),
pg AS (SELECT v.gene, cell_type, sum(rank) AS r, count(*) AS nz, sum(exp(v.value) - 1) AS e FROM v JOIN cells USING (sample, cell_id) JOIN rk ON rk.gene = v.gene AND rk.value = v.value GROUP BY 1, 2),
ga AS (SELECT gene, sum(nz) AS nz_all, sum(e) AS e_all FROM pg GROUP BY 1),
f AS (SELECT gs.cell_type, ga.gene, n_g, n_all, n_all - nz_all AS zeros, coalesce(r, 0) AS r, coalesce(nz, 0) AS nz, coalesce(e, 0) AS e, e_all FROM ga CROSS JOIN gs LEFT JOIN pg ON pg.gene = ga.gene AND pg.cell_type = gs.cell_type),
w AS (SELECT *, r + nz * zeros + (n_g - nz) * (zeros + 1) / 2.0 AS rank_sum FROM f),
ranked AS (SELECT cell_type, gene, rank_sum, (rank_sum - n_g * (n_all + 1) / 2.0) / sqrt(CAST(n_g AS DOUBLE) * (n_all - n_g) * (n_all + 1) / 12.0) AS score, log2((e / n_g + 1e-9) / ((e_all - e) / (n_all - n_g) + 1e-9)) AS logfoldchange FROM w)"""


def ranked(spark: SparkSession, d: str) -> DataFrame:
    return markers.rank_sum(values(spark, d).withColumn("value", F.round("value", 9)), V.cells(spark, d), "cell_type")


@query(f"WITH {_RANKED} SELECT cell_type, gene, round(rank_sum, 1) AS rank_sum, round(score, 5) AS score, round(logfoldchange, 5) AS logfoldchange FROM ranked")
def rank_sum_markers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(ranked(spark, d), "rank_sum", to=1), "score", "logfoldchange", to=5)


@query(f"""WITH {_RANKED}, t AS (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY round(score, 9) DESC, gene) AS rank FROM ranked), fa AS (SELECT gene, min((cell_type, rank)) AS fa FROM t WHERE rank <= 4 GROUP BY 1)
SELECT gene, row_number() OVER (ORDER BY fa) AS place FROM fa""")
def top_markers_dedup(spark: SparkSession, d: str) -> DataFrame:
    return markers.first_appearance(markers.top_markers(ranked(spark, d), "cell_type", 4), "cell_type")


@query()
def rank_sum_pvalues(spark: SparkSession, d: str) -> DataFrame:
    """The same with p-values (an Arrow function; SQL has no erfc) and their adjustment."""
    return markers.adjust(ranked(spark, d).withColumn("p", markers.normal_two_sided("score")), "p", ["cell_type"], "pvals_adj")


LISTS = [("hot-ring", "hot-ring", "red-plate"), (None, "hot-bolt", "red-bolt"), (None, "missing", " "), (None, "hot-gear", None)]
_LISTS_SQL = "lists AS (SELECT * FROM (VALUES ('hot-ring', 'hot-ring'), ('warm', 'hot-ring'), ('warm', 'hot-bolt'), ('warm', 'missing'), ('warm', 'hot-gear'), ('rouge', 'red-plate'), ('rouge', 'red-bolt')) AS t(entry, gene))"


def lists(spark: SparkSession) -> DataFrame:
    return signatures.entries(spark.createDataFrame(LISTS, "`hot-ring` string, warm string, rouge string"))


@query("""WITH l AS (SELECT 'hot' AS entry, CASE WHEN p_name LIKE 'hot%' THEN p_name END AS gene FROM part UNION ALL SELECT 'large', CASE WHEN p_size > 40 THEN trim(p_brand || ' ') ELSE ' ' END FROM part UNION ALL SELECT 'Brand#13', max(p_brand) FILTER (WHERE p_brand = 'Brand#13') FROM part)
SELECT entry, CASE WHEN count(*) = 1 AND any_value(gene) = entry THEN 'gene' ELSE 'signature' END AS kind, count(*) AS n FROM l WHERE trim(gene) <> '' GROUP BY entry""")
def column_list_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """Gene lists written from the parts: two signatures with blanks between, and an entry that lists itself."""
    p, first = V.table(spark, d, "part"), Window.partitionBy("p_brand").orderBy("p_partkey")
    alone = F.when((F.col("p_brand") == "Brand#13") & (F.row_number().over(first) == 1), F.col("p_brand"))
    wide = p.select(F.when(F.col("p_name").startswith("hot"), F.col("p_name")).alias("hot"), F.when(F.col("p_size") > 40, F.concat("p_brand", F.lit(" "))).otherwise(" ").alias("large"), alone.alias("Brand#13"))
    return signatures.kinds(signatures.entries(wide))


@query(f"WITH {_LISTS_SQL} SELECT entry, gene FROM lists SEMI JOIN genes USING (gene)")
def gene_presence(spark: SparkSession, d: str) -> DataFrame:
    return signatures.present(lists(spark), V.genes(spark, d)).select("entry", "gene")


@query(f"""WITH {_NORM}, {_LISTS_SQL}, net AS (SELECT entry AS source, gene AS target FROM lists SEMI JOIN genes USING (gene) WHERE entry <> 'hot-ring'),
rk AS (SELECT *, row_number() OVER (PARTITION BY sample, cell_id ORDER BY round(value, 9) DESC, gene) AS rank FROM normal WHERE value > 0), mo AS (SELECT source, least(count(*), 2) * 3 - least(count(*), 2) * (least(count(*), 2) + 1) / 2.0 AS most FROM net GROUP BY 1)
SELECT sample, cell_id, source, round(sum(3 - rank) / any_value(most), 6) AS score FROM rk JOIN net ON gene = target JOIN mo USING (source) WHERE rank < 3 GROUP BY 1, 2, 3""")
def aucell_score(spark: SparkSession, d: str) -> DataFrame:
    net = signatures.present(lists(spark), V.genes(spark, d)).where("entry <> 'hot-ring'").select(F.col("entry").alias("source"), F.col("gene").alias("target"))
    v = values(spark, d).withColumn("value", F.round("value", 9))
    return rounded(signatures.aucell(v, net, 64), "score")
