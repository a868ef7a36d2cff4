"""Queries of what is told of clusterings of a part: several clusterings of the same cells in one pass, and the boxes of a sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytogrid.operators import branches, compose, embed, markers
from cytogrid.plans import views as V
from cytogrid.plans.queries_core import HB, MITO, _METRICS, rounded
from cytogrid.plans.queries_numeric import _ROWS, rows
from cytogrid.plans.queries_stats import _NORM, values
from cytogrid.plans.registry import query

_STEPS = """st AS (SELECT sample, cell_id, region_annotation, niche, 0 AS res_idx, condition AS cluster FROM cells UNION ALL SELECT sample, cell_id, region_annotation, niche, 1, cell_type FROM cells
UNION ALL SELECT sample, cell_id, region_annotation, niche, 2, cell_type || condition FROM cells)"""


def steps(spark: SparkSession, d: str) -> DataFrame:
    """Three label columns of the cells as clusterings: a row for each cell and clustering."""
    of = F.array("condition", "cell_type", F.concat("cell_type", "condition"))
    return V.cells(spark, d).select("sample", "cell_id", "region_annotation", "niche", F.posexplode(of).alias("res_idx", "cluster"))


@query(f"""WITH {_ROWS}, lb AS (SELECT id, v, unnest([0, 1, 2]) AS res_idx, unnest([label, 'm' || CAST(vec_id % 3 AS VARCHAR), label || CAST(vec_id % 2 AS VARCHAR)]) AS label FROM r0),
md AS (SELECT a.id, a.res_idx, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS s, count(*) AS n FROM lb a JOIN lb b USING (res_idx) GROUP BY 1, 2, 3, 4),
ab AS (SELECT id, res_idx, label, max(s / nullif(n - 1, 0)) FILTER (WHERE label = other) AS a, min(s / n) FILTER (WHERE label <> other) AS b FROM md GROUP BY 1, 2, 3)
SELECT res_idx, label, round(avg(coalesce((b - a) / greatest(a, b), 0)), 5) AS mean_silhouette, count(*) AS n FROM ab GROUP BY 1, 2""")
def ladder_silhouettes(spark: SparkSession, d: str) -> DataFrame:
    """Mean silhouettes of three clusterings of all vectors, each distance computed once."""
    r = rows(spark, d)
    labels = F.array("label", F.concat(F.lit("m"), (F.col("vec_id") % 3).cast("string")), F.concat("label", (F.col("vec_id") % 2).cast("string")))
    s = embed.ladder_silhouettes(r.select("id", "v", labels.alias("labels")))
    return s.groupBy("res_idx", "label").agg(F.round(F.avg("silhouette"), 5).alias("mean_silhouette"), F.count("*").alias("n"))


@query(f"""WITH {_NORM}, {_STEPS}, v AS (SELECT gene, sample, cell_id, round(value, 9) AS value FROM normal), gs AS (SELECT res_idx, cluster, count(*) AS n_g, sum(count(*)) OVER (PARTITION BY res_idx) AS n_all FROM st GROUP BY 1, 2),
j AS (SELECT res_idx, cluster, gene, value FROM v JOIN st USING (sample, cell_id)), pv AS (SELECT res_idx, gene, value, count(*) AS same FROM j GROUP BY 1, 2, 3),
rk AS (SELECT res_idx, gene, value, coalesce(sum(same) OVER (PARTITION BY res_idx, gene ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (same + 1) / 2.0 AS rank FROM pv),
pg AS (SELECT res_idx, gene, cluster, sum(rank) AS r, count(*) AS nz FROM j JOIN rk USING (res_idx, gene, value) GROUP BY 1, 2, 3), ga AS (SELECT res_idx, gene, sum(nz) AS nz_all FROM pg GROUP BY 1, 2),
f AS (SELECT gs.res_idx, gs.cluster, ga.gene, n_g, n_all, n_all - nz_all AS zeros, coalesce(r, 0) AS r, coalesce(nz, 0) AS nz FROM ga JOIN gs USING (res_idx) LEFT JOIN pg ON pg.res_idx = gs.res_idx AND pg.gene = ga.gene AND pg.cluster = gs.cluster),
s AS (SELECT res_idx, cluster, gene, (r + nz * zeros + (n_g - nz) * (zeros + 1) / 2.0 - n_g * (n_all + 1) / 2.0) / sqrt(CAST(n_g AS DOUBLE) * (n_all - n_g) * (n_all + 1) / 12.0) AS score FROM f)
SELECT res_idx, cluster, gene, round(score, 5) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY res_idx, cluster ORDER BY round(score, 9) DESC, gene) AS rank FROM s) q WHERE rank <= 5""")
def ladder_markers(spark: SparkSession, d: str) -> DataFrame:
    """The five best genes of each cluster of three clusterings, ranked in one pass."""
    scores = markers.rank_sum(values(spark, d).withColumn("value", F.round("value", 9)), steps(spark, d), "cluster", ["res_idx"])
    return rounded(markers.top_markers(scores, "cluster", 5, ["res_idx"]).select("res_idx", "cluster", "gene", "score", "rank"), "score", to=5)


@query(f"""WITH {_NORM}, {_STEPS}, dn AS (SELECT res_idx, cluster, count(*) AS n FROM st GROUP BY 1, 2),
dx AS (SELECT res_idx, gene, cluster, sum(value) AS s, count(*) FILTER (WHERE value > 0) AS k FROM normal JOIN st USING (sample, cell_id) GROUP BY 1, 2, 3),
df AS (SELECT dn.res_idx, g.gene, dn.cluster, coalesce(s, 0) / n AS mean, coalesce(k, 0) / CAST(n AS DOUBLE) AS fraction FROM (SELECT DISTINCT gene FROM normal) g CROSS JOIN dn LEFT JOIN dx ON dx.res_idx = dn.res_idx AND dx.gene = g.gene AND dx.cluster = dn.cluster)
SELECT res_idx, gene, cluster, round(mean, 6) AS mean, round(fraction, 6) AS fraction, round(coalesce((mean - min(mean) OVER w) / nullif(max(mean) OVER w - min(mean) OVER w, 0), 0), 5) AS scaled FROM df WINDOW w AS (PARTITION BY res_idx, gene)""")
def ladder_dotplot(spark: SparkSession, d: str) -> DataFrame:
    out = markers.dot_stats(values(spark, d), steps(spark, d), F.col("cluster"), "cluster", ["res_idx"])
    return rounded(rounded(out, "mean", "fraction"), "scaled", to=5)


@query(f"""WITH {_STEPS}, t AS (SELECT a.region_annotation, a.res_idx, a.cluster AS "from", b.cluster AS "to", count(*) AS n FROM st a JOIN st b ON a.sample = b.sample AND a.cell_id = b.cell_id AND b.res_idx = a.res_idx + 1 GROUP BY 1, 2, 3, 4)
SELECT *, round(n / CAST(sum(n) OVER (PARTITION BY region_annotation, res_idx, "from") AS DOUBLE), 6) AS share FROM t""")
def region_cluster_trees(spark: SparkSession, d: str) -> DataFrame:
    """Transitions between the clusterings, a tree for each region."""
    labels = steps(spark, d).withColumn("id", F.concat_ws("|", "sample", "cell_id"))
    return rounded(compose.cluster_tree(labels, "id", ["region_annotation"]), "share")


@query(f"""WITH {_STEPS}, l AS (SELECT res_idx, cluster, unnest(['sample', 'region_annotation', 'same', 'niche']) AS kind, unnest([sample, region_annotation, 'x', niche]) AS value FROM st), n AS (SELECT res_idx, cluster, kind, value, count(*) AS n FROM l GROUP BY ALL)
SELECT res_idx, cluster, kind, value, n, round(100.0 * n / sum(n) OVER (PARTITION BY res_idx, cluster, kind), 6) AS pct_of_cluster, round(100.0 * n / sum(n) OVER (PARTITION BY res_idx, kind, value), 6) AS pct_of_value FROM n WHERE kind <> 'same'""")
def ladder_compositions(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of three clusterings by sample, region and niche, both ways round; a label with one value is left out."""
    cells = steps(spark, d).withColumn("same", F.lit("x"))
    return rounded(branches.compositions(cells, ["res_idx"], "cluster", ["sample", "region_annotation", "same", "niche"]), "pct_of_cluster", "pct_of_value")


@query(f"""WITH {_METRICS}, {_STEPS}, r AS (SELECT *, row_number() OVER (PARTITION BY sample, cell_id ORDER BY count DESC, gene) AS r FROM counts),
tp AS (SELECT sample, cell_id, 100.0 * sum(count) FILTER (WHERE r <= 50) / sum(count) AS pct_top_50, 100.0 * sum(count) FILTER (WHERE r <= 100) / sum(count) AS pct_top_100 FROM r GROUP BY 1, 2),
l AS (SELECT res_idx, cluster, unnest(['n_genes_by_counts', 'total_counts', 'pct_top_50', 'pct_top_100', 'pct_counts_mt', 'pct_counts_hb']) AS metric,
  unnest(CAST([n_genes_by_counts, total_counts, pct_top_50, pct_top_100, pct_counts_mt, pct_counts_hb] AS DOUBLE[])) AS value FROM metrics JOIN tp USING (sample, cell_id) JOIN st USING (sample, cell_id)),
q AS (SELECT res_idx, cluster, metric, quantile_cont(value, [0, 0.25, 0.5, 0.75, 1]) AS q FROM l GROUP BY 1, 2, 3)
SELECT res_idx, cluster, metric, unnest(CAST([0.0, 0.25, 0.5, 0.75, 1.0] AS DOUBLE[])) AS point, round(unnest(q), 5) AS value FROM q""")
def ladder_metric_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Five points of every quality metric in each cluster of three clusterings."""
    c = V.counts(spark, d)
    return rounded(branches.metric_distribution(steps(spark, d).join(branches.cell_qc(c, MITO, HB), ["sample", "cell_id"]), ["res_idx"], "cluster"), "value", to=5)


@query(f"WITH {_STEPS} SELECT sample, cluster, region_annotation, niche, count(*) AS n_cells FROM st WHERE res_idx = 1 GROUP BY ALL")
def middle_cluster_counts(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the middle clustering by sample, region and niche."""
    return branches.middle_counts(steps(spark, d), ["sample"], "cluster", ["region_annotation", "niche"])


@query(f"""WITH {_ROWS}, e AS (SELECT greatest(max(v[1]) - min(v[1]), max(v[2]) - min(v[2]), max(v[3]) - min(v[3])) AS span, greatest(100, CAST(floor(count(*) * 0.1) AS BIGINT)) AS wanted FROM r0),
j AS (SELECT span / pow(2, unnest(range(0, 40))) AS side, wanted FROM e),
b AS (SELECT side, wanted, count(DISTINCT (floor(v[1] / side), floor(v[2] / side), floor(v[3] / side))) AS boxes FROM r0 CROSS JOIN j GROUP BY 1, 2)
SELECT wanted, round(side, 9) AS side, boxes FROM b WHERE boxes <= wanted ORDER BY side LIMIT 1""")
def sketch_box_side(spark: SparkSession, d: str) -> DataFrame:
    """Size of the sketch of all vectors, the side of its boxes and how many there are."""
    r = rows(spark, d).select("id", "v")
    n = max(100, r.count() // 10)
    side = embed.box_size(r, n)
    return embed.sketch(r, n, side).agg(F.lit(n).cast("long").alias("wanted"), F.round(F.lit(side), 9).alias("side"), F.count_distinct("box").alias("boxes"))
