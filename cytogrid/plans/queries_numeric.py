"""Queries of embedding, clustering and integration operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytogrid.operators import de, embed, graph, normalize, pseudobulk
from cytogrid.operators.durable import settle
from cytogrid.plans import views as V
from cytogrid.plans.queries_core import rounded
from cytogrid.plans.queries_stats import _FACTORS, named_bulks, normed
from cytogrid.plans.registry import query

K = 8


def rows(spark: SparkSession, d: str) -> DataFrame:
    """id, v (all components, rounded), label, batch."""
    v = F.transform("pcs", lambda x: F.round(x, 6))
    return V.spots(spark, d).select(F.col("cell_id").alias("id"), v.alias("v"), "label", F.col("sample").alias("batch"), "vec_id")


_ROWS = """r0 AS (SELECT 'v' || CAST(vec_id AS VARCHAR) AS id, vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6)) AS v, 'c' || CAST(label AS VARCHAR) AS label FROM embeddings)"""
_NEAR = f"""{_ROWS}, pr AS (SELECT a.id AS src, b.id AS dst, round(list_distance(a.v, b.v), 9) AS d FROM r0 a JOIN r0 b ON a.id <> b.id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rank FROM pr) q WHERE rank <= {K})"""


@query(f"WITH {_NEAR} SELECT src, dst, rank, round(d, 6) AS d FROM knn")
def knn_graph(spark: SparkSession, d: str) -> DataFrame:
    return rounded(embed.knn(rows(spark, d), rows(spark, d), K), "d")


@query(f"""WITH {_ROWS}, pr AS (SELECT a.id AS src, b.id AS dst, b.label, round(list_distance(a.v, b.v), 9) AS d FROM r0 a JOIN r0 b ON a.vec_id % 2 = 1 AND b.vec_id % 2 = 0),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rank FROM pr) q WHERE rank <= 15), n AS (SELECT src, label, count(*) AS n FROM k GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER (PARTITION BY src) AS al, row_number() OVER (PARTITION BY src ORDER BY n DESC, label) AS r FROM n) SELECT src AS id, label, round(n / CAST(al AS DOUBLE), 6) AS share FROM t WHERE r = 1""")
def knn_label_transfer(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d)
    return rounded(embed.transfer_labels(r.where("vec_id % 2 = 1"), r.where("vec_id % 2 = 0"), 15), "share")


@query(f"""WITH {_ROWS}, st AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM r0) q GROUP BY i), zz AS (SELECT id, label, list((x - m) / s ORDER BY i) AS v FROM (SELECT id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM r0) q JOIN st USING (i) GROUP BY 1, 2),
md AS (SELECT a.id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS s, count(*) AS n FROM zz a JOIN zz b ON true GROUP BY 1, 2, 3),
ab AS (SELECT id, label, max(s / nullif(n - 1, 0)) FILTER (WHERE label = other) AS a, min(s / n) FILTER (WHERE label <> other) AS b FROM md GROUP BY 1, 2)
SELECT label, round(avg(coalesce((b - a) / greatest(a, b), 0)), 5) AS mean_silhouette, count(*) AS n FROM ab GROUP BY 1""")
def silhouette_euclid(spark: SparkSession, d: str) -> DataFrame:
    s = embed.silhouettes(embed.standardised(rows(spark, d)))
    return s.groupBy("label").agg(F.round(F.avg("silhouette"), 5).alias("mean_silhouette"), F.count("*").alias("n"))


@query(f"""WITH {_ROWS}, b AS (SELECT id, CAST(CAST(floor(v[1] / 0.1) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(floor(v[2] / 0.1) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(floor(v[3] / 0.1) AS BIGINT) AS VARCHAR) AS box FROM r0), t AS (SELECT *, row_number() OVER (PARTITION BY box ORDER BY id) AS turn FROM b),
o AS (SELECT *, row_number() OVER (ORDER BY turn, id) AS p FROM t) SELECT id, box, p <= 120 AS kept FROM o""")
def geosketch_boxes(spark: SparkSession, d: str) -> DataFrame:
    return embed.sketch(rows(spark, d), 120, 0.1).select("id", "box", "kept")


@query(f"""WITH {_NEAR}, und AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM knn), e AS (SELECT a.label AS cu, b.label AS cv FROM und JOIN r0 a ON a.id = u JOIN r0 b ON b.id = und.v), m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM e),
k AS (SELECT c, count(*) AS k FROM (SELECT cu AS c FROM e UNION ALL SELECT cv FROM e) q GROUP BY 1), l AS (SELECT cu AS c, count(*) AS l FROM e WHERE cu = cv GROUP BY 1) SELECT round(sum(coalesce(l, 0) / m - pow(k / (2 * m), 2)), 6) AS q FROM k LEFT JOIN l USING (c), m""")
def modularity_given_labels(spark: SparkSession, d: str) -> DataFrame:
    k = embed.knn(rows(spark, d), rows(spark, d), K)
    edges = k.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct().withColumn("w", F.lit(1.0))
    return rounded(graph.modularity(edges, rows(spark, d).select(F.col("id").alias("node"), F.col("label").alias("c"))), "q")


@query()
def pca_variance(spark: SparkSession, d: str) -> DataFrame:
    """Explained variance of normalised counts; held against numpy in tests."""
    c = normalize.log_normalise(V.counts(spark, d))
    genes = V.genes(spark, d)
    _, _, ratio = embed.pca(settle(embed.panel_rows(c, genes)), 10, genes.count())
    return spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(ratio)], "component int, explained double")


@query()
def pseudobulk_pca(spark: SparkSession, d: str) -> DataFrame:
    """Two components of pseudobulks at counts per million, with explained percent."""
    b = named_bulks(spark, d).select(F.lit("all").alias("sample"), F.col("bulk").alias("cell_id"), "gene", "count")
    v = normalize.log_normalise(b, 1e6)
    genes = settle(v.groupBy("gene").agg(F.var_samp("value").alias("s")).where("s > 0").select("gene"))
    vec = settle(embed.panel_rows(v, genes))
    mean, comp, ratio = embed.pca(vec, 2, genes.count())
    p = embed.project(vec, mean, comp, "cell_id")
    return p.select(F.col("cell_id").alias("bulk"), F.get("pcs", F.lit(0)).alias("pc1"), F.get("pcs", F.lit(1)).alias("pc2"), F.lit(float(100 * ratio[0])).alias("pct1"), F.lit(float(100 * ratio[1])).alias("pct2"))


@query()
def leiden_labels(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of the neighbour graph; tests hold their modularity and connectedness."""
    k = embed.knn(rows(spark, d), rows(spark, d), K)
    return graph.communities(graph.fuzzy_union(k))


@query()
def leiden_ladder(spark: SparkSession, d: str) -> DataFrame:
    """The same at four resolutions in one set of rounds, with the modularity of each."""
    k, steps = embed.knn(rows(spark, d), rows(spark, d), K), [0.5, 1.0, 1.5, 2.0]
    edges = settle(graph.fuzzy_union(k))
    found = settle(graph.ladder(edges, steps))
    out = [found.where(F.col("res") == i).crossJoin(graph.modularity(edges, found.where(F.col("res") == i).select("node", F.col("cluster").alias("c")), g)).select(F.lit(g).alias("resolution"), "node", "cluster", F.round("q", 6).alias("modularity")) for i, g in enumerate(steps)]
    return reduce(DataFrame.unionByName, out)


@query()
def layout_xy(spark: SparkSession, d: str) -> DataFrame:
    return graph.layout(graph.fuzzy_union(embed.knn(rows(spark, d), rows(spark, d), K)))


@query()
def umap_xy(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates by a local-scale neighbour graph; tests hold their trustworthiness."""
    r = rows(spark, d)
    return graph.umap(settle(graph.smooth_union(embed.knn(r, r, 15))))


@query()
def harmony_pcs(spark: SparkSession, d: str) -> DataFrame:
    return embed.harmonise(rows(spark, d), clusters=8)


@query()
def dendrogram_order(spark: SparkSession, d: str) -> DataFrame:
    order = embed.group_order(rows(spark, d))
    return spark.createDataFrame([(g, i) for i, g in enumerate(order)], "label string, place int")


@query(f"""WITH {_FACTORS}, z AS (SELECT gene, bulk, region_annotation, (value - avg(value) OVER (PARTITION BY gene)) / nullif(stddev_samp(value) OVER (PARTITION BY gene), 0) AS z FROM normed),
m AS (SELECT gene, region_annotation, round(avg(z), 6) AS m FROM z GROUP BY 1, 2), p AS (SELECT gene, string_agg(region_annotation, '>' ORDER BY m DESC, region_annotation) AS pattern FROM m GROUP BY 1),
n AS (SELECT pattern, count(*) AS n FROM p GROUP BY 1 HAVING count(*) >= 1) SELECT gene, pattern, dense_rank() OVER (ORDER BY n DESC, pattern) AS "group" FROM p JOIN n USING (pattern)""")
def expression_patterns(spark: SparkSession, d: str) -> DataFrame:
    z = pseudobulk.gene_zscores(normed(spark, d), "bulk").withColumn("region_annotation", F.element_at(F.split("bulk", r"\|"), 2))
    return de.patterns(z, "region_annotation", 1)
