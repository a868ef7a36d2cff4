"""Queries of scalar functions, formats and small sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytogrid.functions import text
from cytogrid.operators import annotate, compose, report, subset
from cytogrid.plans import views as V
from cytogrid.plans.queries_core import n_cells
from cytogrid.plans.registry import query
from cytogrid.sources import readers


@query("""WITH i AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'cellid_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '-1' WHEN 1 THEN 'CellID_00' || CAST(o_orderkey AS VARCHAR) ELSE 'x-' || CAST(o_orderkey AS VARCHAR) END AS id FROM orders)
SELECT id, CASE WHEN regexp_matches(regexp_replace(regexp_replace(id, '-1$', ''), '^cellid_', ''), '^[0-9]+$') THEN CAST(CAST(regexp_replace(regexp_replace(id, '-1$', ''), '^cellid_', '') AS BIGINT) AS VARCHAR) ELSE id END AS key,
 CASE WHEN regexp_replace(regexp_replace(regexp_replace(id, '(?i)^cellid_', ''), '-1$', ''), '^0+', '') = '' THEN '0' ELSE regexp_replace(regexp_replace(regexp_replace(id, '(?i)^cellid_', ''), '-1$', ''), '^0+', '') END AS loose FROM i""")
def cell_id_normalise(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    i = F.when(k % 3 == 0, F.concat(F.lit("cellid_"), F.lpad(k.cast("string"), 9, "0"), F.lit("-1"))).when(k % 3 == 1, F.concat(F.lit("CellID_00"), k.cast("string"))).otherwise(F.concat(F.lit("x-"), k.cast("string")))
    t = V.table(spark, d, "orders").select(i.alias("id"))
    return t.select("id", text.cell_key(F.col("id")).alias("key"), text.cell_key_loose(F.col("id")).alias("loose"))


@query("SELECT coalesce(json_extract_string(props, '$.k'), 'Unlabeled') AS k, coalesce(json_extract_string(props, '$.name'), 'Unlabeled') AS name, count(*) AS n FROM events GROUP BY 1, 2")
def json_class_name(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "events")
    return e.groupBy(text.class_name(F.col("props"), "$.k").alias("k"), text.class_name(F.col("props")).alias("name")).agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 7 = 0 THEN '0' ELSE 'u' || CAST(user_id AS VARCHAR) END AS cell_id, event_id AS bin FROM events)
SELECT cell_id, round(avg(value), 6) AS x, round(avg(event_id % 100), 6) AS y FROM b JOIN events ON bin = event_id WHERE cell_id IS NOT NULL AND lower(cell_id) NOT IN ('0', 'nan') GROUP BY 1""")
def bin_centroids(spark: SparkSession, d: str) -> DataFrame:
    e, u = V.table(spark, d, "events"), F.col("user_id")
    bins = e.select(F.col("event_id").alias("bin"), F.when(u % 11 == 0, None).when(u % 7 == 0, "0").otherwise(F.concat(F.lit("u"), u.cast("string"))).alias("cell_id"))
    at = e.select(F.col("event_id").alias("bin"), F.col("value").alias("col"), (F.col("event_id") % 100).alias("row"))
    return readers.bin_cells(bins, at).select("cell_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("SELECT 'MACHINERY' AS sample, cell_id, gene, count FROM counts WHERE sample = 'MACHINERY' AND gene IN ('hot-bolt', 'red-ring') AND cell_id LIKE '%3'")
def wide_to_long_drop_blank(spark: SparkSession, d: str) -> DataFrame:
    c = V.counts(spark, d).where("sample = 'MACHINERY'")
    wide = c.groupBy("cell_id").pivot("gene", ["hot-bolt", "red-ring", "old-rod"]).agg(F.sum("count")).na.fill(0).withColumnRenamed("old-rod", "Blank-1")
    return readers.wide_counts(wide, V.cells(spark, d).where(F.col("cell_id").endswith("3")), "MACHINERY", "cell_id")


@query("""SELECT DISTINCT p_name, regexp_replace(translate(p_name, '/ ', '__'), '', '') AS safe, 'hot' AS word, CASE WHEN p_name LIKE 'hot%' THEN 'T' ELSE 'F' END AS prefixed, lower(trim(regexp_replace('cell_type_' || p_brand, '^cell_type_', ''))) AS ann,
 regexp_replace(regexp_replace(regexp_replace(p_name || '#', '[^A-Za-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_+$', '') AS strict FROM part""")
def name_functions(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_name")
    return V.table(spark, d, "part").select("p_name", text.file_safe(n).alias("safe"), F.lit("hot").alias("word"), F.when(n.startswith("hot"), "T").otherwise("F").alias("prefixed"), text.annotation_name(F.concat(F.lit("cell_type_"), "p_brand")).alias("ann"), text.file_safe(F.concat(n, F.lit("#")), True).alias("strict")).distinct()


#: Names of image channels as vendors write them, dealt to the parts.
CHANNELS = ("DAPI", "Hoechst", "ATP1A1/CD45/E-Cadherin", "18S", "18S rRNA", "Interior RNA", "AlphaSMA/Vimentin", "Boundary 1", "cytoplasm RNA", "Cyto", "beta-Actin", "PolyT")


@query(f"""WITH c AS (SELECT DISTINCT list_extract({list(CHANNELS)!r}, CAST(p_partkey % {len(CHANNELS)} AS INT) + 1) || ' ' || p_brand AS name FROM part)
SELECT name, CASE WHEN regexp_matches(name, '(?i)dapi|nucl|hoechst') THEN 'nuclear' WHEN regexp_matches(name, '(?i)18s|rna|interior') THEN 'rna' WHEN regexp_matches(name, '(?i)boundary|membrane|atp1a1|cadherin|e-cad|ecad|cd45') THEN 'membrane'
 WHEN regexp_matches(name, '(?i)alphasma|sma|vimentin|actin|cytoplasm') THEN 'cytoplasm' END AS role FROM c""")
def channel_roles(spark: SparkSession, d: str) -> DataFrame:
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.col("p_partkey") % len(CHANNELS) + 1).cast("int"))
    t = V.table(spark, d, "part").select(F.concat_ws(" ", channel, "p_brand").alias("name")).distinct()
    return t.select("name", text.channel_role(F.col("name")).alias("role"))


@query("WITH l AS (SELECT s_suppkey, (s_suppkey % 5 + 1) / 10.0 AS low, (s_suppkey % 7) AS steps, CASE WHEN s_suppkey % 2 = 0 THEN 0.1 ELSE 0.25 END AS step FROM supplier) SELECT s_suppkey, round(CAST(low + unnest(range(steps + 1)) * step AS DOUBLE), 10) AS resolution FROM l")
def resolution_ladder(spark: SparkSession, d: str) -> DataFrame:
    """A ladder for each supplier's own limits and step."""
    k = F.col("s_suppkey")
    step = F.when(k % 2 == 0, 0.1).otherwise(0.25)
    low = (k % 5 + 1) / 10
    return V.table(spark, d, "supplier").select("s_suppkey", F.explode(text.ladder(low, low + (k % 7) * step, step)).alias("resolution"))


@query("SELECT p_partkey, p_name || CASE WHEN n = 1 THEN '' ELSE '-' || CAST(n - 1 AS VARCHAR) END AS name FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part) q")
def unique_gene_names(spark: SparkSession, d: str) -> DataFrame:
    return text.unique_names(V.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name")), "name", "p_partkey")


@query("""WITH q AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey / 8.0 AS VARCHAR) WHEN 1 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN o_orderpriority ELSE '' END AS t FROM orders), v AS (SELECT *, TRY_CAST(t AS DOUBLE) AS v FROM q)
SELECT o_orderkey, CAST(trunc(v) AS BIGINT) AS whole, CAST(CASE WHEN v - floor(v) = 0.5 THEN 2 * round(v / 2) ELSE round(v) END AS DOUBLE) AS even FROM v""")
def number_functions(spark: SparkSession, d: str) -> DataFrame:
    """Whole numbers and halves rounded to even, of texts some of which are no numbers."""
    k = F.col("o_orderkey")
    t = F.when(k % 4 == 0, (k / 8.0).cast("string")).when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, F.col("o_orderpriority")).otherwise("")
    q = V.table(spark, d, "orders").select("o_orderkey", t.alias("t"))
    return q.select("o_orderkey", text.whole(F.col("t")).alias("whole"), text.half_even(F.col("t").try_cast("double")).alias("even"))


@query("SELECT CAST(i AS VARCHAR) AS cluster, '' AS \"AUTOMOBILE_0.5\", '' AS \"BUILDING_0.5\", '' AS \"FURNITURE_0.5\", '' AS \"HOUSEHOLD_0.5\", '' AS \"MACHINERY_0.5\" FROM range(50) AS r(i) WHERE EXISTS (SELECT 1 FROM cells)")
def blank_template(spark: SparkSession, d: str) -> DataFrame:
    """Columns for the samples that the cells have."""
    samples = sorted(r[0] for r in V.cells(spark, d).select("sample").distinct().collect())
    return readers.annotation_template(spark, [f"{s}_0.5" for s in samples])


@query("SELECT region_annotation, arg_min(condition, (-n, condition)) AS condition FROM (SELECT region_annotation, condition, count(*) AS n FROM cells GROUP BY 1, 2) q GROUP BY 1")
def group_palette(spark: SparkSession, d: str) -> DataFrame:
    return readers.palette_of(V.cells(spark, d), "region_annotation", "condition")


@query("SELECT coalesce(nullif(trim(lang), ''), 'Unannotated') AS label, count(*) AS n FROM documents GROUP BY 1")
def vendor_label_default(spark: SparkSession, d: str) -> DataFrame:
    return readers.vendor_labels(V.table(spark, d, "documents"), "doc_id", "lang").groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT gene, CAST(sum(count) AS BIGINT) AS total FROM counts GROUP BY 1 ORDER BY total DESC, gene LIMIT 10")
def most_expressed(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report."""
    return V.counts(spark, d).groupBy("gene").agg(F.sum("count").alias("total")).orderBy(F.desc("total"), "gene").limit(10)


@query("SELECT sample, count(*) AS n_cells, (SELECT count(*) FROM cells) AS n_all, count(*) FILTER (WHERE sample = 'MACHINERY') > 0 AS chosen FROM cells GROUP BY 1")
def sample_sizes(spark: SparkSession, d: str) -> DataFrame:
    c = V.cells(spark, d)
    return c.groupBy("sample").agg(F.count("*").alias("n_cells")).join(n_cells(c).withColumnRenamed("n_cells", "n_all")).select("sample", "n_cells", "n_all", (F.col("sample") == "MACHINERY").alias("chosen"))


@query("SELECT cell_id, sample, region_annotation || ' | ' || cell_type AS key, ntile(4) OVER (PARTITION BY region_annotation ORDER BY cell_id) AS piece FROM cells")
def region_split(spark: SparkSession, d: str) -> DataFrame:
    """Cells of each region split into nearly equal artificial samples."""
    from pyspark.sql import Window

    return V.cells(spark, d).select("cell_id", "sample", annotate.composite(F.col("region_annotation"), F.col("cell_type")).alias("key"), F.ntile(4).over(Window.partitionBy("region_annotation").orderBy("cell_id")).alias("piece"))


@query("WITH q AS (SELECT region_annotation, quantile_cont(x, [0, 0.25, 0.5, 0.75, 1]) AS q FROM cells GROUP BY 1) SELECT region_annotation, unnest(CAST([0.0, 0.25, 0.5, 0.75, 1.0] AS DOUBLE[])) AS point, round(unnest(q), 6) AS value FROM q")
def metric_distribution(spark: SparkSession, d: str) -> DataFrame:
    return report.distribution(V.cells(spark, d), "region_annotation", "x").withColumn("value", F.round("value", 6))


@query("SELECT sample, round(x * 0.5, 6) AS px, round(y * 0.5, 6) AS py, round(greatest(-50.0, least(x, 80.0)), 6) AS value FROM spots")
def map_points(spark: SparkSession, d: str) -> DataFrame:
    out = report.map_points(V.spots(spark, d), "x", 0.5, -50.0, 80.0)
    return out.withColumns({c: F.round(c, 6) for c in ("px", "py", "value")})


@query("SELECT cell_id AS id, label, x, row_number() OVER (PARTITION BY label ORDER BY x DESC, cell_id) AS place, round(avg(x) OVER (), 6) AS mean_all FROM spots")
def sorted_bars(spark: SparkSession, d: str) -> DataFrame:
    s = V.spots(spark, d).select(F.col("cell_id").alias("id"), "label", "x")
    return report.sorted_bars(s, "label", "x").withColumn("mean_all", F.round("mean_all", 6))


@query("SELECT sample, 'composition' AS part, region_annotation AS key, cell_type AS name, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY sample, region_annotation), 6) AS value FROM cells GROUP BY 1, 3, 4")
def sample_page_composition(spark: SparkSession, d: str) -> DataFrame:
    from cytogrid.operators import normalize

    pages = report.sample_pages(normalize.log_normalise(V.counts(spark, d)), V.cells(spark, d), ["none", "region_annotation"], "cell_type")
    return pages.where("part = 'composition'").withColumn("value", F.round("value", 6))


@query("SELECT sample, cell_id, x, y FROM cells WHERE cell_type IN ('1-URGENT', '2-HIGH')")
def compartment_cells(spark: SparkSession, d: str) -> DataFrame:
    return subset.compartment(V.cells(spark, d), "cell_type", ["1-URGENT", "2-HIGH"]).select("sample", "cell_id", "x", "y")


@query("WITH g AS (SELECT sample, niche FROM cells WHERE cell_type <> '5-LOW' GROUP BY 1, 2 HAVING count(*) >= 8 AND count(DISTINCT cell_type) >= 4) SELECT sample, niche, cell_id, cell_type FROM cells JOIN g USING (sample, niche) WHERE cell_type <> '5-LOW'")
def mixed_groups(spark: SparkSession, d: str) -> DataFrame:
    return subset.mixed_groups(V.cells(spark, d), ["sample", "niche"], "cell_type", 8, 4, ("5-LOW",)).select("sample", "niche", "cell_id", "cell_type")


@query("SELECT sample, cell_id, 'x' AS gene, CAST(x AS DOUBLE) AS value FROM cells UNION ALL SELECT sample, cell_id, 'y', CAST(y AS DOUBLE) FROM cells")
def pseudo_genes(spark: SparkSession, d: str) -> DataFrame:
    return subset.pseudo_genes(V.cells(spark, d), ["x", "y"])


@query("SELECT sample, n_cells, n_genes, round(n_cells * n_genes * 12.0 / 1e9, 9) AS gigabytes, n_cells * n_genes * 12.0 / 1e9 > 0.0002 AS too_large FROM (SELECT sample, count(DISTINCT cell_id) AS n_cells, count(DISTINCT gene) AS n_genes FROM counts GROUP BY 1) q")
def dense_size(spark: SparkSession, d: str) -> DataFrame:
    return subset.dense_size(V.counts(spark, d), 1, 0.0002).withColumn("gigabytes", F.round("gigabytes", 9))


@query("SELECT sample, cell_id AS barcode, cell_type AS label FROM cells")
def external_annotation(spark: SparkSession, d: str) -> DataFrame:
    return subset.one_sample(V.cells(spark, d), ["cell_type"], F.col("sample"), "label")


@query("SELECT label, row_number() OVER (ORDER BY TRY_CAST(label AS DOUBLE) NULLS LAST, label) AS place FROM (SELECT DISTINCT CASE WHEN label = 'c0' THEN label ELSE substr(label, 2) END AS label FROM spots) q")
def numeric_label_order(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    label = V.spots(spark, d).select(F.when(F.col("label") == "c0", F.col("label")).otherwise(F.substring("label", 2, 99)).alias("label")).distinct()
    return label.select("label", F.row_number().over(Window.orderBy(*compose.numeric_order(F.col("label")))).alias("place"))


@query("SELECT CASE region WHEN 'Necrosis' THEN 'Bubble' ELSE region END AS region, count(*) AS n FROM (SELECT CASE WHEN region_annotation = 'ASIA' THEN 'Necrosis' WHEN region_annotation = 'EUROPE' THEN NULL ELSE region_annotation END AS region FROM cells) q GROUP BY 1")
def region_remap(spark: SparkSession, d: str) -> DataFrame:
    """Region names with those that stand for another; ASIA plays a necrotic area, EUROPE one without name."""
    r = F.col("region_annotation")
    named = V.cells(spark, d).select(F.when(r == "ASIA", "Necrosis").when(r == "EUROPE", None).otherwise(r).alias("region"))
    return named.groupBy(text.remap(F.col("region")).alias("region")).agg(F.count("*").alias("n"))
