"""Domain tables over the test tables: counts, cells, genes and spots (cells with few-dimensional coordinates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _cell() -> F.Column:
    return F.concat(F.lit("cell_"), F.col("o_orderkey").cast("string"))


#: Lines in a partition of ``counts``, so that what a task holds does not grow with the table.
LINES = 500_000


def counts(spark: SparkSession, d: str) -> DataFrame:
    """sample, cell_id, gene, count: an order is a cell, a part's name a gene, a quantity a count.

    Tables of more lines than the session's partitions hold at ``LINES`` each are dealt to more, by order and then by cell; what follows by cell stays in these.
    """
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    parts = table(spark, d, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("gene"))
    n = -(-lines.count() // LINES)
    wide = n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select("l_orderkey", "gene", "l_quantity")
    if wide:
        lines, orders = lines.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    met = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(F.col("c_mktsegment").alias("sample"), _cell().alias("cell_id"), "gene", "l_quantity")
    if wide:
        met = met.repartition(n, "sample", "cell_id")
    return met.groupBy("sample", "cell_id", "gene").agg(F.sum("l_quantity").cast("long").alias("count"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """sample, cell_id, x, y, region_annotation, cell_type, niche, condition."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    met = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return met.select(
        F.col("c_mktsegment").alias("sample"),
        _cell().alias("cell_id"),
        (F.col("o_totalprice") / 1000).alias("x"),
        (F.col("c_acctbal") / 100).alias("y"),
        F.col("r_name").alias("region_annotation"),
        F.col("o_orderpriority").alias("cell_type"),
        F.col("n_name").alias("niche"),
        F.col("o_orderstatus").alias("condition"),
    )


def genes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("gene")).distinct()


def spots(spark: SparkSession, d: str) -> DataFrame:
    """sample, cell_id, vec_id, x, y, label, and pcs (the whole vector)."""
    e = F.col("embedding")
    return table(spark, d, "embeddings").select(
        F.concat(F.lit("s"), (F.col("vec_id") % 3).cast("string")).alias("sample"),
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("cell_id"),
        "vec_id",
        F.round(F.get(e, F.lit(0)).cast("double") * 1000, 3).alias("x"),
        F.round(F.get(e, F.lit(1)).cast("double") * 1000, 3).alias("y"),
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("label"),
        F.transform(e, lambda v: v.cast("double")).alias("pcs"),
    )
