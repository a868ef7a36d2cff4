"""Composition tables: cross-tabulations, their row and column shares, nested shares, cell counts and cluster trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def crosstab(cells: DataFrame, group: str, category: str) -> DataFrame:
    """(group, category, n) for every group and every category, zeros included."""
    n = cells.groupBy(group, category).agg(F.count("*").alias("n"))
    # both sides are lists of labels
    full = cells.select(group).distinct().crossJoin(F.broadcast(cells.select(category).distinct()))
    return full.join(n, [group, category], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def row_percent(tab: DataFrame, group: str) -> DataFrame:
    """``tab`` with pct of its row's total; null where that is 0."""
    return tab.withColumn("pct", F.try_divide(100.0 * F.col("n"), F.sum("n").over(Window.partitionBy(group))))


def column_share(tab: DataFrame, category: str) -> DataFrame:
    return tab.withColumn("share", F.try_divide(F.col("n").cast("double"), F.sum("n").over(Window.partitionBy(category))))


def nested_percent(cells: DataFrame, outer: str, inner: str, category: str) -> DataFrame:
    """(outer, inner, category, n, pct) over observed groups, pct within (outer, inner)."""
    n = cells.groupBy(outer, inner, category).agg(F.count("*").alias("n"))
    return n.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(outer, inner)))


def wide_percent(cells: DataFrame, outer: str, inner: str, category: str, levels: list[str]) -> DataFrame:
    """nested_percent as one row per (outer, inner), a column per level, 0 where absent."""
    return nested_percent(cells, outer, inner, category).groupBy(outer, inner).pivot(category, levels).agg(F.sum("pct")).na.fill(0.0)


def cell_counts(cells: DataFrame, *by: str) -> DataFrame:
    return cells.groupBy(*by).agg(F.count("*").alias("n_cells"))


def cluster_tree(labels: DataFrame, cell: str = "cell_id", by: Sequence[str] = ()) -> DataFrame:
    """Transitions between clusterings: ``labels`` (by..., cell, res_idx, cluster) -> by..., res_idx, from, to, n, share of the source cluster."""
    a, b = labels.select(*by, cell, "res_idx", F.col("cluster").alias("from")), labels.select(*by, cell, (F.col("res_idx") - 1).alias("res_idx"), F.col("cluster").alias("to"))
    n = a.join(b, [*by, cell, "res_idx"]).groupBy(*by, "res_idx", "from", "to").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by, "res_idx", "from")))


def level_order(label: Column, levels: list[str]) -> Column:
    """Place in a configured order; labels outside it come after."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, v in enumerate(levels) for x in (v, i)]), label), F.lit(len(levels))) if levels else F.lit(0)


def numeric_order(label: Column) -> tuple[Column, Column]:
    """Sort keys: labels that are numbers by value, then the rest by text."""
    return label.try_cast("double").asc_nulls_last(), label.asc()


def palette(label: Column, colours: dict[str, str], default: str = "#cccccc") -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in colours.items() for x in kv]), label), F.lit(default)) if colours else F.lit(default)
