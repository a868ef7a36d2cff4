"""The tables behind figures: distributions, maps, sorted bars and per-sample pages. Drawing is left to others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.operators import compose, markers


def distribution(rows: DataFrame, group: str | Sequence[str], value: str, points: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """(group..., point, value): exact percentiles of a metric per group, for violins and boxes."""
    group = [group] if isinstance(group, str) else list(group)
    q = rows.groupBy(*group).agg(F.percentile(F.col(value).cast("double"), list(points)).alias("q"))
    return q.select(*group, F.posexplode("q").alias("i", "value")).select(*group, F.get(F.array(*[F.lit(p) for p in points]), F.col("i")).alias("point"), "value")


def map_points(cells: DataFrame, value: str, scale: float = 1.0, low: float | None = None, high: float | None = None) -> DataFrame:
    """(sample, px, py, value): positions in image pixels, with numbers clipped to a shared scale."""
    v = F.col(value)
    if low is not None and high is not None:
        v = F.greatest(F.lit(low), F.least(v, F.lit(high)))
    return cells.select("sample", (F.col("x") * scale).alias("px"), (F.col("y") * scale).alias("py"), v.alias("value"))


def sorted_bars(scores: DataFrame, label: str, value: str) -> DataFrame:
    """Values with their place within the label, largest first, and the mean of all."""
    place = F.row_number().over(Window.partitionBy(label).orderBy(F.desc(value), "id"))
    return scores.withColumn("place", place).join(scores.agg(F.avg(value).alias("mean_all")))


def first_usable(cells: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate column that there is and that has more than one value."""
    there = [c for c in candidates if c in cells.columns]
    if not there:
        return None
    n = cells.agg(*[F.count_distinct(c).alias(c) for c in there]).first()
    return next((c for c in there if n[c] > 1), None)


def sample_pages(values: DataFrame, cells: DataFrame, keys: list[str], label: str, top: int = 10) -> DataFrame:
    """Per sample the rows of its page: composition by the first usable key (else the sample), and the top markers of each label.

    (sample, part, key, name, value): part "composition" has percents, part "markers" ranks.
    """
    key = first_usable(cells, keys) or "sample"
    comp = compose.nested_percent(cells, "sample", key, label) if key != "sample" else compose.row_percent(compose.crosstab(cells, "sample", label), "sample")
    a = comp.select("sample", F.lit("composition").alias("part"), F.col(key).alias("key"), F.col(label).alias("name"), F.col("pct").alias("value"))
    best = markers.top_markers(markers.rank_sum(values, cells, label), label, top)
    b = cells.select("sample").distinct().join(F.broadcast(best)).select("sample", F.lit("markers").alias("part"), F.col(label).alias("key"), F.col("gene").alias("name"), F.col("rank").cast("double").alias("value"))
    return a.unionByName(b)
